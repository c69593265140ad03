"""Raw monthly CSV files → raw rows (18 text columns, bound by header name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import schema as S


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read raw CSV with a header; empty cells are null; every column is text.

    Columns are selected **by header name**, not position: a file with extra
    or reordered columns reads correctly, a file missing one of the 18 names
    fails at analysis. Files whose headers disagree with the first file's
    fail too (``enforceSchema=false``) instead of shifting columns silently.
    Uncompressed CSV splits into ``maxPartitionBytes`` pieces, so one large
    month still spreads over many tasks.
    """
    df = (
        spark.read.option("header", True)
        .option("nullValue", "")
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    missing = [c for c in S.RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"raw CSV lacks columns {missing}")
    return df.select(*[F.col(c).cast("string").alias(c) for c in S.RAW_COLUMNS])
