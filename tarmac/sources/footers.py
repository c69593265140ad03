"""What Parquet files say of their own columns, held against a declared schema before a read.

A read with a declared schema takes whatever a file stores under a column's name: an int file
under a string column fails in the middle of a job or, worse, is cast. Here the footers are
read first, a few kilobytes of each file, by tasks; equal answers are merged there, so what
comes back grows with the different layouts, not with the files. A file whose column is neither
of the declared type nor of one that widens to it is named and refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import DataType, StructType

from tarmac.sources.archives import _open_binary

# Stored types that a declared type takes without losing a value.
WIDENS = {
    "smallint": ["tinyint"],
    "int": ["tinyint", "smallint"],
    "bigint": ["tinyint", "smallint", "int"],
    "float": ["tinyint", "smallint"],
    "double": ["tinyint", "smallint", "int", "float"],
}
ANSWER = "name string, stored string, files long, example string"


class DriftedSchema(ValueError):
    """Files whose columns do not fit the declared schema; ``drifts`` has a row for each kind."""

    def __init__(self, path: str, drifts: list[tuple[str, str, str, int, str]]):
        self.drifts = drifts
        lines = [f"{column}: {stored}, declared {declared}, in {files} files such as {example}" for column, declared, stored, files, example in drifts]
        super().__init__(f"{path} does not fit its declared schema: " + "; ".join(lines))


def _layout(path: str) -> str:
    """The file's columns and Spark types, as text."""
    with _open_binary(path) as handle:
        schema = pq.read_schema(handle)
    return json.dumps([[f.name, _type_name(f.type)] for f in schema])


def _type_name(kind: pa.DataType) -> str:
    try:
        return from_arrow_type(kind).simpleString()
    except Exception:  # a type that Spark has no name for
        return str(kind)


def stored_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(name, stored, files, example): each column and type found in the footers, with its number of files.

    The number of all files is in the row without a name, if there is any file.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    paths = files.load(path).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch["path"].to_pylist()
            yield pa.RecordBatch.from_pydict({"path": paths, "layout": [_layout(p) for p in paths]})

    layouts = paths.mapInArrow(read, "path string, layout string")
    alike = layouts.groupBy("layout").agg(F.count("*").alias("files"), F.min("path").alias("example"))
    each = alike.withColumn("c", F.explode(F.from_json("layout", "array<array<string>>")))
    columns = each.groupBy(F.col("c")[0].alias("name"), F.col("c")[1].alias("stored")).agg(
        F.sum("files").alias("files"), F.min("example").alias("example")
    )
    total = alike.agg(F.sum("files").alias("files"), F.min("example").alias("example")).filter("files > 0")
    return columns.unionByName(total.select(F.lit(None).cast("string").alias("name"), F.lit("").alias("stored"), "files", "example"))


def fits(declared: DataType, stored: str) -> bool:
    kind = declared.simpleString()
    return stored == kind or stored in WIDENS.get(kind, [])


def check(spark: SparkSession, path: str | list[str], schema: StructType, partitions: tuple[str, ...] = ()) -> None:
    """Raise :class:`DriftedSchema` if a file below ``path`` does not hold ``schema``'s columns in fitting types.

    Columns of ``partitions`` are in the folders' names, not in the files. Columns beyond the
    schema are not looked at.
    """
    found = stored_columns(spark, path).collect()
    total = sum(r["files"] for r in found if r["name"] is None)
    drifts = []
    for field in schema.fields:
        if field.name in partitions or not total:
            continue
        own = [r for r in found if r["name"] == field.name]
        kind = field.dataType.simpleString()
        drifts += [(field.name, kind, r["stored"], r["files"], r["example"]) for r in own if not fits(field.dataType, r["stored"])]
        missing = total - sum(r["files"] for r in own)
        if missing:
            drifts.append((field.name, kind, "missing", missing, _without(spark, path, field.name)))
    if drifts:
        raise DriftedSchema(str(path), drifts)


def _without(spark: SparkSession, path: str | list[str], column: str) -> str:
    """One file that lacks the column."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [p for p in batch["path"].to_pylist() if column not in dict(json.loads(_layout(p)))]
            yield pa.RecordBatch.from_pydict({"path": pa.array(some, pa.string())})

    return files.load(path).select("path").mapInArrow(lacking, "path string").agg(F.min("path")).first()[0]
