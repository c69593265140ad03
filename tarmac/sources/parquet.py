"""Parquet sinks and reads: month-partitioned tables that reruns replace by month.

Layout: ``<root>/year=YYYY/month=M/part-*.parquet`` (``flight_year``/
``flight_month`` for the fact). Inside each month, rows are sorted by carrier
and origin, so Parquet row-group min/max statistics let a carrier or airport
filter skip most of a month (``PushedFilters``), and a month predicate skips
whole directories (``PartitionFilters``, see :func:`between_dates`).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac import schema as S
from tarmac.functions import months_between_predicate

OVERWRITE_DYNAMIC = "dynamic"
OVERWRITE_TRUNCATE = "truncate"
PLAIN_SALT_BUCKETS = 8


def _spread(df: DataFrame, keys: list[str], salt_buckets: int | None) -> DataFrame:
    """Group rows of one month into few tasks without one task per huge month.

    Default: a ``REBALANCE`` on the month keys, which adaptive execution
    splits when a month is larger than the advisory partition size and
    coalesces when months are small. With ``salt_buckets`` the month is
    hashed into that many fixed pieces instead; so it is, into
    ``PLAIN_SALT_BUCKETS``, where adaptive execution is off and would drop the
    hint.
    """
    if not salt_buckets and df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() != "true":
        salt_buckets = PLAIN_SALT_BUCKETS
    if salt_buckets:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
        return df.repartition(*[F.col(k) for k in keys], salt)
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    cluster_by: list[str],
    *,
    mode: str = OVERWRITE_DYNAMIC,
    salt_buckets: int | None = None,
) -> None:
    """Write ``df`` as Snappy Parquet partitioned by ``partition_by``.

    ``mode="dynamic"`` replaces only the partitions present in ``df`` (a
    rerun of one month replaces that month, others stay); ``"truncate"``
    replaces the whole table.
    """
    if mode not in (OVERWRITE_DYNAMIC, OVERWRITE_TRUNCATE):
        raise ValueError(f"mode must be {OVERWRITE_DYNAMIC!r} or {OVERWRITE_TRUNCATE!r}")
    laid_out = _spread(df, partition_by, salt_buckets).sortWithinPartitions(*partition_by, *cluster_by)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if mode == OVERWRITE_DYNAMIC else "static")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_clean(df: DataFrame, path: str, *, mode: str = OVERWRITE_DYNAMIC, salt_buckets: int | None = None) -> None:
    """Clean rows → ``path/year=/month=``, clustered by carrier and origin."""
    write_partitioned(df, path, ["year", "month"], ["mkt_carrier", "origin"], mode=mode, salt_buckets=salt_buckets)


def write_fact(df: DataFrame, path: str, *, mode: str = OVERWRITE_DYNAMIC, salt_buckets: int | None = None) -> None:
    """Fact rows → ``path/flight_year=/flight_month=``, clustered by carrier and origin."""
    write_partitioned(
        df,
        path,
        ["flight_year", "flight_month"],
        ["carrier_code", "origin_airport"],
        mode=mode,
        salt_buckets=salt_buckets,
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select ``schema``'s columns by name, cast to its types; fail on a missing name.

    The load contract: whatever order or extra columns the input has, the
    output has exactly the declared columns and types.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_staging(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    *,
    mode: str = OVERWRITE_DYNAMIC,
    salt_buckets: int | None = None,
) -> DataFrame:
    """Load clean Parquet months into the staging table; return the table.

    By default each month in the source replaces the same month in the table
    (others are kept), so loading month by month accumulates history; with
    ``mode="truncate"`` the table holds only what this load brought.

    Files whose columns do not fit the declared types are named and refused
    (:mod:`tarmac.sources.footers`) before anything is read or replaced.
    """
    from tarmac.sources import footers

    footers.check(spark, source_path, S.STAGING_SOURCE_SCHEMA, partitions=("year", "month"))
    src = spark.read.parquet(source_path)
    conformed = conform(src, S.STAGING_SOURCE_SCHEMA)
    write_clean(conformed, table_path, mode=mode, salt_buckets=salt_buckets)
    return spark.read.schema(S.STAGING_SOURCE_SCHEMA).parquet(table_path)


def as_table(
    df: DataFrame, name: str, path: str, *, partition_by: list[str] | None = None
) -> DataFrame:
    """Register the Parquet files at ``path`` as catalog table ``name``; return it by name.

    The table is external and typed as ``df``, so partition keys keep their declared types.
    It is created if needed; new partition directories are picked up on every call.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def as_snapshot_table(
    spark: SparkSession, schema: StructType, name: str, base: str, keys: list[str], places: dict[str, str]
) -> DataFrame:
    """Catalog table ``name`` over exactly the folders ``places`` (partition → folder).

    External and typed by ``schema``. A plain table has one folder, under the partition ``""``,
    and is moved by its one location; a partitioned one has the partitions that differ replaced.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
    home = base if keys or not places else places[""]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{home}'")
    if not keys:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{home}'")
    else:
        text = {f.name for f in schema.fields if f.dataType.typeName() == "string"}

        def spec(values: list[str]) -> str:
            return "PARTITION (" + ", ".join(f"`{k}` = " + ("null" if "__HIVE_DEFAULT" in v or v == "null" else f"'{v}'" if k in text else v) for k, v in zip(keys, values)) + ")"

        # Partition folders may carry keys that are not the table's, in front of them.
        wanted = {spec([dict(x.split("=", 1) for x in p.split("/"))[k] for k in keys]): place for p, place in places.items()}
        have = [spec([x.split("=", 1)[1] for x in r[0].split("/")]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        if have:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(have)}")
        if wanted:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{p} LOCATION '{place}'" for p, place in wanted.items()))
    spark.catalog.refreshTable(name)
    return spark.table(name)


def materialize(
    df: DataFrame,
    path: str,
    *,
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """Replace the table at ``path`` with ``df`` and return a fresh read of it.

    The returned frame's lineage starts at the written files: later stages
    neither recompute ``df`` nor depend on the executors that produced it.
    """
    if partition_by:
        write_partitioned(df, path, partition_by, cluster_by or [], mode=OVERWRITE_TRUNCATE)
    else:
        writer = df.sortWithinPartitions(*cluster_by) if cluster_by else df
        writer.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view (never persisted) and return it by name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def between_dates(
    df: DataFrame,
    lo: _dt.date | str,
    hi: _dt.date | str,
    *,
    date_col: str = "fl_date",
    year_col: str = "year",
    month_col: str = "month",
) -> DataFrame:
    """Rows with ``lo <= date_col <= hi``, plus the equivalent month predicate.

    Directories are keyed by year and month, not by date, so a predicate on
    the date alone cannot prune them; the added predicate on the partition
    columns can, and is implied by the date range, so results are unchanged.
    """
    lo_d = lo if isinstance(lo, _dt.date) else _dt.date.fromisoformat(lo)
    hi_d = hi if isinstance(hi, _dt.date) else _dt.date.fromisoformat(hi)
    in_range: Column = F.col(date_col).between(F.lit(lo_d), F.lit(hi_d))
    return df.filter(months_between_predicate(lo_d, hi_d, year_col, month_col) & in_range)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def drop_partitions(spark: SparkSession, table_path: str, keys: list[str], values: list[tuple]) -> None:
    """Delete the partition directories ``keys=values`` of a table (missing ones are skipped)."""
    for vals in values:
        sub = "/".join(f"{k}={v}" for k, v in zip(keys, vals))
        fs, jpath = hadoop_path(spark, f"{table_path.rstrip('/')}/{sub}")
        if fs.exists(jpath):
            fs.delete(jpath, True)


def partition_values(spark: SparkSession, table_path: str, keys: list[str]) -> list[tuple[int, ...]]:
    """Integer values of the partition directories ``keys`` below ``table_path`` (none if it is missing)."""
    fs, jpath = hadoop_path(spark, "/".join([table_path.rstrip("/"), *[f"{k}=*" for k in keys]]))
    found = fs.globStatus(jpath) or []
    tails = [str(s.getPath().toString()).rstrip("/").split("/")[-len(keys) :] for s in found]
    return sorted(tuple(int(part.split("=", 1)[1]) for part in tail) for tail in tails)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at ``path`` with its declared types; empty if the path does not exist."""
    fs, jpath = hadoop_path(spark, path)
    if not fs.exists(jpath):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
