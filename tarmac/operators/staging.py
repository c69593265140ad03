"""Clean rows → staging view: renamed, keyed, operated past flights only."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.functions import surrogate_key, within_outlier_limit
from tarmac.operators.clean import is_cancelled

KEY_PARTS = ["fl_date", "mkt_carrier", "mkt_carrier_fl_num", "origin", "dest"]


def to_staging_columns(clean_df: DataFrame) -> DataFrame:
    """Rename to warehouse names, add ``flight_id``, recast year/month/cancelled."""
    return clean_df.select(
        surrogate_key(*KEY_PARTS).alias("flight_id"),
        F.col("fl_date"),
        F.col("mkt_carrier").alias("carrier_code"),
        F.col("mkt_carrier_fl_num").alias("flight_number"),
        F.col("origin").alias("origin_airport"),
        F.col("dest").alias("dest_airport"),
        "dep_delay",
        "arr_delay",
        *S.DELAY_CAUSE_COLUMNS,
        "actual_elapsed_time",
        "distance",
        "total_delay",
        "is_delayed",
        "delay_bucket",
        "primary_delay_cause",
        F.col("year").cast("bigint").alias("flight_year"),
        F.col("month").cast("bigint").alias("flight_month"),
        F.col("cancelled").cast("double").alias("cancelled"),
        "cancellation_code",
    )


def operated_only(df: DataFrame, cancelled: str = "cancelled") -> DataFrame:
    """Drop cancelled flights; a null flag counts as operated."""
    return df.filter(~is_cancelled(cancelled))


def _as_of_column(as_of: _dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def before(df: DataFrame, as_of: _dt.date | str | Column | None = None, date_col: str = "fl_date") -> DataFrame:
    """Keep rows dated strictly before ``as_of`` (default: today)."""
    return df.filter(F.col(date_col) < _as_of_column(as_of))


def drop_outliers(
    df: DataFrame, cols: tuple[str, ...] = ("arr_delay", "dep_delay"), limit: float = S.OUTLIER_LIMIT_MIN
) -> DataFrame:
    """Drop rows where any listed delay exceeds ``limit`` minutes in magnitude."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & within_outlier_limit(c, limit)
    return df.filter(cond)


def stage(
    clean_df: DataFrame,
    as_of: _dt.date | str | Column | None = None,
    *,
    outlier_limit: float = S.OUTLIER_LIMIT_MIN,
    dedupe_keys: bool = False,
) -> DataFrame:
    """Staging view: renamed + keyed, operated, past, no outliers.

    ``dedupe_keys=True`` also keeps one row per ``flight_id`` (:func:`dedupe`).
    """
    staged = to_staging_columns(clean_df)
    staged = operated_only(staged)
    staged = before(staged, as_of)
    staged = drop_outliers(staged, limit=outlier_limit)
    return dedupe(staged) if dedupe_keys else staged


# The parts of the key itself add nothing to the order of its rows.
DEDUPE_ORDER = [
    "dep_delay",
    "arr_delay",
    *S.DELAY_CAUSE_COLUMNS,
    "actual_elapsed_time",
    "distance",
    "cancelled",
    "cancellation_code",
]


def _whole_order(df: DataFrame, key: str, order: list[str] | None) -> list[str]:
    """The given order columns, then every other column: equal to the end, two rows are the same row."""
    order = order or [c for c in DEDUPE_ORDER if c in df.columns]
    return order + [c for c in df.columns if c != key and c not in order]


def dedupe(df: DataFrame, key: str = "flight_id", order: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the least row by ``order`` (ascending, nulls first). A null key is a key.

    Repeatable, unlike ``dropDuplicates``: the same input keeps the same row. Written as the
    first of a ranking, which Spark cuts to one row per key in every map task before the
    shuffle: a key holding a third of all rows ships one row per task, and rows are sorted,
    never aggregated.
    """
    ranked = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in _whole_order(df, key, order)])
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def dedupe_stored(df: DataFrame, key: str = "flight_id", order: list[str] | None = None) -> DataFrame:
    """:func:`dedupe` for a stored table in which repeated keys are rare: whole rows are fetched late.

    A first pass reads the key's columns alone and shuffles eight bytes for each distinct key,
    to find the hashes that occur twice. Rows without such a hash are passed on where they are;
    only the others are ranked. Two keys that share a hash are ranked apart, so the result is
    exact. The joins carry no hint: adaptive execution broadcasts the repeated hashes where they
    are measured to be few and shuffles where they are not.
    """
    mark = F.xxhash64(key)
    repeated = df.groupBy(mark.alias("_mark")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_mark")
    marked = df.withColumn("_mark", mark)
    alone = marked.join(repeated, "_mark", "left_anti").select(*df.columns)
    again = marked.join(repeated, "_mark", "left_semi").select(*df.columns)
    return alone.unionByName(dedupe(again, key, order))
