"""Raw rows → clean, typed, enriched rows (``DataFrame → DataFrame``).

The steps compose into one projection and one filter, which Catalyst
collapses into a single codegen stage over the scan: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.functions import (
    delay_bucket,
    is_delayed,
    largest_cause,
    parse_date,
    parse_float,
    parse_int,
    primary_delay_cause,
    total_delay,
)

# raw header → clean name; the casts of `cast_types` apply to these names.
RAW_TO_CLEAN = {
    "FlightDate": "fl_date",
    "Reporting_Airline": "mkt_carrier",
    "Flight_Number_Reporting_Airline": "mkt_carrier_fl_num",
    "Origin": "origin",
    "Dest": "dest",
    "DepDelay": "dep_delay",
    "ArrDelay": "arr_delay",
    "Cancelled": "cancelled",
    "CancellationCode": "cancellation_code",
    "CarrierDelay": "carrier_delay",
    "WeatherDelay": "weather_delay",
    "NASDelay": "nas_delay",
    "SecurityDelay": "security_delay",
    "LateAircraftDelay": "late_aircraft_delay",
    "ActualElapsedTime": "actual_elapsed_time",
    "Distance": "distance",
    "DepTime": "dep_time",
    "ArrTime": "arr_time",
}

REQUIRED_FIELDS = ["fl_date", "origin", "dest", "mkt_carrier"]

TYPED_COLUMNS = [
    "fl_date",
    "mkt_carrier",
    "mkt_carrier_fl_num",
    "origin",
    "dest",
    "dep_time",
    "arr_time",
    "cancellation_code",
    *S.FLOAT_COLUMNS,
]

DERIVED_COLUMNS = ["total_delay", "is_delayed", "delay_bucket", "primary_delay_cause", "year", "month"]


def rename_columns(raw: DataFrame) -> DataFrame:
    """Select the 18 raw columns by name, under snake_case names, still text.

    Binding is by name: a missing header raises, extra columns are dropped.
    """
    return raw.select(*[F.col(src).alias(dst) for src, dst in RAW_TO_CLEAN.items()])


def typed_columns() -> list[Column]:
    """The parsers over the text columns: date, int flight number, ten float32 columns."""
    casts: dict[str, Column] = {
        "fl_date": parse_date("fl_date"),
        "mkt_carrier_fl_num": parse_int("mkt_carrier_fl_num"),
        **{c: parse_float(c) for c in S.FLOAT_COLUMNS},
    }
    return [casts.get(c, F.col(c)).alias(c) for c in TYPED_COLUMNS]


def cast_types(renamed: DataFrame) -> DataFrame:
    """Parse the text columns (:func:`typed_columns`)."""
    return renamed.select(*typed_columns())


def require_fields(typed: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Keep rows whose date, carrier, origin and destination are all present."""
    return typed.dropna(how="any", subset=fields or REQUIRED_FIELDS)


def add_derived(
    typed: DataFrame,
    *,
    null_bucket: str | None = S.BUCKET_EXTREME,
    security_cause: bool = False,
) -> DataFrame:
    """Add total_delay, is_delayed, delay_bucket, primary_delay_cause, year, month.

    The five-way maximum of the causes is computed once in an inner projection
    and referenced by each branch of the cause rule.
    """
    base = [c for c in typed.columns if c not in DERIVED_COLUMNS]
    with_max = typed.select(*base, largest_cause().alias("_largest_cause"))
    return with_max.select(
        *base,
        total_delay().alias("total_delay"),
        is_delayed().alias("is_delayed"),
        delay_bucket(null_bucket=null_bucket).alias("delay_bucket"),
        primary_delay_cause(
            "_largest_cause", security="security_delay" if security_cause else None
        ).alias("primary_delay_cause"),
        F.year("fl_date").alias("year"),
        F.month("fl_date").alias("month"),
    )


def clean(
    raw: DataFrame,
    *,
    null_bucket: str | None = S.BUCKET_EXTREME,
    security_cause: bool = False,
) -> DataFrame:
    """Full raw → clean transform: rename, cast, require fields, derive."""
    typed = cast_types(rename_columns(raw))
    return add_derived(require_fields(typed), null_bucket=null_bucket, security_cause=security_cause)


def is_cancelled(cancelled: Column | str = "cancelled") -> Column:
    """True for a cancelled flight: flag present and not zero."""
    c = F.col(cancelled) if isinstance(cancelled, str) else cancelled
    return c.isNotNull() & (c != 0)


def split_cancelled(clean_df: DataFrame, cancelled: str = "cancelled") -> tuple[DataFrame, DataFrame]:
    """(operated, cancelled): two complementary filters over one frame.

    Every row goes to exactly one side; a null flag counts as operated.
    """
    flag = is_cancelled(cancelled)
    return clean_df.filter(~flag), clean_df.filter(flag)


def cancelled_by_code(clean_df: DataFrame) -> DataFrame:
    """Cancelled flights counted per cancellation code (null code kept)."""
    _, cancelled = split_cancelled(clean_df)
    return cancelled.groupBy("cancellation_code").agg(F.count(F.lit(1)).alias("cancelled_flights"))


def audit_counts(raw: DataFrame) -> DataFrame:
    """One row: raw rows and rows that survive the clean step, in one pass."""
    typed = cast_types(rename_columns(raw))
    complete = F.lit(True)
    for c in REQUIRED_FIELDS:
        complete = complete & F.col(c).isNotNull()
    return typed.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count(F.when(complete, F.lit(1))).alias("clean_rows"),
    )
