"""Registered queries: one per operator of the model, over the test tables.

Each query takes ``(spark, sf_dir)``, derives flight rows from that
directory's whole ``lineitem`` table and returns a lazy ``DataFrame``. Keys
match the DuckDB statements in :mod:`tarmac.plans.oracle`.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.functions import previous_month_of
from tarmac.operators import clean as clean_ops
from tarmac.operators import deliveries, intake, marts, quality, reports, staging
from tarmac.plans.models import Models, from_test_data
from tarmac.plans.monthly import previous_month_rows
from tarmac.sources.parquet import conform
from tarmac.sources.fixtures import load_flights_raw

# Query parameters, fixed so that results are repeatable.
PAST_AS_OF = "2001-06-01"
RANGE_LO = "1998-01-01"
RANGE_HI = "1998-12-31"
RANGE_CARRIER = "AA"
SELECTED_YEARS = [1996, 1998, 2000]
RUN_DATE = _dt.date(2001, 6, 5)
TOP_N = 10

IDENTITY = ["fl_date", "mkt_carrier", "mkt_carrier_fl_num", "origin", "dest"]

Query = Callable[[SparkSession, str], DataFrame]


def _m(spark: SparkSession, sf_dir: str) -> Models:
    return from_test_data(spark, sf_dir)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ops.cast_types(clean_ops.rename_columns(load_flights_raw(spark, sf_dir)))


def _staged_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.to_staging_columns(_m(spark, sf_dir).clean)


# --- clean layer ------------------------------------------------------------


def clean_flights(spark, sf_dir):
    return _m(spark, sf_dir).clean


def cast_types(spark, sf_dir):
    return _typed(spark, sf_dir)


def required_fields(spark, sf_dir):
    return clean_ops.require_fields(_typed(spark, sf_dir)).select(*IDENTITY)


def total_delay(spark, sf_dir):
    return _m(spark, sf_dir).clean.select(*IDENTITY, "arr_delay", "total_delay")


def is_delayed(spark, sf_dir):
    return _m(spark, sf_dir).clean.select(*IDENTITY, "arr_delay", "is_delayed")


def delay_bucket(spark, sf_dir):
    return _m(spark, sf_dir).clean.select(*IDENTITY, "arr_delay", "delay_bucket")


def primary_delay_cause(spark, sf_dir):
    return _m(spark, sf_dir).clean.select(*IDENTITY, *S.DELAY_CAUSE_COLUMNS, "primary_delay_cause")


def date_parts(spark, sf_dir):
    return _m(spark, sf_dir).clean.select(*IDENTITY, "year", "month")


def merge_deliveries(spark, sf_dir):
    """Two deliveries that both hold every month; the first arrives again, complete this time."""
    tagged = _m(spark, sf_dir).clean.withColumn("delivery", F.when(F.col("mkt_carrier") < "D", "a").otherwise("b"))
    first = F.col("delivery") == "a"
    stored = tagged.filter(~first | (F.dayofmonth("fl_date") <= 15))
    return deliveries.merge(stored, tagged.filter(first))


def conform_staging(spark, sf_dir):
    return conform(_m(spark, sf_dir).clean, S.STAGING_SOURCE_SCHEMA)


def row_audit(spark, sf_dir):
    return clean_ops.audit_counts(load_flights_raw(spark, sf_dir))


def rejected_reasons(spark, sf_dir):
    """Why rows are dropped and cells emptied, where one month is expected."""
    expected = [previous_month_of(RUN_DATE)]
    return intake.reason_counts(intake.tag(load_flights_raw(spark, sf_dir), expected))


def row_fates(spark, sf_dir):
    """Every raw row under its fate; the three add up to the raw rows."""
    expected = [previous_month_of(RUN_DATE)]
    return intake.tag(load_flights_raw(spark, sf_dir), expected).groupBy("fate").agg(F.count("*").alias("n_rows"))


def cancelled_flights(spark, sf_dir):
    return clean_ops.cancelled_by_code(_m(spark, sf_dir).clean)


def previous_month(spark, sf_dir):
    rows = previous_month_rows(_m(spark, sf_dir).clean, RUN_DATE)
    return rows.select(*IDENTITY, "arr_delay", "year", "month")


# --- staging layer ----------------------------------------------------------


def stg_flights(spark, sf_dir):
    return _m(spark, sf_dir).staging


def surrogate_key(spark, sf_dir):
    return _m(spark, sf_dir).staging.select(
        "flight_id", "fl_date", "carrier_code", "flight_number", "origin_airport", "dest_airport"
    )


def operated_only(spark, sf_dir):
    return staging.operated_only(_staged_unfiltered(spark, sf_dir)).select(
        "flight_id", "carrier_code", "cancelled", "cancellation_code"
    )


def past_dates(spark, sf_dir):
    return staging.before(_staged_unfiltered(spark, sf_dir), PAST_AS_OF).select("flight_id", "fl_date")


def outlier_filter(spark, sf_dir):
    return staging.drop_outliers(_staged_unfiltered(spark, sf_dir)).select("flight_id", "arr_delay", "dep_delay")


def dedupe_flights(spark, sf_dir):
    return staging.dedupe(_m(spark, sf_dir).staging)


# --- marts ------------------------------------------------------------------


def carrier_lookup(spark, sf_dir):
    return _m(spark, sf_dir).fact.select("flight_id", "carrier_code", "carrier_name")


def year_month_route(spark, sf_dir):
    return _m(spark, sf_dir).fact.select(
        "flight_id", "fl_date", "year_month", "origin_airport", "dest_airport", "route"
    )


def fct_flights(spark, sf_dir):
    return _m(spark, sf_dir).fact


def delay_by_carrier(spark, sf_dir):
    return marts.sort_carrier_report(_m(spark, sf_dir).carrier_report)


def delay_trend(spark, sf_dir):
    return marts.sort_trend_report(_m(spark, sf_dir).trend_report)


def delay_by_carrier_incremental(spark, sf_dir):
    """The carrier report as ``run_month`` derives it: via month x carrier partials."""
    partials = marts.carrier_month_partials(_m(spark, sf_dir).fact)
    return marts.sort_carrier_report(marts.delay_by_carrier_from_partials(partials))


def delay_trend_incremental(spark, sf_dir):
    """The trend report as ``run_month`` derives it: via month x carrier partials."""
    partials = marts.carrier_month_partials(_m(spark, sf_dir).fact)
    return marts.sort_trend_report(marts.delay_trend_from_partials(partials))


# --- report reads -----------------------------------------------------------


def report_carrier_view(spark, sf_dir):
    return reports.carrier_view(_m(spark, sf_dir).carrier_report)


def report_trend_view(spark, sf_dir):
    return reports.trend_view(_m(spark, sf_dir).trend_report)


def top_n_carriers(spark, sf_dir):
    return reports.top_n_carriers(_m(spark, sf_dir).carrier_report, TOP_N)


def severity_band(spark, sf_dir):
    return reports.severity_band(_m(spark, sf_dir).carrier_report)


def kpis(spark, sf_dir):
    return reports.kpis(_m(spark, sf_dir).carrier_report)


def cause_breakdown(spark, sf_dir):
    return reports.cause_breakdown(_m(spark, sf_dir).carrier_report, TOP_N)


def cause_trend(spark, sf_dir):
    return reports.cause_trend(_m(spark, sf_dir).trend_report)


def trend_year_filter(spark, sf_dir):
    return reports.filter_years(_m(spark, sf_dir).trend_report, SELECTED_YEARS)


def trend_years(spark, sf_dir):
    return reports.trend_years(_m(spark, sf_dir).trend_report)


def range_carrier_avg(spark, sf_dir):
    return reports.range_carrier_avg(_m(spark, sf_dir).fact, RANGE_LO, RANGE_HI, RANGE_CARRIER)


# --- data quality -----------------------------------------------------------


def dq_unique(spark, sf_dir):
    m = _m(spark, sf_dir)
    return quality.unique_from_fact(m.fact, m.dim)


def dq_unique_by_hash(spark, sf_dir):
    """A key, and a column that repeats: hashes first, values only where hashes repeat."""
    fact = _m(spark, sf_dir).fact
    columns = ["flight_id", "route"]
    return quality.union_results([quality.unique_stored(fact, "fct_flights", c) for c in columns])


def dq_not_null(spark, sf_dir):
    m = _m(spark, sf_dir)
    return quality.not_null_from_fact(m.fact, m.dim)


def dq_source_not_null(spark, sf_dir):
    return quality.source_not_null_checks(_m(spark, sf_dir).clean)


def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values_checks(_m(spark, sf_dir).fact)


def dq_expression(spark, sf_dir):
    return quality.expression_from_fact(_m(spark, sf_dir).fact)


QUERIES: dict[str, Query] = {
    "clean_flights": clean_flights,
    "cast_types": cast_types,
    "required_fields": required_fields,
    "total_delay": total_delay,
    "is_delayed": is_delayed,
    "delay_bucket": delay_bucket,
    "primary_delay_cause": primary_delay_cause,
    "date_parts": date_parts,
    "merge_deliveries": merge_deliveries,
    "conform_staging": conform_staging,
    "row_audit": row_audit,
    "rejected_reasons": rejected_reasons,
    "row_fates": row_fates,
    "cancelled_flights": cancelled_flights,
    "previous_month": previous_month,
    "stg_flights": stg_flights,
    "surrogate_key": surrogate_key,
    "operated_only": operated_only,
    "past_dates": past_dates,
    "outlier_filter": outlier_filter,
    "dedupe_flights": dedupe_flights,
    "carrier_lookup": carrier_lookup,
    "year_month_route": year_month_route,
    "fct_flights": fct_flights,
    "delay_by_carrier": delay_by_carrier,
    "delay_trend": delay_trend,
    "delay_by_carrier_incremental": delay_by_carrier_incremental,
    "delay_trend_incremental": delay_trend_incremental,
    "report_carrier_view": report_carrier_view,
    "report_trend_view": report_trend_view,
    "top_n_carriers": top_n_carriers,
    "severity_band": severity_band,
    "kpis": kpis,
    "cause_breakdown": cause_breakdown,
    "cause_trend": cause_trend,
    "trend_year_filter": trend_year_filter,
    "trend_years": trend_years,
    "range_carrier_avg": range_carrier_avg,
    "dq_unique": dq_unique,
    "dq_unique_by_hash": dq_unique_by_hash,
    "dq_not_null": dq_not_null,
    "dq_source_not_null": dq_source_not_null,
    "dq_accepted_values": dq_accepted_values,
    "dq_expression": dq_expression,
}
