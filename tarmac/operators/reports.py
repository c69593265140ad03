"""Report reads: views, KPIs, top-N, unpivots and filters over the report tables.

Every function returns a Spark ``DataFrame``; nothing is collected. Report
tables hold one row per carrier or per month, so these are cheap; the range
query reads the fact and relies on partition and row-group pruning.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.functions import months_between_predicate, severity
from tarmac.operators.marts import sort_carrier_report, sort_trend_report

CARRIER_VIEW_COLUMNS = [
    "carrier_code",
    "carrier_name",
    "total_flights",
    "delayed_flights",
    "delay_pct",
    "avg_arr_delay_min",
    "avg_carrier_delay",
    "avg_weather_delay",
    "avg_nas_delay",
    "avg_late_aircraft_delay",
]

TREND_VIEW_COLUMNS = [
    "year_month",
    "month_start_date",
    "total_flights",
    "delayed_flights",
    "delay_pct",
    "avg_arr_delay_min",
    "avg_carrier_delay",
    "avg_weather_delay",
    "avg_nas_delay",
    "avg_late_aircraft_delay",
    "avg_delay_3mo_rolling",
]

DEFAULT_TOP_N = 10


def carrier_view(rc: DataFrame) -> DataFrame:
    """The carrier report's dashboard columns, worst average delay first."""
    return sort_carrier_report(rc.select(*CARRIER_VIEW_COLUMNS))


def trend_view(rt: DataFrame) -> DataFrame:
    """The trend report's dashboard columns, oldest month first."""
    return sort_trend_report(rt.select(*TREND_VIEW_COLUMNS))


def require_rows(df: DataFrame, what: str = "report") -> DataFrame:
    """Raise when ``df`` is empty (a run that produced nothing); else return it."""
    if df.isEmpty():
        raise ValueError(f"No data found in {what}; has the monthly run completed?")
    return df


def top_n_carriers(rc: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """The ``n`` carriers with the highest average arrival delay (ties by code).

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps
    its own top ``n``, the driver merges ``n`` rows per task.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    return sort_carrier_report(rc).limit(n)


def severity_band(rc: DataFrame) -> DataFrame:
    """Each carrier's average delay with its band: high (>20), medium (>10), low."""
    return rc.select(
        "carrier_code",
        "carrier_name",
        "avg_arr_delay_min",
        severity("avg_arr_delay_min").alias("severity"),
    )


def _cause_stack(df: DataFrame, ids: list[str]) -> DataFrame:
    """Unpivot the four cause averages into (cause label, minutes) rows."""
    labelled = df.select(*ids, *[F.col(c).alias(label) for c, label in S.CAUSE_REPORT_COLUMNS])
    return labelled.unpivot(ids, [label for _, label in S.CAUSE_REPORT_COLUMNS], "cause", "minutes")


def cause_breakdown(rc: DataFrame, n: int = DEFAULT_TOP_N) -> DataFrame:
    """Top-``n`` carriers' four cause averages as (carrier_name, cause, minutes)."""
    return _cause_stack(top_n_carriers(rc, n), ["carrier_name"])


def filter_years(rt: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Trend rows whose month falls in one of ``years``; ``None`` keeps all."""
    if years is None:
        return rt
    return rt.filter(F.year("month_start_date").isin([int(y) for y in years]))


def trend_years(rt: DataFrame) -> DataFrame:
    """Distinct years of the trend report, ascending (the filter's options)."""
    return rt.select(F.year("month_start_date").alias("year")).distinct().orderBy("year")


def cause_trend(rt: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Year-filtered trend's cause averages as (month_start_date, cause, minutes)."""
    return _cause_stack(filter_years(rt, years), ["month_start_date"])


def kpis(rc: DataFrame) -> DataFrame:
    """One row of headline numbers from the carrier report.

    ``avg_arr_delay_min`` is the plain mean of the carriers' (rounded)
    averages, as on the dashboard. Those averages are whole cents, so the
    mean sums cents as integers: exact, and the same however the rows are
    partitioned. ``worst_carrier`` is the carrier with the highest average
    (nulls last, ties by code). ``weighted_avg_arr_delay_min`` weighs each
    carrier's average with its flights, also in whole cents. One global
    aggregation.
    """
    total = F.sum("total_flights")
    delayed = F.sum("delayed_flights")
    cents = F.round(F.col("avg_arr_delay_min") * 100).cast("bigint")
    mean_avg = F.sum(cents) / F.count(cents) / 100
    flights = F.when(cents.isNotNull(), F.col("total_flights"))
    weighted = F.try_divide(F.sum(cents * flights), F.sum(flights)) / 100
    rank_key = F.struct(
        F.col("avg_arr_delay_min").isNull().alias("no_avg"),
        (-F.col("avg_arr_delay_min")).alias("neg_avg"),
        F.col("carrier_code"),
    )
    return rc.agg(
        total.alias("total_flights"),
        delayed.alias("delayed_flights"),
        F.when(total > 0, delayed / total * 100).otherwise(F.lit(0.0)).alias("delay_pct"),
        mean_avg.alias("avg_arr_delay_min"),
        weighted.alias("weighted_avg_arr_delay_min"),
        F.min_by("carrier_name", rank_key).alias("worst_carrier"),
    )


def range_carrier_avg(
    fact: DataFrame,
    lo: _dt.date | str,
    hi: _dt.date | str,
    carrier_code: str,
    *,
    partitioned: bool = False,
) -> DataFrame:
    """Mean arrival delay by carrier name for one carrier within [lo, hi].

    With ``partitioned=True`` (a fact read from month directories) the month
    predicate is added as well, so whole months outside the range are skipped
    before any file is opened.
    """
    cond = F.col("fl_date").between(F.lit(_date(lo)), F.lit(_date(hi))) & (F.col("carrier_code") == carrier_code)
    if partitioned:
        cond = cond & months_between_predicate(lo, hi, "flight_year", "flight_month")
    return fact.filter(cond).groupBy("carrier_name").agg(F.avg("arr_delay").alias("avg_arr_delay"))


def _date(d: _dt.date | str) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d)
