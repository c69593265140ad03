"""Dimension, fact and the two report tables (``DataFrame → DataFrame``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.functions import month_start, name_or_code, route, year_month

def _sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def carrier_dimension(spark: SparkSession) -> DataFrame:
    """The 17-row carrier code → name dimension.

    Built as an inline ``VALUES`` table, i.e. a JVM-side local relation:
    broadcasting it needs no Python worker and no input scan.
    """
    rows = ", ".join(f"({_sql_text(code)}, {_sql_text(name)})" for code, name in S.CARRIERS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS carriers(carrier_code, carrier_name)")


def build_fact(stg: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Staging rows left-joined to the carrier dimension, 23 fact columns.

    Unmatched carriers keep their code as the name. The built-in dimension is a
    literal of 17 rows, so it is broadcast and the fact side is never shuffled
    for the lookup. A caller's ``dim`` gets no hint: its statistics and adaptive
    execution decide.
    """
    built_in = dim is None
    dim = carrier_dimension(stg.sparkSession) if built_in else dim
    dim = dim.select(F.col("carrier_code"), F.col("carrier_name").alias("_dim_carrier_name"))
    if built_in:
        dim = F.broadcast(dim)
    joined = stg.join(dim, on="carrier_code", how="left")
    return joined.select(
        "flight_id",
        "fl_date",
        "flight_year",
        "flight_month",
        year_month("fl_date").alias("year_month"),
        "carrier_code",
        name_or_code("_dim_carrier_name", "carrier_code").alias("carrier_name"),
        "origin_airport",
        "dest_airport",
        route("origin_airport", "dest_airport").alias("route"),
        "distance",
        "dep_delay",
        "arr_delay",
        *S.DELAY_CAUSE_COLUMNS,
        "total_delay",
        "is_delayed",
        "delay_bucket",
        "primary_delay_cause",
        "actual_elapsed_time",
    )


def _delay_rate(delayed: Column, total: Column) -> Column:
    return F.round(delayed / total * 100, 2)


def _finish_carrier(rc: DataFrame) -> DataFrame:
    """Round the unrounded carrier measures (``_``-prefixed) to report form."""
    return rc.select(
        "carrier_code",
        "carrier_name",
        "total_flights",
        "delayed_flights",
        _delay_rate(F.col("delayed_flights"), F.col("total_flights")).alias("delay_pct"),
        F.round("_arr", 2).alias("avg_arr_delay_min"),
        F.round("_dep", 2).alias("avg_dep_delay_min"),
        F.round("_arr_delayed", 2).alias("avg_delay_when_delayed"),
        F.round("_carrier", 2).alias("avg_carrier_delay"),
        F.round("_weather", 2).alias("avg_weather_delay"),
        F.round("_nas", 2).alias("avg_nas_delay"),
        F.round("_late_aircraft", 2).alias("avg_late_aircraft_delay"),
        F.round("_distance", 1).alias("avg_distance_miles"),
        "earliest_date",
        "latest_date",
    )


def delay_by_carrier(fact: DataFrame) -> DataFrame:
    """Carrier report: counts, delay rate, averages (null-skipping), date extent.

    One hash aggregation with map-side partial aggregation: each task ships at
    most one row per carrier, whatever the skew between carriers.
    """
    delayed = F.col("is_delayed")
    return _finish_carrier(
        fact.groupBy("carrier_code", "carrier_name").agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.count(F.when(delayed, F.lit(1))).alias("delayed_flights"),
            F.avg("arr_delay").alias("_arr"),
            F.avg("dep_delay").alias("_dep"),
            F.avg(F.when(delayed, F.col("arr_delay"))).alias("_arr_delayed"),
            F.avg("carrier_delay").alias("_carrier"),
            F.avg("weather_delay").alias("_weather"),
            F.avg("nas_delay").alias("_nas"),
            F.avg("late_aircraft_delay").alias("_late_aircraft"),
            F.avg("distance").alias("_distance"),
            F.min("fl_date").alias("earliest_date"),
            F.max("fl_date").alias("latest_date"),
        )
    )


def sort_carrier_report(rc: DataFrame) -> DataFrame:
    """Highest average arrival delay first; nulls last; ties by carrier code."""
    return rc.orderBy(F.desc_nulls_last("avg_arr_delay_min"), F.asc("carrier_code"))


def _finish_trend(monthly: DataFrame, rolling_months: int) -> DataFrame:
    """Round the unrounded monthly measures and add the rolling mean.

    The window runs over one row per month, so its single partition holds a
    few hundred rows at any data size.
    """
    w = Window.orderBy("flight_year", "flight_month").rowsBetween(-(rolling_months - 1), Window.currentRow)
    return monthly.select(
        "year_month",
        "flight_year",
        "flight_month",
        month_start("flight_year", "flight_month").alias("month_start_date"),
        "total_flights",
        "delayed_flights",
        _delay_rate(F.col("delayed_flights"), F.col("total_flights")).alias("delay_pct"),
        F.round("_arr", 2).alias("avg_arr_delay_min"),
        F.round("_dep", 2).alias("avg_dep_delay_min"),
        F.round("_carrier0", 2).alias("avg_carrier_delay"),
        F.round("_weather0", 2).alias("avg_weather_delay"),
        F.round("_nas0", 2).alias("avg_nas_delay"),
        F.round("_late_aircraft0", 2).alias("avg_late_aircraft_delay"),
        F.round(F.avg("_arr").over(w), 2).alias("avg_delay_3mo_rolling"),
    )


def delay_trend(fact: DataFrame, rolling_months: int = 3) -> DataFrame:
    """Monthly report with a rolling mean of the monthly mean arrival delay.

    Cause averages here read a null as 0 (unlike the carrier report). The
    rolling mean is over the previous ``rolling_months - 1`` month *rows* and
    the current one, unweighted, taken over the unrounded monthly means; a
    missing month is skipped, not counted as a gap.
    """
    zero = F.lit(0.0)
    monthly = fact.groupBy("year_month", "flight_year", "flight_month").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count(F.when(F.col("is_delayed"), F.lit(1))).alias("delayed_flights"),
        F.avg("arr_delay").alias("_arr"),
        F.avg("dep_delay").alias("_dep"),
        F.avg(F.coalesce("carrier_delay", zero)).alias("_carrier0"),
        F.avg(F.coalesce("weather_delay", zero)).alias("_weather0"),
        F.avg(F.coalesce("nas_delay", zero)).alias("_nas0"),
        F.avg(F.coalesce("late_aircraft_delay", zero)).alias("_late_aircraft0"),
    )
    return _finish_trend(monthly, rolling_months)


def sort_trend_report(rt: DataFrame) -> DataFrame:
    """Oldest month first."""
    return rt.orderBy("month_start_date")


# --- Incremental form: month x carrier partial aggregates ---------------------
#
# Both reports are functions of per-(carrier, month) sums and counts. A monthly
# run computes these partials for its own months only and replaces them in a
# small partitioned table; the reports are then re-derived from that table
# (carriers x months rows) instead of rescanning the whole fact.

_PARTIAL_MEASURES = {
    "arr": "arr_delay",
    "dep": "dep_delay",
    "carrier": "carrier_delay",
    "weather": "weather_delay",
    "nas": "nas_delay",
    "late_aircraft": "late_aircraft_delay",
    "distance": "distance",
}


def carrier_month_partials(fact: DataFrame) -> DataFrame:
    """Sums and non-null counts per (carrier, month), the reports' building blocks."""
    delayed = F.col("is_delayed")
    measures = []
    for name, col in _PARTIAL_MEASURES.items():
        measures += [F.sum(col).alias(f"{name}_sum"), F.count(col).alias(f"{name}_n")]
    arr_delayed = F.when(delayed, F.col("arr_delay"))
    return fact.groupBy("carrier_code", "carrier_name", "year_month", "flight_year", "flight_month").agg(
        F.count(F.lit(1)).alias("n_flights"),
        F.count(F.when(delayed, F.lit(1))).alias("n_delayed"),
        *measures,
        F.sum(arr_delayed).alias("arr_delayed_sum"),
        F.count(arr_delayed).alias("arr_delayed_n"),
        F.min("fl_date").alias("earliest_date"),
        F.max("fl_date").alias("latest_date"),
    )


def _ratio(num: str, den: str) -> Column:
    return F.try_divide(F.sum(num), F.sum(den))


def delay_by_carrier_from_partials(partials: DataFrame) -> DataFrame:
    """The carrier report from :func:`carrier_month_partials` rows."""
    return _finish_carrier(
        partials.groupBy("carrier_code", "carrier_name").agg(
            F.sum("n_flights").alias("total_flights"),
            F.sum("n_delayed").alias("delayed_flights"),
            *[_ratio(f"{m}_sum", f"{m}_n").alias(f"_{m}") for m in _PARTIAL_MEASURES],
            _ratio("arr_delayed_sum", "arr_delayed_n").alias("_arr_delayed"),
            F.min("earliest_date").alias("earliest_date"),
            F.max("latest_date").alias("latest_date"),
        )
    )


def delay_trend_from_partials(partials: DataFrame, rolling_months: int = 3) -> DataFrame:
    """The trend report from :func:`carrier_month_partials` rows."""

    def zero_filled(m: str) -> Column:
        return F.try_divide(F.coalesce(F.sum(f"{m}_sum"), F.lit(0.0)), F.sum("n_flights"))

    monthly = partials.groupBy("year_month", "flight_year", "flight_month").agg(
        F.sum("n_flights").alias("total_flights"),
        F.sum("n_delayed").alias("delayed_flights"),
        _ratio("arr_sum", "arr_n").alias("_arr"),
        _ratio("dep_sum", "dep_n").alias("_dep"),
        *[zero_filled(m).alias(f"_{m}0") for m in ("carrier", "weather", "nas", "late_aircraft")],
    )
    return _finish_trend(monthly, rolling_months)
