"""Staging, fact and reports over flights written as short lines."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.operators import clean as C
from tarmac.operators import marts, staging

DAY = "2021-07-04"


def staged(raw, **kw):
    return staging.stage(C.clean(raw), **kw)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_schema(flights):
    out = staged(flights(f"HA/118 HNL-OGG {DAY}"))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in S.STAGING_SCHEMA]


def test_key_hashes_five_parts_and_names_a_missing_one(flights):
    out = staged(flights(f"HA/118 HNL-OGG {DAY}", f"HA/? KOA-OGG {DAY}")).orderBy("origin_airport")
    texts = ["2021-07-04-HA-118-HNL-OGG", "2021-07-04-HA-_dbt_utils_surrogate_key_null_-KOA-OGG"]
    assert [r["flight_id"] for r in out.collect()] == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_staging_keeps_operated_past_plausible_flights(flights):
    kept = ["off=0 arr=3", "arr=1440 dep=-1440", ""]
    dropped = ["off=1", "arr=1440.5", "dep=-1441", "arr=0 dep=9999"]
    raw = flights(*[f"HA/{i} HNL-OGG {DAY} {cells}" for i, cells in enumerate(kept + dropped)])
    assert sorted(r["flight_number"] for r in staged(raw).collect()) == [0, 1, 2]


def test_as_of_is_exclusive_and_defaults_to_today(flights):
    soon = (dt.date.today() + dt.timedelta(days=40)).isoformat()
    raw = flights(f"HA/1 HNL-OGG {DAY}", "HA/2 HNL-OGG 2021-07-05", f"HA/3 HNL-OGG {soon}")
    assert staged(raw, as_of="2021-07-05").count() == 1
    assert staged(raw, as_of=dt.date(2021, 7, 6)).count() == 2
    assert staged(raw).count() == 2


def test_dedupe_keeps_the_least_row_whatever_the_order(flights):
    lines = [f"HA/118 HNL-OGG {DAY} arr=50 dep=4", f"HA/118 HNL-OGG {DAY} arr=20 dep=9", f"HA/9 HNL-OGG {DAY} arr=1"]
    for order in (lines, lines[::-1]):
        stg = staged(flights(*order))
        out = staging.dedupe(stg)
        assert out.columns == stg.columns
        assert sorted((r["flight_number"], r["dep_delay"], r["arr_delay"]) for r in out.collect()) == [(9, None, 1.0), (118, 4.0, 50.0)]


def test_dedupe_collapses_a_hot_key_before_the_shuffle(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("flight_id"), F.col("id").alias("dep_delay")
    )
    out = staging.dedupe(rows)
    assert out.count() == 20000 - 6667 + 1
    assert out.filter("flight_id = 'hot'").first()["dep_delay"] == 0
    p = plan(out)  # from the bottom up: one row per key in each map task, then the shuffle
    assert p.rindex("WindowGroupLimit") > p.rindex("Exchange hashpartitioning") > p.index("WindowGroupLimit")
    late = staging.dedupe_stored(rows)
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, out.collect()))


def test_fact_names_known_carriers_and_keeps_the_others(flights):
    fact = marts.build_fact(staged(flights(f"HA/1 HNL-OGG {DAY}", f"??/2 HNL-OGG {DAY}")))
    assert fact.columns == S.FACT_COLUMNS
    assert {r["carrier_code"]: r["carrier_name"] for r in fact.collect()} == {"HA": "Hawaiian Airlines", "??": "??"}
    assert {(r["route"], r["year_month"]) for r in fact.collect()} == {("HNL → OGG", "2021-07")}


def test_only_the_literal_dimension_carries_a_broadcast_hint(spark, flights):
    stg = staged(flights(f"HA/1 HNL-OGG {DAY}"))
    built_in = marts.build_fact(stg)
    assert "BroadcastHashJoin" in plan(built_in) and "LeftOuter" in plan(built_in)
    big = spark.range(3_000_000).select(F.col("id").cast("string").alias("carrier_code"), F.lit("x").alias("carrier_name"))
    own = marts.build_fact(stg, big)
    logical = own._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical and "ResolvedHint" in built_in._jdf.queryExecution().analyzed().toString()
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        assert "SortMergeJoin" in plan(marts.build_fact(stg, big))
    finally:
        spark.conf.set(key, before)


@pytest.fixture()
def summer(flights):
    return marts.build_fact(
        staged(
            flights(
                f"HA/1 HNL-OGG {DAY} arr=40 dep=8 carrier=12 miles=100",
                f"HA/2 HNL-OGG {DAY} arr=4 dep=2 miles=101",
                "HA/3 HNL-OGG 2021-08-02 dep=6",
                "HA/4 HNL-OGG 2021-10-11 arr=91 weather=30",
                "AS/5 SEA-HNL 2021-10-12 arr=-5",
            )
        )
    )


def test_carrier_report_skips_unknown_values(summer):
    rc = {r["carrier_code"]: r for r in marts.delay_by_carrier(summer).collect()}
    ha = rc["HA"]
    assert (ha["total_flights"], ha["delayed_flights"], ha["delay_pct"]) == (4, 2, 50.0)
    assert (ha["avg_arr_delay_min"], ha["avg_dep_delay_min"], ha["avg_delay_when_delayed"]) == (45.0, 5.33, 65.5)
    assert (ha["avg_carrier_delay"], ha["avg_weather_delay"], ha["avg_nas_delay"]) == (12.0, 30.0, None)
    assert (ha["avg_distance_miles"], ha["earliest_date"], ha["latest_date"]) == (100.5, dt.date(2021, 7, 4), dt.date(2021, 10, 11))
    assert [r["carrier_code"] for r in marts.sort_carrier_report(marts.delay_by_carrier(summer)).collect()] == ["HA", "AS"]


def test_trend_reads_unknown_causes_as_zero_and_rolls_over_rows(summer):
    rt = marts.sort_trend_report(marts.delay_trend(summer)).collect()
    assert [r["year_month"] for r in rt] == ["2021-07", "2021-08", "2021-10"]
    assert [r["avg_carrier_delay"] for r in rt] == [6.0, 0.0, 0.0]
    assert [r["avg_arr_delay_min"] for r in rt] == [22.0, None, 43.0]
    # September has no row; October's window holds the July and August rows, and August has no mean.
    assert [r["avg_delay_3mo_rolling"] for r in rt] == [22.0, 22.0, 32.5]


def test_partials_give_the_same_reports(summer):
    parts = marts.carrier_month_partials(summer)
    assert sorted(marts.delay_by_carrier_from_partials(parts).collect()) == sorted(marts.delay_by_carrier(summer).collect())
    assert sorted(marts.delay_trend_from_partials(parts).collect()) == sorted(marts.delay_trend(summer).collect())
