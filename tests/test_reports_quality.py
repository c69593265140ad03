import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from tarmac import schema as S
from tarmac.operators import marts, quality, reports

RC_SCHEMA = StructType(
    [
        StructField("carrier_code", StringType()),
        StructField("carrier_name", StringType()),
        StructField("total_flights", LongType()),
        StructField("delayed_flights", LongType()),
        StructField("delay_pct", DoubleType()),
        StructField("avg_arr_delay_min", DoubleType()),
        StructField("avg_carrier_delay", DoubleType()),
        StructField("avg_weather_delay", DoubleType()),
        StructField("avg_nas_delay", DoubleType()),
        StructField("avg_late_aircraft_delay", DoubleType()),
    ]
)


@pytest.fixture()
def rc(spark):
    rows = [
        ("AA", "American Airlines", 100, 30, 30.0, 12.5, 1.0, 2.0, 3.0, 4.0),
        ("DL", "Delta Air Lines", 50, 20, 40.0, 25.25, 5.0, 6.0, 7.0, 8.0),
        ("UA", "United Airlines", 50, 5, 10.0, 25.25, 0.5, 0.5, 0.5, 0.5),
        ("ZZ", "ZZ", 10, 0, 0.0, None, None, None, None, None),
        ("WN", "Southwest Airlines", 40, 4, 10.0, 3.0, 1.0, 1.0, 1.0, 1.0),
        ("B6", "JetBlue Airways", 10, 1, 10.0, 9.99, 1.0, 1.0, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, RC_SCHEMA)


@pytest.fixture()
def rt(spark):
    schema = StructType(
        [
            StructField("year_month", StringType()),
            StructField("month_start_date", DateType()),
            StructField("total_flights", LongType()),
            StructField("avg_carrier_delay", DoubleType()),
            StructField("avg_weather_delay", DoubleType()),
            StructField("avg_nas_delay", DoubleType()),
            StructField("avg_late_aircraft_delay", DoubleType()),
        ]
    )
    rows = [
        ("2023-12", dt.date(2023, 12, 1), 10, 1.0, 2.0, 3.0, 4.0),
        ("2024-01", dt.date(2024, 1, 1), 20, 1.5, 2.5, 3.5, 4.5),
        ("2024-02", dt.date(2024, 2, 1), 30, 0.0, 0.0, 0.0, 0.0),
    ]
    return spark.createDataFrame(rows, schema)


class TestTopNAndKpis:
    def test_top_n_order_and_ties(self, rc):
        got = [r["carrier_code"] for r in reports.top_n_carriers(rc, 3).collect()]
        assert got == ["DL", "UA", "AA"]

    def test_top_n_nulls_last(self, rc):
        got = [r["carrier_code"] for r in reports.top_n_carriers(rc, 6).collect()]
        assert got[-1] == "ZZ"

    def test_top_n_plan_is_take_ordered(self, rc):
        plan = reports.top_n_carriers(rc, 3)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan

    def test_kpis(self, rc):
        k = reports.kpis(rc).first()
        assert k["total_flights"] == 260 and k["delayed_flights"] == 60
        assert k["delay_pct"] == pytest.approx(60 / 260 * 100)
        assert k["avg_arr_delay_min"] == pytest.approx((12.5 + 25.25 + 25.25 + 3.0 + 9.99) / 5)
        assert k["worst_carrier"] == "Delta Air Lines"

    def test_kpis_zero_guard(self, rc):
        k = reports.kpis(rc.filter("false")).first()
        assert k["delay_pct"] == 0.0 and k["total_flights"] is None

    def test_severity(self, rc):
        got = {r["carrier_code"]: r["severity"] for r in reports.severity_band(rc).collect()}
        assert got == {"AA": "medium", "DL": "high", "UA": "high", "ZZ": "low", "WN": "low", "B6": "low"}

    def test_require_rows(self, rc):
        assert reports.require_rows(rc) is rc
        with pytest.raises(ValueError):
            reports.require_rows(rc.filter("false"))

    def test_views(self, rc, spark):
        assert reports.carrier_view(rc).columns == reports.CARRIER_VIEW_COLUMNS


class TestUnpivotsAndFilters:
    def test_cause_breakdown(self, rc):
        out = reports.cause_breakdown(rc, 2)
        assert out.columns == ["carrier_name", "cause", "minutes"]
        rows = {(r["carrier_name"], r["cause"]): r["minutes"] for r in out.collect()}
        assert len(rows) == 8
        assert rows[("Delta Air Lines", "Late Aircraft")] == 8.0
        assert {c for _, c in rows} == {label for _, label in S.CAUSE_REPORT_COLUMNS}

    def test_year_filter_and_years(self, rt):
        assert reports.filter_years(rt, None).count() == 3
        assert reports.filter_years(rt, [2024]).count() == 2
        assert [r["year"] for r in reports.trend_years(rt).collect()] == [2023, 2024]

    def test_cause_trend(self, rt):
        out = reports.cause_trend(rt, [2023])
        assert out.count() == 4
        assert {r["cause"]: r["minutes"] for r in out.collect()}["NAS"] == 3.0


class TestRangeQuery:
    def test_range_carrier_avg(self, spark):
        fact = spark.createDataFrame(
            [
                (dt.date(2024, 1, 5), "AA", "American Airlines", 10.0, 2024, 1),
                (dt.date(2024, 12, 31), "AA", "American Airlines", 30.0, 2024, 12),
                (dt.date(2025, 1, 1), "AA", "American Airlines", 500.0, 2025, 1),
                (dt.date(2024, 6, 1), "DL", "Delta Air Lines", 99.0, 2024, 6),
            ],
            "fl_date date, carrier_code string, carrier_name string, arr_delay double, "
            "flight_year int, flight_month int",
        )
        for partitioned in (False, True):
            out = reports.range_carrier_avg(fact, "2024-01-01", "2024-12-31", "AA", partitioned=partitioned).collect()
            assert [(r["carrier_name"], r["avg_arr_delay"]) for r in out] == [("American Airlines", 20.0)]


class TestQuality:
    def test_unique(self, spark):
        df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
        assert quality.unique(df, "m", "k").first()["failures"] == 1
        keys = quality.duplicate_keys(df, "k").collect()
        assert [(r["k"], r["n_rows"]) for r in keys] == [("a", 2)]

    def test_not_null_one_pass(self, spark):
        df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
        got = {r["column_name"]: r["failures"] for r in quality.not_null(df, "m", ["x", "y"]).collect()}
        assert got == {"x": 1, "y": 2}

    def test_accepted_values_null_passes(self, spark):
        df = spark.createDataFrame([("On time",), ("Late",), (None,)], "b string")
        assert quality.accepted_values(df, "m", "b", S.DELAY_BUCKETS).first()["failures"] == 1

    def test_expression_null_passes(self, spark):
        df = spark.createDataFrame([(50.0,), (101.0,), (-1.0,), (None,)], "delay_pct double")
        out = quality.expression_is_true(df, "m", "delay_pct", "delay_pct >= 0 and delay_pct <= 100")
        assert out.first()["failures"] == 2

    def test_unique_by_hashes_first_equals_the_plain_check(self, spark):
        keys = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("k"))
        nulls = spark.createDataFrame([(None,), (None,)], "k string")
        hot = spark.createDataFrame([("hot",)] * 1000 + [("twice",)] * 2, "k string")
        for rows, failures in ((keys, 0), (keys.unionByName(nulls), 0), (keys.unionByName(hot), 2), (keys.limit(0), 0)):
            for most in (quality.MARKS, 1):
                got = quality.unique_stored(rows, "m", "k", most).collect()
                assert got == quality.unique(rows, "m", "k").collect() and got[0]["failures"] == failures

    def test_unique_by_hashes_first_shuffles_no_key(self, spark, scratch):
        spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k")).write.parquet(f"{scratch}/t")
        rows = spark.read.parquet(f"{scratch}/t")
        plan = quality.unique_stored(rows, "m", "k")._jdf.queryExecution().executedPlan().toString()
        assert "parquet" not in plan  # no hash occurs twice: the table is read once, for its hashes
        twice = rows.unionByName(rows.limit(3))
        plan = quality.unique_stored(twice, "m", "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert plan.index("BroadcastHashJoin") > plan.index("Exchange hashpartitioning(k")  # joined before keys move

    def test_suite_passes_on_clean_reports_and_catches_planted_faults(self, spark, rc, rt):
        dim = marts.carrier_dimension(spark)
        fact = spark.createDataFrame(
            [("k1", dt.date(2024, 1, 1), "AA", "LAX", "JFK", True, S.BUCKET_SEVERE)],
            "flight_id string, fl_date date, carrier_code string, origin_airport string, "
            "dest_airport string, is_delayed boolean, delay_bucket string",
        )
        rt_full = rt.withColumn("month_start_date", F.col("month_start_date"))
        ok = quality.all_checks(fact, dim, rc, rt_full)
        assert quality.failed(ok).count() == 0
        bad_fact = fact.unionByName(
            spark.createDataFrame(
                [("k1", None, "AA", "LAX", "JFK", False, "Sometimes")], fact.schema
            )
        )
        bad_rc = rc.unionByName(rc.limit(1).withColumn("delay_pct", F.lit(140.0)))
        failed = {
            (r["check_name"], r["model"], r["column_name"]): r["failures"]
            for r in quality.failed(quality.all_checks(bad_fact, dim, bad_rc, rt_full)).collect()
        }
        assert failed == {
            ("unique", "fct_flights", "flight_id"): 1,
            ("not_null", "fct_flights", "fl_date"): 1,
            ("accepted_values", "fct_flights", "delay_bucket"): 1,
            ("unique", "rpt_delay_by_carrier", "carrier_code"): 1,
            ("expression_is_true", "rpt_delay_by_carrier", "delay_pct"): 1,
        }
