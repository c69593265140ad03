"""Invariants across layers, and brute-force checks of the rules on small inputs.

The brute-force side recomputes each rule in plain Python/pandas on the
collected rows of a small fixture; the Spark side is the library.
"""

import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pytest
from paths import TESTDATA_SMALL
from flightlines import flight
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tarmac import schema as S
from tarmac.operators import clean as C
from tarmac.operators import marts, staging
from tarmac.plans.models import from_test_data


@pytest.fixture(scope="module")
def models(spark):
    return from_test_data(spark, TESTDATA_SMALL)


class TestLayerInvariants:
    def test_buckets_partition_clean_rows(self, models):
        counts = {r["delay_bucket"]: r["count"] for r in models.clean.groupBy("delay_bucket").count().collect()}
        assert set(counts) <= set(S.DELAY_BUCKETS)
        assert sum(counts.values()) == models.clean.count()

    def test_operated_plus_cancelled_is_clean(self, models):
        operated, cancelled = C.split_cancelled(models.clean)
        assert operated.count() + cancelled.count() == models.clean.count()
        assert cancelled.count() > 0

    def test_report_totals_equal_fact_rows(self, models):
        n_fact = models.fact.count()
        by_carrier = models.carrier_report.agg({"total_flights": "sum"}).first()[0]
        by_month = models.trend_report.agg({"total_flights": "sum"}).first()[0]
        assert n_fact == by_carrier == by_month > 0

    def test_dedupe_keeps_one_row_per_key(self, models):
        assert staging.dedupe(models.staging).count() == models.staging.select("flight_id").distinct().count()

    def test_fact_keeps_every_staging_row(self, models):
        assert models.fact.count() == models.staging.count()


def round_half_up(series: pd.Series, digits: int) -> list:
    """SQL ROUND: half away from zero on the shortest decimal form (numpy rounds half to even)."""
    q = Decimal(1).scaleb(-digits)
    return [
        None if pd.isna(v) else float(Decimal(repr(float(v))).quantize(q, rounding=ROUND_HALF_UP)) for v in series
    ]


@pytest.fixture(scope="module")
def fact_pd(models):
    """Fact rows in pandas, float columns widened to float64 as Spark's averages are."""
    pdf = models.fact.toPandas()
    floats = pdf.select_dtypes("float32").columns
    return pdf.astype({c: "float64" for c in floats})


class TestReportsAgainstPandas:
    def test_carrier_report(self, models, fact_pd):
        got = models.carrier_report.toPandas().set_index("carrier_code").sort_index()
        g = fact_pd.groupby("carrier_code")
        exp = pd.DataFrame(
            {
                "total_flights": g.size(),
                "delayed_flights": g["is_delayed"].sum(),
                "avg_arr_delay_min": round_half_up(g["arr_delay"].mean(), 2),
                "avg_carrier_delay": round_half_up(g["carrier_delay"].mean(), 2),
                "avg_distance_miles": round_half_up(g["distance"].mean(), 1),
                "earliest_date": g["fl_date"].min(),
            }
        ).sort_index()
        for col in exp.columns:
            assert list(got[col]) == list(exp[col]), col

    def test_trend_rolling_mean(self, models, fact_pd):
        got = models.trend_report.toPandas().sort_values(["flight_year", "flight_month"])
        monthly = fact_pd.groupby(["flight_year", "flight_month"])["arr_delay"].mean().sort_index()
        rolling = monthly.rolling(3, min_periods=1).mean()
        assert list(got["avg_delay_3mo_rolling"]) == round_half_up(rolling, 2)
        zero_filled = (
            fact_pd.assign(c=fact_pd["carrier_delay"].fillna(0.0))
            .groupby(["flight_year", "flight_month"])["c"]
            .mean()
            .sort_index()
        )
        assert list(got["avg_carrier_delay"]) == round_half_up(zero_filled, 2)


# --- Per-row rules against a direct Python statement of them ------------------

DELAY_TEXT = st.one_of(
    st.none(),
    st.integers(min_value=-60, max_value=2000).map(lambda v: f"{v}.0"),
    st.integers(min_value=-120, max_value=400).map(lambda v: f"{v / 2}"),
    st.sampled_from(["abc", "", " 12 "]),
)


def _f32(text):
    if text is None or text == "":
        return None
    try:
        v = np.float32(text.strip())
    except ValueError:
        return None
    return None if math.isnan(v) else float(v)


def _bucket(a):
    if a is None:
        return S.BUCKET_EXTREME
    for bound, label in zip(S.BUCKET_BOUNDS, S.DELAY_BUCKETS):
        if a <= bound:
            return label
    return S.BUCKET_EXTREME


def _cause(carrier, weather, nas, security, late):
    top = max(0.0 if v is None else v for v in (carrier, weather, nas, security, late))
    for label, v in (("Carrier", carrier), ("Weather", weather), ("NAS", nas), ("Late Aircraft", late)):
        if v is not None and v == top:
            return label
    return "Unknown"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[DELAY_TEXT] * 6), min_size=1, max_size=25))
def test_derived_columns_match_rules(spark, rows):
    names = ["ArrDelay", "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]
    cells = [{**flight(f"WN/{i} DAL-HOU 2022-10-09"), **dict(zip(names, r))} for i, r in enumerate(rows)]
    raw = spark.createDataFrame([tuple(c[k] for k in S.RAW_COLUMNS) for c in cells], S.RAW_SCHEMA)
    out = {r["mkt_carrier_fl_num"]: r for r in C.clean(raw).collect()}
    assert len(out) == len(rows)
    for i, r in enumerate(rows):
        arr, carrier, weather, nas, security, late = (_f32(x) for x in r)
        got = out[i]
        assert got["arr_delay"] == arr
        assert got["total_delay"] == (0.0 if arr is None else arr)
        assert got["is_delayed"] is (arr is not None and arr > 15)
        assert got["delay_bucket"] == _bucket(arr)
        assert got["primary_delay_cause"] == _cause(carrier, weather, nas, security, late)


def test_fact_lookup_every_fixture_carrier(models):
    names = {r["carrier_code"]: r["carrier_name"] for r in models.fact.select("carrier_code", "carrier_name").distinct().collect()}
    known = dict(S.CARRIERS)
    for code, name in names.items():
        assert name == known.get(code, code)
    assert marts.carrier_dimension(models.spark).count() == len(S.CARRIERS)
