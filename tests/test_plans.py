"""Physical-plan properties the design relies on at scale."""

import pytest
from paths import TESTDATA_SMALL
from pyspark.sql import functions as F

from tarmac.operators import clean, intake, marts, quality, reports, staging
from tarmac.plans import catalog
from tarmac.plans.models import from_test_data
from tarmac.sources.fixtures import load_flights_raw


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def models(spark):
    return from_test_data(spark, TESTDATA_SMALL)


def test_scan_reads_only_needed_lineitem_columns(models):
    p = plan(models.carrier_report)
    read = p.split("ReadSchema: ")[1].split("\n")[0]
    for unused in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]:
        assert unused not in read


def test_fact_join_is_broadcast_no_shuffle_join(models):
    p = plan(models.fact)
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_reports_aggregate_map_side(models):
    for df in (models.carrier_report, models.trend_report):
        p = plan(df)
        assert "partial_count" in p and "partial_avg" in p


def test_dedupe_and_unique_combine_before_shuffle(models):
    p = plan(staging.dedupe(models.staging))
    # Read from the bottom up: ranks are cut to one row per key, then rows are shuffled.
    assert "SortAggregate" not in p and p.rindex("WindowGroupLimit") > p.rindex("Exchange hashpartitioning")
    assert "partial_count" in plan(quality.unique(models.fact, "fct_flights", "flight_id"))


def test_a_stored_table_is_deduplicated_by_hashes_first(spark, models):
    twice = models.staging.unionByName(models.staging.limit(20)).unionByName(models.staging.limit(7).withColumn("arr_delay", F.lit(-99.0).cast("float")))
    late = staging.dedupe_stored(twice)
    assert sorted(map(str, late.collect())) == sorted(map(str, staging.dedupe(twice).collect()))
    first = plan(late).split("HashAggregate")[-1]
    read = first.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_returnflag" in read and "SortAggregate" not in plan(late)


#: The JIT compiles no method above this many bytes.
LARGEST_METHOD = 8000


def method_sizes(spark, df):
    """Bytes of the largest generated method of each whole-stage part of a plan."""
    debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
    parts = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [parts.apply(k)._3().maxMethodCodeSize() for k in range(parts.size())]


def test_generated_methods_are_small_enough_to_be_compiled(spark, tmp_path):
    raw = load_flights_raw(spark, TESTDATA_SMALL)
    raw.write.parquet(f"{tmp_path}/raw")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    assert int(limit) == 65535  # Spark's default: nothing here depends on another
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans show no code before they run
    try:
        for rows in (raw, spark.read.parquet(f"{tmp_path}/raw")):
            cleaned = clean.clean(rows)
            staged = staging.stage(cleaned)
            for df in (cleaned, intake.tag(rows), staged, marts.build_fact(staged)):
                assert 0 < max(method_sizes(spark, df)) < LARGEST_METHOD
        for name, query in catalog.QUERIES.items():
            assert max(method_sizes(spark, query(spark, TESTDATA_SMALL))) < LARGEST_METHOD, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_rolling_window_runs_after_aggregation(models):
    p = plan(models.trend_report)
    assert p.index("Window") < p.index("HashAggregate")  # window sits above the aggregate


def test_top_n_is_take_ordered(models):
    assert "TakeOrderedAndProject" in plan(reports.top_n_carriers(models.carrier_report, 10))


def test_kpis_single_global_aggregate(models):
    p = plan(reports.kpis(models.carrier_report))
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_registered_queries_stay_in_the_jvm_and_never_cross_join(spark):
    for name, fn in catalog.QUERIES.items():
        p = plan(fn(spark, TESTDATA_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_trend_from_partials_windows_months_not_cells(spark, models):
    parts = marts.carrier_month_partials(models.fact)
    p = plan(marts.delay_trend_from_partials(parts))
    assert p.index("Window") < p.index("HashAggregate")
    assert p.count("FileScan") == 1


def test_no_source_repartition_or_metrics_node(spark):
    for name, fn in catalog.QUERIES.items():
        p = plan(fn(spark, TESTDATA_SMALL))
        assert "CollectMetrics" not in p and "REPARTITION" not in p, name


@pytest.fixture(scope="module")
def split_input(spark, tmp_path_factory):
    """The lineitem table as many small files, so that the scan has more splits than cores."""
    base = str(tmp_path_factory.mktemp("split"))
    spark.read.parquet(f"{TESTDATA_SMALL}/lineitem.parquet").repartition(12).write.parquet(f"{base}/lineitem.parquet")
    return base


@pytest.mark.parametrize(
    "query, scans", [("dq_accepted_values", 1), ("dq_not_null", 1), ("dq_expression", 1), ("dq_unique", 2), ("kpis", 1)]
)
def test_checks_scan_the_source_once(spark, split_input, query, scans):
    df = catalog.QUERIES[query](spark, split_input)
    rows = df.collect()
    assert sorted(map(str, rows)) == sorted(map(str, catalog.QUERIES[query](spark, TESTDATA_SMALL).collect()))
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan parquet") - final.count("ReusedExchange") <= scans and final.count("FileScan parquet") <= scans


def test_checks_over_a_fact_equal_the_checks_over_its_reports(models):
    rc, rt = models.carrier_report, models.trend_report
    pairs = [
        (quality.unique_from_fact(models.fact, models.dim), quality.unique_checks(models.fact, models.dim, rc, rt)),
        (quality.not_null_from_fact(models.fact, models.dim), quality.not_null_checks(models.fact, models.dim, rc, rt)),
        (quality.expression_from_fact(models.fact), quality.expression_checks(rc, rt)),
    ]
    for once, apart in pairs:
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, apart.collect()))
