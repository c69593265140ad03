"""Monthly runs: deliveries are replaced, months are not."""

import datetime as dt

import pytest
from flightlines import write_csv
from pyspark.sql import functions as F

from tarmac.__main__ import main
from tarmac.operators import clean as C
from tarmac.operators import deliveries, intake, marts, staging
from tarmac.plans import monthly
from tarmac.plans.monthly import NoRows, register_tables, run_month
from tarmac.sources import snapshots
from tarmac.sources.raw_csv import read_raw


def lines(month, numbers, carrier="HA", arr=20):
    return [f"{carrier}/{n} HNL-OGG {month}-{n % 27 + 1:02d} arr={arr + n % 50} dep={n % 7} off=0" for n in numbers]


JANUARY = lines("2021-01", range(50))
FEBRUARY = lines("2021-02", range(100, 150))
STRAGGLER = ["AS/900 SEA-HNL 2021-01-31 arr=5 off=0"]


@pytest.fixture()
def deliver(spark, scratch):
    """``deliver(name, lines, **options)`` runs one CSV file into the tables of this test."""

    def run(name, rows, **kw):
        return run_month(spark, write_csv(f"{scratch}/{name}.csv", rows), f"{scratch}/out", **kw)

    return run


def table(spark, result, name):
    return sorted(map(tuple, result.table(name).drop("delivery").collect()), key=str)


def trend(spark, result):
    rows = result.table("rpt_delay_trend").collect()
    return {r["year_month"]: r["total_flights"] for r in rows}


def test_a_straggler_joins_its_month(spark, deliver):
    deliver("2021_01", JANUARY)
    result = deliver("2021_02", FEBRUARY + STRAGGLER)
    assert result.months == [(2021, 1), (2021, 2)]
    assert trend(spark, result) == {"2021-01": 51, "2021-02": 50}


def test_an_unexpected_month_is_rejected_and_counted(spark, deliver):
    deliver("2021_01", JANUARY, run_date=dt.date(2021, 2, 3))
    result = deliver("2021_02", FEBRUARY + STRAGGLER, run_date=dt.date(2021, 3, 3))
    assert (result.raw_rows, result.clean_rows, result.rejected_rows) == (51, 50, 1)
    assert trend(spark, result) == {"2021-01": 50, "2021-02": 50}
    rejected = result.table("rejected").collect()
    assert [r["fl_date"] for r in rejected] == [dt.date(2021, 1, 31)]
    counts = {r["delivery"]: r["rejected_rows"] for r in result.table("deliveries").collect()}
    assert counts[result.delivery] == 1 and len(counts) == 2


def test_a_month_in_two_files(spark, deliver):
    deliver("first", JANUARY[:47])
    result = deliver("second", JANUARY[47:])
    assert trend(spark, result) == {"2021-01": 50}


def test_a_delivery_again_replaces_itself_only(spark, deliver):
    deliver("a", JANUARY[:20] + FEBRUARY[:5])
    before = deliver("b", JANUARY[20:])
    assert trend(spark, before) == {"2021-01": 50, "2021-02": 5}
    same = deliver("a", JANUARY[:20] + FEBRUARY[:5])
    assert table(spark, same, "fct_flights") == table(spark, before, "fct_flights")
    # this time without its February rows and with fewer of January
    less = deliver("a", JANUARY[:3])
    assert less.months == [(2021, 1), (2021, 2)]
    assert trend(spark, less) == {"2021-01": 33}
    assert {r["year_month"] for r in less.table("fct_flights").collect()} == {"2021-01"}


def test_nothing_usable_is_recorded_and_changes_nothing(spark, deliver):
    good = deliver("good", JANUARY)
    with pytest.raises(NoRows):
        deliver("empty", ["HA/1 HNL- 2021-01-05", "/1 HNL-OGG 2021-01-05"])
    assert trend(spark, good) == {"2021-01": 50}
    assert sorted(r["clean_rows"] for r in monthly.table(spark, good.root, "deliveries").collect()) == [0, 50]


def test_a_month_that_filters_empty_disappears(spark, deliver):
    deliver("jan", JANUARY)
    assert trend(spark, deliver("feb", FEBRUARY)) == {"2021-01": 50, "2021-02": 50}
    assert trend(spark, deliver("feb", FEBRUARY, as_of="2021-02-01")) == {"2021-01": 50}


def test_tables_equal_the_direct_computation_and_keep_their_types(spark, deliver, scratch):
    deliver("jan", JANUARY)
    result = deliver("feb", FEBRUARY + STRAGGLER)
    raw = read_raw(spark, [f"{scratch}/jan.csv", f"{scratch}/feb.csv"])
    fact = marts.build_fact(staging.stage(C.clean(raw)))
    named = register_tables(spark, f"{scratch}/out", "ontime_test")
    expected = {
        "fct_flights": fact,
        "rpt_delay_by_carrier": marts.delay_by_carrier(fact),
        "rpt_delay_trend": marts.delay_trend(fact),
    }
    for name, df in expected.items():
        stored = spark.table(f"ontime_test.{name}").select(*df.columns)
        assert stored.dtypes == df.dtypes, name
        assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, df.collect()), key=str), name
        assert name in named
    assert all(r["failures"] == 0 for r in result.checks.collect())
    assert result.failed_checks().count() == 0
    spark.sql("DROP DATABASE ontime_test CASCADE")


def test_own_dimension(spark, deliver):
    dim = spark.createDataFrame([("HA", "Aloha")], "carrier_code string, carrier_name string")
    result = deliver("jan", JANUARY, dim=dim)
    assert {r["carrier_name"] for r in result.table("rpt_delay_by_carrier").collect()} == {"Aloha"}


def test_months_predicate_prunes_directories(spark, deliver):
    deliver("jan", JANUARY)
    result = deliver("feb", FEBRUARY)
    read = result.table("clean").filter(monthly._months_predicate([(2021, 2)], "year", "month"))
    p = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "PartitionFilters: []" not in p
    assert read.count() == 50


def test_merge_keeps_other_deliveries(spark):
    stored = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "delivery string, n int")
    again = spark.createDataFrame([("a", 7)], "delivery string, n int")
    assert sorted(map(tuple, deliveries.merge(stored, again).collect())) == [("a", 7), ("b", 3)]
    assert deliveries.delivery_id("x/2021/01/") == deliveries.delivery_id("x/2021/01") != deliveries.delivery_id("y/2021/01")


def test_merge_does_not_shuffle_by_delivery(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if incoming rows were estimated too large
    try:
        stored = spark.createDataFrame([("a", 1), ("b", 3), (None, 4), (None, 4)], "delivery string, n int")
        merged = deliveries.merge(stored, spark.createDataFrame([("a", 7), ("a", 7), (None, 9)], "delivery string, n int"))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert sorted(map(str, map(tuple, merged.collect()))) == sorted(map(str, [("a", 7), ("a", 7), ("b", 3), (None, 4), (None, 4), (None, 9)]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_command_line(spark, scratch, capsys):
    import os

    os.makedirs(f"{scratch}/raw/2021/01")
    write_csv(f"{scratch}/raw/2021/01/flights.csv", JANUARY)
    code = main(["--raw-root", f"{scratch}/raw", "--output", f"{scratch}/cli", "--run-date", "2021-02-10", "--database", "cli_test"])
    assert code == 0 and "50 raw, 50 clean, 0 rejected" in capsys.readouterr().out
    assert spark.table("cli_test.fct_flights").filter(F.col("flight_month") == 1).count() == 50
    spark.sql("DROP DATABASE cli_test CASCADE")


def fates(spark, root):
    return {name: monthly.table(spark, root, name).count() for name in ("clean", "rejected", "dropped")}


MIXED = FEBRUARY + STRAGGLER + ["HA/1 HNL- 2021-02-05 arr=x", "/2 HNL-OGG 2021-02-05", "HA/3 HNL-OGG 2021-02-30", "HA/4 HNL-OGG 2021-02-06 dep=n/a"]


def test_every_raw_row_is_kept_under_its_fate(spark, deliver, scratch):
    result = deliver("feb", MIXED, run_date=dt.date(2021, 3, 3))
    assert (result.raw_rows, result.clean_rows, result.rejected_rows, result.dropped_rows) == (55, 51, 1, 3)
    assert result.raw_rows == read_raw(spark, f"{scratch}/feb.csv").count() == sum(fates(spark, result.root).values())
    dropped = {r["raw_cells"]["mkt_carrier_fl_num"]: (r["reasons"], r["raw_cells"]["fl_date"]) for r in result.table("dropped").collect()}
    assert dropped == {
        "1": ("missing:dest,malformed:arr_delay", "2021-02-05"),
        "2": ("missing:mkt_carrier", "2021-02-05"),
        "3": ("malformed:fl_date", "2021-02-30"),
    }
    kept = snapshots.read(spark, result.root, snapshots.version(spark, result.root), "intake", monthly.INTAKE_SCHEMA)
    counts = {(r["fate"], r["reason"]): r["n_rows"] for r in intake.reason_counts(kept).collect()}
    assert counts[("accepted", "malformed:dep_delay")] == 1 and counts[("dropped", "malformed:fl_date")] == 1
    assert result.preview(3).count() == 3 and result.preview().schema == result.table("clean").schema


def raw_scans(spark, kind, before):
    """Executions since ``before`` whose plan scans the raw source."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    return sum(kind in runs.apply(k).physicalPlanDescription() for k in range(before, runs.size()))


@pytest.mark.parametrize("archives, kind", [(False, "Scan csv"), (True, "BatchScan zip_members")])
def test_the_raw_source_is_scanned_once(spark, scratch, archives, kind):
    import zipfile

    file = write_csv(f"{scratch}/m.csv", MIXED)
    with zipfile.ZipFile(f"{scratch}/m.zip", "w") as z:
        z.write(file, arcname="m.csv")
    before = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    result = run_month(spark, f"{scratch}/m.zip" if archives else file, f"{scratch}/out", run_date=dt.date(2021, 3, 3), archives=archives)
    assert result.dropped_rows == 3
    assert raw_scans(spark, kind, before) == 1


STEPS = ["intake", "deliveries", "fct_flights", "agg_carrier_month", "rpt_delay_by_carrier", "rpt_delay_trend", "dq_results"]


def everything(spark, root):
    return {name: sorted(map(str, monthly.table(spark, root, name).collect())) for name in monthly.schemas(spark)}


def test_a_run_killed_at_any_step_leaves_the_old_tables_whole(spark, deliver, flights, scratch):
    good = deliver("jan", JANUARY)
    whole = everything(spark, good.root)

    class Killed(Exception):
        pass

    for last in STEPS:
        seen = []

        def kill(step, last=last, seen=seen):
            seen.append(step)
            if step == last:
                raise Killed

        with pytest.raises(Killed):
            monthly.process_deliveries(spark, {"feb": flights(*FEBRUARY)}, good.root, on_step=kill)
        assert seen == STEPS[: STEPS.index(last) + 1]
        assert everything(spark, good.root) == whole, last
    (after,) = monthly.process_deliveries(spark, {"feb": flights(*FEBRUARY)}, good.root)
    assert trend(spark, after) == {"2021-01": 50, "2021-02": 50}
    kept = everything(spark, good.root)
    assert len(snapshots.vacuum(spark, good.root, keep=1)) > len(STEPS)  # what the killed runs and the first left
    assert everything(spark, good.root) == kept


def test_two_runs_of_a_month_at_once_lose_no_row(spark, flights, scratch):
    import threading

    root, gate, results = f"{scratch}/out", threading.Barrier(2, timeout=300), {}
    halves = {"a": flights(*JANUARY[:20]), "b": flights(*JANUARY[20:])}

    def run(name):
        met = []

        def wait(step):  # both have read the same version before either commits
            if step == "dq_results" and not met:
                met.append(gate.wait())

        results[name] = monthly.process_deliveries(spark, {name: halves[name]}, root, on_step=wait)[0]

    threads = [threading.Thread(target=run, args=(n,)) for n in halves]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r.version for r in results.values()) == [1, 2]
    assert {r["year_month"]: r["total_flights"] for r in monthly.table(spark, root, "rpt_delay_trend").collect()} == {"2021-01": 50}
    assert monthly.table(spark, root, "fct_flights").count() == 50


def test_the_catalog_follows_the_latest_version(spark, deliver, scratch):
    deliver("jan", JANUARY)
    for rows, n in ((FEBRUARY, 100), (FEBRUARY[:10], 60)):
        deliver("feb", rows)
        register_tables(spark, f"{scratch}/out", "swap_test")
        assert spark.table("swap_test.fct_flights").count() == n == spark.table("swap_test.clean").count()
        assert spark.table("swap_test.rpt_delay_trend").selectExpr("sum(total_flights)").first()[0] == n
    spark.sql("DROP DATABASE swap_test CASCADE")
