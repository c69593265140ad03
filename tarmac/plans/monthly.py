"""``run_month``: one delivery of raw files to reports and checks.

Stages and their tables, each a table of one version (:mod:`tarmac.sources.snapshots`):

    raw CSV / zip ──tag──▶ intake/fate=/delivery=/year=/month=   (every raw row, one pass)
    accepted rows of affected months ──stage, join──▶ fct_flights/flight_year=/flight_month=
    fact months ──aggregate──▶ agg_carrier_month/flight_year=/flight_month=
    all partials ──▶ rpt_delay_by_carrier, rpt_delay_trend       (small, replaced)
    checks ──▶ dq_results; counts ──▶ deliveries/delivery=

The raw source is scanned once: every row is written under its fate, and all counts, the
schema and the preview come from the written files. ``clean``, ``rejected`` (unexpected
months) and ``dropped`` are the intake's three fates.

The unit of replacement is the delivery, not the month. A month may come in several
deliveries, and stragglers of a month in the next one's file: rows are only ever replaced by
the same delivery arriving again. The fact and the partials of every month a delivery holds,
or held before, are rebuilt from all deliveries' accepted rows of that month.

Each stage reads the previous stage's *written* table, so a lost executor costs at most the
stage it was running. Nothing is visible until the last step commits all tables at once; a
run that finds another one committed meanwhile derives its months again from there, with the
raw rows that it has already written. Reports are re-derived from the month x carrier
partials, never by rescanning the whole fact.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac import schema as S
from tarmac.functions import previous_month_of
from tarmac.operators import deliveries, intake, marts, quality, staging
from tarmac.operators.clean import RAW_TO_CLEAN
from tarmac.sources import parquet as pq
from tarmac.sources import snapshots
from tarmac.sources.archives import read_archives
from tarmac.sources.raw_csv import read_raw


@dataclass
class RunResult:
    delivery: str
    months: list[tuple[int, int]]  # rebuilt: those the delivery holds or held before
    raw_rows: int
    clean_rows: int
    rejected_rows: int  # clean rows of unexpected months
    dropped_rows: int  # rows without a required field
    root: str
    version: int  # the version that the run committed
    checks: DataFrame | None  # None where nothing was left to check

    def failed_checks(self) -> DataFrame | None:
        return None if self.checks is None else quality.failed(self.checks)

    def table(self, name: str) -> DataFrame:
        """A table as this run left it."""
        return table(SparkSession.active(), self.root, name, self.version)

    def preview(self, n: int = 5) -> DataFrame:
        """The first rows of the delivery's clean rows; its schema is that of the written table."""
        return self.table("clean").filter(F.col(deliveries.DELIVERY) == self.delivery).limit(n)


FACT_KEYS = ["flight_year", "flight_month"]
CLEAN_TABLE_SCHEMA = StructType([*S.CLEAN_SCHEMA.fields, StructField(deliveries.DELIVERY, StringType(), True)])


class NoRows(ValueError):
    """A delivery without a single usable row."""


INTAKE_KEYS = ["fate", deliveries.DELIVERY, "year", "month"]
INTAKE_SCHEMA = StructType(
    [
        *CLEAN_TABLE_SCHEMA.fields,
        StructField("reasons", StringType(), True),
        StructField(intake.CELLS, StructType([StructField(c, StringType(), True) for c in RAW_TO_CLEAN.values()]), True),
        StructField("fate", StringType(), True),
    ]
)
DELIVERY_COUNTS = "raw_rows bigint, clean_rows bigint, rejected_rows bigint, dropped_rows bigint, delivery string"
FATES = {"clean": intake.ACCEPTED, "rejected": intake.UNEXPECTED, "dropped": intake.DROPPED}


def schemas(spark: SparkSession) -> dict[str, StructType]:
    """The columns of every table."""
    empty = spark.createDataFrame([], S.CLEAN_SCHEMA)
    fact = marts.build_fact(staging.stage(empty))
    refused = StructType([f for f in INTAKE_SCHEMA.fields if f.name != "fate"])
    return {
        "clean": CLEAN_TABLE_SCHEMA,
        "rejected": CLEAN_TABLE_SCHEMA,
        "dropped": refused,
        "intake": INTAKE_SCHEMA,
        "deliveries": StructType.fromDDL(DELIVERY_COUNTS),
        "fct_flights": fact.schema,
        "agg_carrier_month": marts.carrier_month_partials(fact).schema,
        "rpt_delay_by_carrier": marts.delay_by_carrier(fact).schema,
        "rpt_delay_trend": marts.delay_trend(fact).schema,
        "dq_results": StructType.fromDDL("check_name string, model string, column_name string, failures bigint"),
    }


def table(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A table as of a version (default: the latest), by its declared types; empty before the first run."""
    at = snapshots.version(spark, root, number)
    schema = schemas(spark)[name]
    if name not in FATES:
        return snapshots.read(spark, root, at, name, schema)
    wanted = {p for p in at.partitions("intake") if snapshots.values(p)["fate"] == FATES[name]}
    return snapshots.read(spark, root, at, "intake", schema, wanted)


def _months_predicate(months: list[tuple[int, int]], year_col: str, month_col: str) -> Column:
    """Partition predicate selecting exactly ``months`` (prunes directories).

    One flat ``IN`` over ``year * 100 + month``: a backfill of many years stays
    a single set lookup per partition rather than a chain of OR terms.
    """
    keys = sorted({int(y) * 100 + int(m) for y, m in months})
    return (F.col(year_col) * 100 + F.col(month_col)).isin(keys)


def run_month(
    spark: SparkSession,
    raw_path: str | list[str],
    root: str,
    *,
    run_date: _dt.date | None = None,
    delivery: str | None = None,
    as_of: _dt.date | str | None = None,
    archives: bool = False,
    dedupe_keys: bool = False,
    salt_buckets: int | None = None,
    dim: DataFrame | None = None,
) -> RunResult:
    """Process the raw files at ``raw_path`` into the tables under ``root``.

    ``run_date`` says which month is expected, the one before it: rows of other months go to
    the ``rejected`` table and are counted. Without it every month is taken. ``delivery``
    names what a rerun replaces (default: the path). ``as_of`` (default today) bounds flight
    dates in staging; ``archives`` reads zipped archives instead of CSV; ``dedupe_keys``
    keeps one row per flight key; ``salt_buckets`` fixes the number of write tasks per month;
    ``dim`` replaces the built-in carrier dimension. A delivery without a usable row is
    recorded and then raises :class:`NoRows`.
    """
    raw = read_archives(spark, raw_path) if archives else read_raw(spark, raw_path)
    (result,) = process_deliveries(
        spark,
        {delivery or deliveries.delivery_id(raw_path): raw},
        root,
        expected_months=[previous_month_of(run_date)] if run_date else None,
        as_of=as_of,
        dedupe_keys=dedupe_keys,
        salt_buckets=salt_buckets,
        dim=dim,
    )
    if not result.clean_rows:
        raise NoRows(f"no rows survived cleaning in {raw_path} ({result.rejected_rows} of unexpected months)")
    return result


def process_deliveries(
    spark: SparkSession,
    raws: dict[str, DataFrame],
    root: str,
    *,
    expected_months: list[tuple[int, int]] | None = None,
    as_of: _dt.date | str | None = None,
    dedupe_keys: bool = False,
    salt_buckets: int | None = None,
    dim: DataFrame | None = None,
    on_step: Callable[[str], None] | None = None,
) -> list[RunResult]:
    """Raw rows by delivery, from any source, all in one pass and one commit.

    A delivery without usable rows is recorded and changes nothing else. ``on_step`` is told
    what has been written, before anything more is.
    """
    step = on_step or (lambda name: None)
    # 1. raw → every row under its fate; no version names these folders yet.
    tagged = reduce(
        DataFrame.unionByName,
        [intake.tag(raw, expected_months).withColumn(deliveries.DELIVERY, F.lit(name)) for name, raw in raws.items()],
    )
    run = snapshots.new_run()
    pq.write_partitioned(
        tagged, snapshots.folder(root, "intake", run), INTAKE_KEYS, ["mkt_carrier", "origin"],
        mode=pq.OVERWRITE_TRUNCATE, salt_buckets=salt_buckets,
    )
    own = snapshots.written(spark, root, "intake", run, INTAKE_KEYS)
    here = snapshots.read(spark, root, snapshots.Version().replaced("intake", [], run, own), "intake", INTAKE_SCHEMA)
    counts = _counts(here, list(raws))
    step("intake")
    while True:
        results = _derive(spark, raws, root, run, own, counts, as_of, dedupe_keys, salt_buckets, dim, step)
        if results is not None:
            return results


def _counts(rows: DataFrame, names: list[str]) -> dict[str, dict[str, int]]:
    """Rows of each delivery by fate, from the partition keys of the written files."""
    found = {(r[deliveries.DELIVERY], r["fate"]): r["n"] for r in rows.groupBy(deliveries.DELIVERY, "fate").agg(F.count("*").alias("n")).collect()}
    out = {}
    for name in names:
        clean, rejected, dropped = (found.get((name, fate), 0) for fate in FATES.values())
        out[name] = dict(raw_rows=clean + rejected + dropped, clean_rows=clean, rejected_rows=rejected, dropped_rows=dropped)
    return out


def _month(partition: str) -> tuple[int, int]:
    keys = snapshots.values(partition)
    return int(keys["year"]), int(keys["month"])


def _derive(spark, raws, root, run, own, counts, as_of, dedupe_keys, salt_buckets, dim, step) -> list[RunResult] | None:
    """Everything after the intake, from the latest version; None if another run commits first."""
    at = snapshots.version(spark, root)
    mine = [p for p in at.partitions("intake") if snapshots.values(p)[deliveries.DELIVERY] in raws]
    touched = {name: set() for name in raws}
    for partition in [*mine, *own]:
        keys = snapshots.values(partition)
        if keys["fate"] == intake.ACCEPTED:
            touched[keys[deliveries.DELIVERY]].add(_month(partition))
    months = sorted(set().union(*touched.values()))
    at = at.replaced("intake", mine, run, own)
    run = snapshots.new_run()  # of what is derived; the raw rows keep theirs
    rows = [(*c.values(), name) for name, c in counts.items()]
    spark.createDataFrame(rows, DELIVERY_COUNTS).coalesce(1).write.partitionBy(deliveries.DELIVERY).parquet(
        snapshots.folder(root, "deliveries", run)
    )
    recorded = [f"{deliveries.DELIVERY}={name}" for name in raws]
    at = at.replaced("deliveries", recorded, run, recorded)
    step("deliveries")
    checks = None
    if months:
        at, checks = _rebuild(spark, root, at, run, months, as_of, dedupe_keys, salt_buckets, dim, step)
    if not snapshots.commit(spark, root, at):
        return None
    return [
        RunResult(
            delivery=name, months=sorted(touched[name]), root=root, version=at.number + 1,
            checks=checks if touched[name] else None, **counts[name],
        )
        for name in raws
    ]


def _rebuild(spark, root, at, run, months, as_of, dedupe_keys, salt_buckets, dim, step) -> tuple[snapshots.Version, DataFrame]:
    """Fact, partials, reports and checks with ``months`` rebuilt."""
    # 2. affected months of all deliveries → staging → fact months.
    wanted = {p for p in at.partitions("intake") if snapshots.values(p)["fate"] == intake.ACCEPTED and _month(p) in months}
    source = pq.conform(snapshots.read(spark, root, at, "intake", CLEAN_TABLE_SCHEMA, wanted), S.STAGING_SOURCE_SCHEMA)
    staged = staging.stage(source, as_of)
    fact = marts.build_fact(staging.dedupe_stored(staged) if dedupe_keys else staged, dim)
    old = {t: [p for p in at.partitions(t) if _fact_month(p) in months] for t in ("fct_flights", "agg_carrier_month")}

    def replace(name: str, schema: StructType) -> DataFrame:
        """The rows just written of the table, which takes their partitions."""
        nonlocal at
        new = snapshots.written(spark, root, name, run, FACT_KEYS)
        at = at.replaced(name, old[name], run, new)
        step(name)
        return snapshots.read(spark, root, at, name, schema, set(new))

    pq.write_fact(fact, snapshots.folder(root, "fct_flights", run), mode=pq.OVERWRITE_TRUNCATE, salt_buckets=salt_buckets)
    fact_months = replace("fct_flights", fact.schema)

    # 3. fact months → month x carrier partials (replaced the same way).
    partials = marts.carrier_month_partials(fact_months)
    pq.write_partitioned(
        partials, snapshots.folder(root, "agg_carrier_month", run), FACT_KEYS, ["carrier_code"], mode=pq.OVERWRITE_TRUNCATE
    )
    replace("agg_carrier_month", partials.schema)

    # 4. all partials → both reports (tiny inputs, full replace).
    def plain(name: str, df: DataFrame) -> DataFrame:
        nonlocal at
        stored = pq.materialize(df, snapshots.folder(root, name, run))
        at = at.replaced(name, [snapshots.PLAIN], run, [snapshots.PLAIN])
        step(name)
        return stored

    every = snapshots.read(spark, root, at, "agg_carrier_month", partials.schema)
    rc = plain("rpt_delay_by_carrier", marts.sort_carrier_report(marts.delay_by_carrier_from_partials(every)))
    rt = plain("rpt_delay_trend", marts.sort_trend_report(marts.delay_trend_from_partials(every)))

    # 5. checks. Fact checks cover this run's months: the flight key contains
    #    the date, so a duplicate key can only occur within one month.
    used = marts.carrier_dimension(spark) if dim is None else dim
    return at, plain("dq_results", quality.all_checks(fact_months, used, rc, rt, staging_source=source))


def _fact_month(partition: str) -> tuple[int, int]:
    keys = snapshots.values(partition)
    return int(keys["flight_year"]), int(keys["flight_month"])


def register_tables(spark: SparkSession, root: str, database: str = "default") -> dict[str, DataFrame]:
    """The latest version's tables by name in the session's catalog (external, created if needed).

    The catalog is pointed at the folders of that version, partition by partition.
    """
    at = snapshots.version(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    keys = {"fct_flights": FACT_KEYS, "agg_carrier_month": FACT_KEYS, "rpt_delay_by_carrier": [], "rpt_delay_trend": []}
    keys["clean"] = keys["dropped"] = [deliveries.DELIVERY, "year", "month"]
    out = {}
    for name, schema in schemas(spark).items():
        if name not in keys:
            continue
        stored = "intake" if name in FATES else name
        places = {
            p: f"{snapshots.folder(root, stored, r)}/{p}".rstrip("/")
            for p, r in at.partitions(stored).items()
            if name not in FATES or snapshots.values(p)["fate"] == FATES[name]
        }
        base = f"{root.rstrip('/')}/data/{stored}"
        out[name] = pq.as_snapshot_table(spark, schema, f"{database}.{name}", base, keys[name], places)
    return out


def previous_month_rows(df: DataFrame, run_date: _dt.date, year_col: str = "year", month_col: str = "month") -> DataFrame:
    """Rows of the month a run on ``run_date`` loads (the month before it)."""
    return df.filter(_months_predicate([previous_month_of(run_date)], year_col, month_col))
