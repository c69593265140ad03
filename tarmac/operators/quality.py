"""Table-level data-quality checks.

Each check is a query whose result is one row per (check, model, column)
with the number of failing rows, so results from several checks and tables
union into one frame. A check passes when ``failures == 0``. Nulls pass
``unique``, ``accepted_values`` and ``expression_is_true``, as in the
warehouse test conventions the models were written against.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema as S

RESULT_COLUMNS = ["check_name", "model", "column_name", "failures"]


def _result(df: DataFrame, check: str, model: str, column: str, failures: Column) -> DataFrame:
    return df.agg(failures.alias("failures")).select(
        F.lit(check).alias("check_name"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-null values of ``column`` that occur more than once.

    Two hash aggregations with map-side combine: a value repeated in a third
    of all rows still reaches the shuffle as one partial count per task.
    """
    dups = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter(F.col("count") > 1)
    return _result(dups, "unique", model, column, F.count(F.lit(1)))


#: Repeated hashes that are broadcast at most, eight bytes each.
MARKS = 1 << 20


def unique_stored(df: DataFrame, model: str, column: str, most_marks: int = MARKS) -> DataFrame:
    """:func:`unique` for a stored table whose values are nearly all different, such as a key.

    A first pass reads the column alone and shuffles eight bytes for each distinct value, to find
    the hashes that occur twice; they are written as a checkpoint, where the session has a
    folder for it, and counted. With none the table passes and is not read again. Up to
    ``most_marks`` are broadcast, and only rows with such a hash are grouped by the value
    itself, so two values that share a hash are told apart. With more, the values repeat so
    often that the plain check moves no more.

    Runs the first pass when called. Nulls pass; an empty table has no failures.
    """
    mark = F.xxhash64(column)
    marks = df.filter(F.col(column).isNotNull()).groupBy(mark.alias("_mark")).agg(F.count("*").alias("_n"))
    repeated = marks.filter("_n > 1").select("_mark")
    if df.sparkSession.sparkContext.getCheckpointDir():  # else the first pass runs again in the join
        repeated = repeated.checkpoint()
    n = repeated.count()
    if n > most_marks:
        return unique(df, model, column)
    if n == 0:
        return _result(df.sparkSession.range(1), "unique", model, column, F.lit(0))
    again = df.select(column).withColumn("_mark", mark).join(F.broadcast(repeated), "_mark", "left_semi")
    return unique(again, model, column)


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """The failing keys of :func:`unique`, with their row counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


#: One check: its name, the model and column it is about, and a predicate true for failing rows.
Check = tuple[str, str, str, Column]


def counted(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Failing rows of every check, all from one aggregation over ``df``."""
    checks = list(checks)
    counts = df.agg(*[F.count_if(failing).alias(f"c{k}") for k, (*_, failing) in enumerate(checks)])
    return _rows(counts, [c[:3] for c in checks])


def _rows(counts: DataFrame, names: list[tuple[str, str, str]]) -> DataFrame:
    """One result row for each column c0, c1, ... of a one-row frame."""
    made = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.coalesce(F.col(f"c{k}"), F.lit(0)).cast("bigint").alias("failures"),
        )
        for k, (check, model, column) in enumerate(names)
    ]
    return counts.select(F.explode(F.array(*made)).alias("r")).select("r.*")


def _null_checks(model: str, columns: Iterable[str]) -> list[Check]:
    return [("not_null", model, c, F.col(c).isNull()) for c in columns]


def _value_check(model: str, column: str, values: Iterable) -> Check:
    c = F.col(column)
    return ("accepted_values", model, column, c.isNotNull() & ~c.isin(list(values)))


def not_null(df: DataFrame, model: str, columns: Iterable[str]) -> DataFrame:
    """Null counts of several columns, all from one scan of ``df``."""
    return counted(df, _null_checks(model, columns))


def accepted_values(df: DataFrame, model: str, column: str, values: Iterable) -> DataFrame:
    """Rows whose non-null ``column`` is outside ``values``."""
    return counted(df, [_value_check(model, column, values)])


def expression_is_true(df: DataFrame, model: str, column: str, expression: str) -> DataFrame:
    """Rows where the SQL ``expression`` is false (null passes)."""
    failing = F.coalesce(F.expr(f"not ({expression})"), F.lit(False))
    return counted(df, [("expression_is_true", model, column, failing)])


def union_results(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


# --- The model test suites --------------------------------------------------


def unique_checks(fact: DataFrame, dim: DataFrame, rc: DataFrame, rt: DataFrame) -> DataFrame:
    return union_results(
        [
            unique(fact, "fct_flights", "flight_id"),
            unique(dim, "dim_carriers", "carrier_code"),
            unique(rc, "rpt_delay_by_carrier", "carrier_code"),
            unique(rt, "rpt_delay_trend", "year_month"),
        ]
    )


FACT_NOT_NULL = ["flight_id", "fl_date", "carrier_code", "origin_airport", "dest_airport"]


def not_null_checks(fact: DataFrame, dim: DataFrame, rc: DataFrame, rt: DataFrame) -> DataFrame:
    return union_results(
        [
            not_null(fact, "fct_flights", FACT_NOT_NULL),
            not_null(dim, "dim_carriers", ["carrier_code", "carrier_name"]),
            not_null(rc, "rpt_delay_by_carrier", ["carrier_code", "total_flights"]),
            not_null(rt, "rpt_delay_trend", ["year_month", "month_start_date"]),
        ]
    )


def source_not_null_checks(staging_source: DataFrame) -> DataFrame:
    return not_null(staging_source, "raw_flights", ["fl_date", "mkt_carrier", "origin", "dest"])


def _fact_value_checks() -> list[Check]:
    return [
        _value_check("fct_flights", "is_delayed", [True, False]),
        _value_check("fct_flights", "delay_bucket", S.DELAY_BUCKETS),
    ]


def accepted_values_checks(fact: DataFrame) -> DataFrame:
    """Both checks from one scan."""
    return counted(fact, _fact_value_checks())


DELAY_PCT_RANGE = "delay_pct >= 0 and delay_pct <= 100"
SOME_FLIGHTS = "total_flights > 0"


def expression_checks(rc: DataFrame, rt: DataFrame) -> DataFrame:
    return union_results(
        [
            expression_is_true(rc, "rpt_delay_by_carrier", "delay_pct", DELAY_PCT_RANGE),
            expression_is_true(rt, "rpt_delay_trend", "total_flights", SOME_FLIGHTS),
        ]
    )


# --- The same suites over a fact alone, without its reports written ------------
#
# Both reports are groups of the fact, so their checks need the groups, not the
# reports: the fact is aggregated once to carrier x month, and grouping sets turn
# those few rows into the rows of either report in one frame.


def report_rows(fact: DataFrame) -> DataFrame:
    """Rows of both reports and one of the fact itself, marked by ``report``: carrier, trend or fact.

    ``total_flights``, ``delay_pct`` and the null counts of the fact's key columns
    (``null_<column>``) are theirs; columns of the other report are null.
    """
    keys = ["carrier_code", "carrier_name", "year_month", "flight_year", "flight_month"]
    nulls = [f"null_{c}" for c in FACT_NOT_NULL]
    cells = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_delayed").alias("n_delayed"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in FACT_NOT_NULL],
    )
    carrier = [F.col(c) for c in keys[:2]]
    month = [F.col(c) for c in keys[2:]]
    rows = cells.groupingSets([carrier, month, []], *carrier, *month).agg(
        F.grouping("carrier_code").alias("_no_carrier"),
        F.grouping("year_month").alias("_no_month"),
        F.sum("n").alias("total_flights"),
        F.round(F.sum("n_delayed") / F.sum("n") * 100, 2).alias("delay_pct"),
        *[F.sum(c).alias(c) for c in nulls],
    )
    report = F.when(F.col("_no_carrier") == 0, "carrier").when(F.col("_no_month") == 0, "trend").otherwise("fact")
    return rows.withColumn("report", report).drop("_no_carrier", "_no_month")


def _on(report: str, checks: Iterable[Check]) -> list[Check]:
    own = F.col("report") == report
    return [(check, model, column, own & failing) for check, model, column, failing in checks]


def unique_from_fact(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """:func:`unique_checks` with two scans: one for the fact's key, one for both reports."""
    value = F.when(F.col("report") == "carrier", F.col("carrier_code")).otherwise(F.col("year_month"))
    repeated = (
        report_rows(fact)
        .filter(F.col("report") != "fact")
        .groupBy("report", value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("value").isNotNull() & (F.col("n") > 1))
    )
    reports = counted(
        repeated,
        [
            ("unique", "rpt_delay_by_carrier", "carrier_code", F.col("report") == "carrier"),
            ("unique", "rpt_delay_trend", "year_month", F.col("report") == "trend"),
        ],
    )
    return union_results([unique(fact, "fct_flights", "flight_id"), unique(dim, "dim_carriers", "carrier_code"), reports])


def not_null_from_fact(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """:func:`not_null_checks` with one scan of the fact."""
    start = F.make_date(F.col("flight_year").cast("int"), F.col("flight_month").cast("int"), F.lit(1))
    rows = report_rows(fact).withColumn("month_start_date", start)
    checks = _on("carrier", _null_checks("rpt_delay_by_carrier", ["carrier_code", "total_flights"])) + _on(
        "trend", _null_checks("rpt_delay_trend", ["year_month", "month_start_date"])
    )
    counts = rows.agg(
        *[F.sum(F.when(F.col("report") == "fact", F.col(f"null_{c}"))).alias(f"c{k}") for k, c in enumerate(FACT_NOT_NULL)],
        *[F.count_if(failing).alias(f"c{len(FACT_NOT_NULL) + k}") for k, (*_, failing) in enumerate(checks)],
    )
    names = [("not_null", "fct_flights", c) for c in FACT_NOT_NULL] + [c[:3] for c in checks]
    return union_results([_rows(counts, names), not_null(dim, "dim_carriers", ["carrier_code", "carrier_name"])])


def expression_from_fact(fact: DataFrame) -> DataFrame:
    """:func:`expression_checks` with one scan of the fact."""
    failing = lambda e: F.coalesce(F.expr(f"not ({e})"), F.lit(False))
    return counted(
        report_rows(fact),
        _on("carrier", [("expression_is_true", "rpt_delay_by_carrier", "delay_pct", failing(DELAY_PCT_RANGE))])
        + _on("trend", [("expression_is_true", "rpt_delay_trend", "total_flights", failing(SOME_FLIGHTS))]),
    )


def all_checks(
    fact: DataFrame, dim: DataFrame, rc: DataFrame, rt: DataFrame, staging_source: DataFrame | None = None
) -> DataFrame:
    """Every model check over written tables; two scans of the fact, a third of its key where hashes repeat.

    Add the source checks when given.
    """
    parts = [
        unique_stored(fact, "fct_flights", "flight_id"),
        unique(dim, "dim_carriers", "carrier_code"),
        unique(rc, "rpt_delay_by_carrier", "carrier_code"),
        unique(rt, "rpt_delay_trend", "year_month"),
        counted(fact, _null_checks("fct_flights", FACT_NOT_NULL) + _fact_value_checks()),
        not_null(dim, "dim_carriers", ["carrier_code", "carrier_name"]),
        not_null(rc, "rpt_delay_by_carrier", ["carrier_code", "total_flights"]),
        not_null(rt, "rpt_delay_trend", ["year_month", "month_start_date"]),
        expression_checks(rc, rt),
    ]
    if staging_source is not None:
        parts.append(source_not_null_checks(staging_source))
    return union_results(parts)


def failed(results: DataFrame) -> DataFrame:
    """Only the failing checks."""
    return results.filter(F.col("failures") > 0)
