"""Parquet tables ordered along a space-filling curve of several columns.

Sorted by carrier and then origin, every row group of a month spans nearly all origins, so a
filter on the origin alone skips nothing. Here each column is cut into cells of about equal
numbers of rows, the bits of a row's cells are interleaved to one number, and rows are range
partitioned and sorted by that: a row group is narrow in every column, and its min/max
statistics let a filter on any of them skip.

Cell borders are approximate quantiles, from one aggregation whose state is bounded whatever
the column holds. They steer the layout only: rows and types are those given.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.sources.parquet import OVERWRITE_DYNAMIC, OVERWRITE_TRUNCATE

CURVE_BITS = 5  # of each column: 32 cells
ACCURACY = 2000  # of the quantiles; their error is 1/2000 of the rows
_PREFIX = 7  # bytes of a text that make its number; texts alike so far lie in one cell


def _number(df: DataFrame, name: str) -> Column:
    """A number that orders rows as column ``name`` does, up to ties."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        digits = F.rpad(F.hex(F.substring(c, 1, _PREFIX)), 2 * _PREFIX, "0")
        return F.conv(digits, 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise ValueError(f"rows cannot be laid out by {name} ({kind.simpleString()})")


def cell_borders(df: DataFrame, columns: list[str], bits: int = CURVE_BITS) -> list[list]:
    """For each column the least numbers of its cells but the first, ascending, distinct; one pass over ``df``."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(_number(df, c), shares, ACCURACY).alias(f"b{k}") for k, c in enumerate(columns)])
    return [sorted(set(b or ())) for b in found.first()]


def _cell(number: Column, borders: list) -> Column:
    """How many borders a number reaches; 0 for a null."""
    reached = F.size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b <= number))
    return F.when(number.isNull(), F.lit(0)).otherwise(reached)


def curve(df: DataFrame, columns: list[str], borders: list[list], bits: int = CURVE_BITS) -> Column:
    """Place of a row on the curve: the bits of its cells, interleaved. A null lies in the first cell."""
    place = []
    for k, (name, own) in enumerate(zip(columns, borders)):
        if not own:
            continue
        cell = _cell(_number(df, name), own)
        place += [
            F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + len(columns) - 1 - k)
            for bit in range(bits)
        ]
    return reduce(lambda a, b: a.bitwiseOR(b), place, F.lit(0).cast("bigint"))


def write_curved(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    cluster_by: list[str],
    *,
    mode: str = OVERWRITE_DYNAMIC,
    bits: int = CURVE_BITS,
    row_group_bytes: int | None = None,
) -> None:
    """Write ``df`` as Snappy Parquet partitioned by ``partition_by``, each partition along the curve of ``cluster_by``.

    ``mode`` is that of :func:`tarmac.sources.parquet.write_partitioned`. ``df`` is read for the
    borders, for the sample of the range partitioning and for the write, so give a stored table.
    Rows of one cell are told apart by their hash, so that neither a large partition nor a
    value in a third of all rows ends in one task. An empty ``df`` replaces no partition.
    """
    if mode not in (OVERWRITE_DYNAMIC, OVERWRITE_TRUNCATE):
        raise ValueError(f"mode must be {OVERWRITE_DYNAMIC!r} or {OVERWRITE_TRUNCATE!r}")
    if bits * len(cluster_by) > 62:
        raise ValueError("too many bits for one place")
    place, tie = "_place", "_tie"
    while {place, tie} & set(df.columns):
        place, tie = "_" + place, "_" + tie
    borders = cell_borders(df, cluster_by, bits)
    placed = df.withColumn(place, curve(df, cluster_by, borders, bits)).withColumn(tie, F.xxhash64(*df.columns))
    keys = [*partition_by, place]
    laid_out = placed.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, *cluster_by).drop(place, tie)
    writer = (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if mode == OVERWRITE_DYNAMIC else "static")
        .option("compression", "snappy")
    )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.partitionBy(*partition_by).parquet(path)


def write_fact_curved(df: DataFrame, path: str, **options) -> None:
    """Fact rows → ``path/flight_year=/flight_month=``, along the curve of carrier, origin."""
    write_curved(df, path, ["flight_year", "flight_month"], ["carrier_code", "origin_airport"], **options)
