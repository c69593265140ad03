"""Training over all labelled texts in tasks, and small helpers shared by the trained operators.

Labelled texts are dealt into shards. In a round each shard trains its own copy of the
parameters, starting from the shared ones, and the changes are averaged: local gradient
descent with averaging. No row passes the driver, which keeps the parameters alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable

SHARD_ROWS = 8000  # about so many labelled rows train one copy of the parameters in a round
PART_BYTES = 1 << 25  # of a shard held at once
BITMAP, MAX_BITMAPS = 1 << 15, 1 << 12  # bits of a bitmap of ids, and so many bitmaps (16 MB) at most
BLOCK = 1 << 11  # items of the parameters averaged together
CHANGES = "block int, shard int, items binary, change binary"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def labelled_shards(
    docs: DataFrame, labels: DataFrame, label: str, learnable: Column, pack: Callable | None = None, schema: str = ""
) -> DataFrame:
    """Every labelled text, dealt by a hash of its id into shards of about ``SHARD_ROWS`` rows.

    ``learnable`` is a predicate on doc_id. Of several rows with one id the smallest text
    counts, null texts never do. Rows are (_id, _label, _shard) with ``_text``, or with the columns
    that ``pack`` makes of it; a partition holds whole shards, each ordered by id. They are
    computed once, into the folder all executors share.
    """
    usable = learnable & F.col("doc_id").isNotNull()
    known = (
        labels.filter(usable & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    n = known.count()
    shards = max(1, -(-n // SHARD_ROWS))
    dealt = F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int").alias("_shard")
    texts = docs.filter(usable & F.col("text").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    texts, known = (df.withColumn("_id", F.col("_id").cast(known.schema["_id"].dataType)) for df in (texts, known))
    rows = _likely(texts, known, n).withColumn("_label", F.lit(None).cast("int")).unionByName(known.withColumn("_text", F.lit(None).cast("string")))
    rows = rows.select("*", dealt).repartition(shards, "_shard").groupBy("_shard", "_id")  # the one shuffle of the texts
    rows = rows.agg(F.min("_text").alias("_text"), F.max("_label").alias("_label")).filter("_text IS NOT NULL AND _label IS NOT NULL")
    if pack is not None:
        rows = score_rows(rows, pack, schema, text="_text")
    return durable.cut(rows.sortWithinPartitions("_shard", "_id"))


def _likely(texts: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``texts`` without most rows whose id is not among the ``n`` of ``known``, so that they are not shuffled.

    A bit for each hash of an id, in bitmaps that are broadcast; no row of a known id is lost.
    """
    maps = min(MAX_BITMAPS, max(1, n * 16 // BITMAP))
    bit = F.pmod(F.xxhash64("_id"), F.lit(maps * BITMAP))
    at = [F.floor(bit / BITMAP).alias("_map"), (bit % BITMAP).alias("_bit")]
    bitmaps = known.select(*at).groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    rows = texts.select("*", *at).join(F.broadcast(bitmaps), "_map")
    return rows.filter("getbit(bigint(conv(hex(substring(_bits, int(_bit div 8) + 1, 1)), 16, 10)), int(_bit % 8)) = 1").select("_id", "_text")


def parts(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, int, list[tuple]]]:
    """(shard, index of the first row in its shard, rows as (label, *columns)) of labelled shards.

    A shard of more than ``PART_BYTES`` comes in several parts, so that a task never holds it whole.
    """
    shard, first, rows, size = None, 0, [], 0
    for batch in batches:
        for own, *row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_shard", "_label", *columns))):
            if rows and (own != shard or size >= PART_BYTES):
                yield shard, first, rows
                first, rows, size = (first + len(rows) if own == shard else 0), [], 0
            shard = own
            rows.append(tuple(row))
            size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
    if rows:
        yield shard, first, rows


def learn_shards(batches: Iterator[pa.RecordBatch], columns: list[str], start: Callable, train: Callable) -> Iterator[pa.RecordBatch]:
    """Train a copy of the parameters on each shard; yields how far it moved them.

    ``start()`` gives the parameters as a table of one row for each item and a flat array;
    ``train(parameters, shard, first, rows)`` changes them in place.
    """
    shard, now = None, None

    def moved():
        table, flat = start()
        change = now[0] - table
        items = np.flatnonzero(change.any(1))
        block = items // BLOCK
        for k in np.unique(block).tolist():
            own = items[block == k]
            yield k, shard, own.astype(np.int32).tobytes(), change[own].tobytes()
        yield -1, shard, b"", (now[1] - flat).tobytes()

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            names=["block", "shard", "items", "change"],
        )

    for own, first, rows in parts(batches, columns):
        if own != shard:
            if now is not None:
                yield batch(list(moved()))
            shard, now = own, tuple(a.copy() for a in start())
        train(now, shard, first, rows)
    if now is not None:
        yield batch(list(moved()))


def merge_shards(changes: DataFrame, table: np.ndarray, flat: np.ndarray) -> None:
    """Move the parameters by the mean change over the shards, of each item over the shards that changed it.

    Blocks of items are averaged in tasks, in the order of the shards; the driver receives one
    set of parameters, however many shards there are.
    """
    width = table.shape[1]

    def mean(group: pa.Table) -> pa.Table:
        group = group.sort_by("shard")
        block = group.column("block")[0].as_py()
        changes = [np.frombuffer(c, np.float32) for c in group.column("change").to_pylist()]
        if block < 0:
            items, out = np.empty(0, np.int32), sum(c.astype(np.float64) for c in changes) / len(changes)
        else:
            total, times = np.zeros((BLOCK, width)), np.zeros(BLOCK, np.int64)
            for own, c in zip(group.column("items").to_pylist(), changes):
                at = np.frombuffer(own, np.int32) - block * BLOCK
                total[at] += c.reshape(-1, width)
                times[at] += 1
            at = np.flatnonzero(times)
            items, out = (at + block * BLOCK).astype(np.int32), total[at] / times[at, None]
        return pa.table(
            {
                "block": pa.array([block], pa.int32()),
                "items": pa.array([items.tobytes()], pa.binary()),
                "change": pa.array([out.astype(np.float32).tobytes()], pa.binary()),
            }
        )

    merged = changes.groupBy("block").applyInArrow(mean, "block int, items binary, change binary")
    for r in merged.toLocalIterator():
        change = np.frombuffer(r["change"], np.float32)
        if r["block"] < 0:
            flat += change
        else:
            table[np.frombuffer(r["items"], np.int32)] += change.reshape(-1, width)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learnable: Column,
    max_rows: int,
    max_text_bytes: int,
    even: bool = False,
) -> DataFrame:
    """At most ``max_rows`` labelled rows (doc_id, text, label), chosen by a hash of the id.

    ``learnable`` is a predicate on the labels' doc_id. Texts over ``max_text_bytes`` are not
    learned from (they are scored like any other); of several rows with one id the smallest
    text counts. Both bounds hold at any size of the input, so the sample fits the driver; the
    labels side of the join has at most ``max_rows`` rows. ``even`` takes at most half of them
    from either label.
    """
    known = (
        labels.filter(learnable & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label).cast("int").alias("_label"))
    )
    first = lambda some, n: some.orderBy(F.xxhash64("_id"), "_id").limit(n)
    if even:
        sides = [first(known.filter(F.col("_label") == y), max_rows // 2) for y in (0, 1)]
        picked = sides[0].unionByName(sides[1])
    else:
        picked = first(known, max_rows)
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).filter(
        F.octet_length("_text") <= max_text_bytes
    )
    return rows.join(F.broadcast(picked), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def score_rows(
    docs: DataFrame, score: Callable, schema: str, text: str = "text", max_bytes: int = 1 << 20, keep_text: bool = False
) -> DataFrame:
    """Append columns computed from whole texts, chunk by chunk, in Arrow tasks.

    ``score(chunk)`` returns a dict of arrays, one value per row. All columns of ``docs``
    are kept, ``text`` only if ``keep_text``.
    """
    from tarmac.llm import textnum

    kept = [c for c in docs.columns if keep_text or c != text]
    fields = {k: docs.schema[k] for k in kept}
    ddl = ", ".join([f"`{k}` {f.dataType.simpleString()}" for k, f in fields.items()] + [schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            rest = batch.select(kept)
            for chunk in textnum.chunks(column, max_bytes):
                out = score(chunk)
                part = rest.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(v if isinstance(v, pa.Array) else pa.array(v) for v in out.values())],
                    names=[*kept, *out],
                )

    return docs.mapInArrow(run, ddl)
