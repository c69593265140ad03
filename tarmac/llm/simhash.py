"""SimHash near-duplicates through an index on byte positions, with count filtering.

A fingerprint has 64 bits, that is 8 bytes at 8 positions. Two fingerprints that differ in
at most 3 bits differ in at most 3 bytes, so they share at least 5 of their 8 positional
bytes: that is the guaranteed minimum of matches. An inverted index on single positional
bytes would have only 2,048 lists, each with a share of all documents that never shrinks;
the index here is on 14 sets of four positions, chosen so that any five positions contain
one of them. Within a list the shared positional bytes of each pair are tallied, pairs with
fewer than five are dropped, and the rest are verified bit by bit.

Only distinct fingerprints enter the index, so copies cost nothing. A list emits the edges
that connect its linked fingerprints, not all its pairs. Long lists are split by a fifth
position, which bounds a list by the 2**24 values of the other three bytes; such a list is
searched by flipping bits, not by pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable, graph, textnum

SHINGLE = 3  # words
BITS = 3  # largest distance of a link
SEED = 42
LONG_LIST = 4096  # fingerprints; a longer list is split by a fifth position

#: Four-byte position sets such that any five of the eight positions contain one of them.
#: Five positions split 4+1 or 3+2 over the halves 0-3 and 4-7. A half covers 4+1. For 3+2,
#: the pair of one half belongs to one of three pairings, and any three positions of the
#: other half contain a pair of the pairing with the same number.
_PAIRINGS = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
POSITIONS = [(0, 1, 2, 3), (4, 5, 6, 7)] + [
    (*low, *(4 + p for p in high)) for pairing in _PAIRINGS for low in pairing for high in pairing
]


def chunk_fingerprints(chunk: textnum.Chunk, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each row as unsigned 64-bit numbers; 0 for a text without words."""
    out = np.zeros(len(chunk), np.uint64)
    starts, ends, first = chunk.words()
    n_words = np.diff(first)
    if not len(starts):
        return out
    # The words of each row joined by one space: keep words and the separator just before each but the first.
    data = textnum.LOWER[chunk.data]
    keep = ~textnum.SEPARATOR[data]
    follows = np.ones(len(starts), bool)
    follows[first[:-1][n_words > 0]] = False
    keep[starts[follows] - 1] = True
    data[starts[follows] - 1] = 0x20
    position = np.concatenate(([0], np.cumsum(keep)))
    joined = data[keep].tobytes()
    starts, ends = position[starts], position[ends]
    # A row has its windows, or its whole sequence if that is shorter.
    count = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    begin = np.concatenate(([0], np.cumsum(count)))
    left = np.arange(begin[-1]) - np.repeat(begin[:-1], count) + np.repeat(first[:-1], count)
    right = np.minimum(left + shingle, np.repeat(first[1:], count)) - 1
    pieces = map(joined.__getitem__, map(slice, starts[left].tolist(), ends[right].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(left))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(count)
    ones = np.add.reduceat(bits, begin[full], axis=0, dtype=np.int64)
    majority = (2 * ones > count[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its ``text``, plus ``_fp``: the fingerprint as a signed long."""
    from tarmac.llm import learn

    return learn.score_rows(docs, lambda c: {"_fp": chunk_fingerprints(c, shingle).view(np.int64)}, "_fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def _key(positions, fp: Column) -> Column:
    """The bytes at the positions as one number."""
    parts = [F.shiftleft(_byte(fp, p), 8 * k) for k, p in enumerate(positions)]
    key = parts[0]
    for part in parts[1:]:
        key = key.bitwiseOR(part)
    return key


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the links a-b, on top of ``label``."""
    while True:
        x, y = label[a], label[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            return label
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def _by_pairs(values: np.ndarray, bits: int) -> np.ndarray:
    """Label of each value: tally shared positional bytes of the list's pairs, filter, verify."""
    label = np.arange(len(values))
    by_byte = values.view(np.uint8).reshape(-1, 8)
    step = max(1, (1 << 20) // len(values))
    for lo in range(0, len(values), step):
        tally = (by_byte[lo : lo + step, None, :] == by_byte[None, :, :]).sum(2, dtype=np.uint8)
        a, b = np.nonzero(tally >= 8 - bits)
        a += lo
        a, b = a[a < b], b[a < b]
        near = np.bitwise_count(values[a] ^ values[b]) <= bits
        label = _join_labels(label, a[near], b[near])
    return label


def _by_flips(values: np.ndarray, shared: np.ndarray, bits: int) -> np.ndarray:
    """Label of each value of a long list: look up every change of at most ``bits`` of the unshared bits."""
    order = np.argsort(values)
    values = values[order]
    free = [i for i in range(64) if not int(shared) >> i & 1]
    label = np.arange(len(values))
    for k in range(1, bits + 1):
        for some in combinations(free, k):
            other = values ^ np.uint64(sum(1 << i for i in some))
            at = np.minimum(np.searchsorted(values, other), len(values) - 1)
            hit = np.flatnonzero(values[at] == other)
            label = _join_labels(label, hit, at[hit])
    out = np.empty_like(label)
    out[order] = order[label]
    return out


def _edges(lists: DataFrame, bits: int) -> DataFrame:
    """Edges (a, b) that connect the linked fingerprints of each list (columns fps, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            at = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
            shared = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            from_, to = [], []
            for i in range(len(column)):
                values = flat[at[i] : at[i + 1]]
                label = _by_pairs(values, bits) if len(values) <= LONG_LIST else _by_flips(values, shared[i], bits)
                moved = np.flatnonzero(label != np.arange(len(label)))
                from_.append(values[moved])
                to.append(values[label[moved]])
            if from_:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (from_, to)], names=["a", "b"]
                )

    return lists.mapInArrow(run, "a long, b long")


def _mask(positions) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column _fp), enough to connect all within ``bits`` bits."""
    if bits > 3:
        raise ValueError("the position sets guarantee a shared set up to 3 bits")
    entry = lambda sets: F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("set"), _key(p, F.col("_fp")).alias("key"), F.lit(_mask(p)).alias("shared"))
                for i, p in enumerate(sets)
            ]
        )
    )
    short = nodes.select("_fp", entry(POSITIONS).alias("e")).select("_fp", "e.*")
    sizes = durable.cut(short.groupBy("set", "key").count().filter(f"count > {LONG_LIST}"))
    if sizes.isEmpty():
        lists = short
    else:
        # A linked pair of a long list shares a fifth byte: file its members by each other position.
        fives = sorted({tuple(sorted({*p, q})) for p in POSITIONS for q in range(8) if q not in p})
        members = short.join(sizes, ["set", "key"], "left_semi").select("_fp").distinct()
        lists = short.join(sizes, ["set", "key"], "left_anti").unionByName(
            members.select("_fp", entry(fives).alias("e")).select("_fp", (F.col("e.set") + 100).alias("set"), "e.key", "e.shared")
        )
    lists = (
        lists.groupBy("set", "key", "shared")
        .agg(F.collect_list("_fp").alias("fps"))
        .filter("size(fps) > 1")
        .select("fps", "shared")
    )
    return _edges(lists, bits).distinct()


def _named_components(rows: DataFrame, bits: int) -> DataFrame:
    """(_fp, root, component_id) of each fingerprint of ``rows`` (_fp, doc_id)."""
    nodes = durable.cut(rows.groupBy("_fp").agg(F.min("doc_id").alias("low")))
    roots = graph.components(links(nodes, bits)).withColumnRenamed("node", "_fp")
    rooted = nodes.join(roots, "_fp", "left").withColumn("root", F.coalesce("root", "_fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("_fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Texts without words have the fingerprint 0 and link like any other. A component whose
    rows have no id at all has a null component_id. Repeated rows stay, each with its row.
    Extra columns are ignored.
    """
    rows = durable.cut(fingerprints(docs.select("doc_id", "text"), shingle))
    return rows.join(_named_components(rows, bits), "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs``, all columns, reduced to one row of each component: the smallest doc_id, null ids last.

    Of rows with that id the one with the smallest fingerprint and text hash stays; of rows
    that agree in these too, any.
    """
    digest = F.xxhash64("text").alias("_digest")
    rows = durable.cut(fingerprints(docs.select("doc_id", digest, "text"), shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_fp", "_digest"))
    kept = rows.join(_named_components(rows, bits), "_fp").groupBy("root").agg(first.alias("k"))
    # One pair of keys without nulls serves the join and the removal of repeated rows: one shuffle of the texts.
    kept = kept.select("k.no_id", F.coalesce("k.doc_id", F.lit(0)).alias("_id"), F.col("k._digest").alias("_digest"))
    whole = docs.select(
        F.struct("*").alias("_row"), F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("_id"), digest
    )
    keys = ["no_id", "_id", "_digest"]
    return whole.join(kept, keys, "left_semi").dropDuplicates(keys).select("_row.*")
