"""Questions between blocks of documents, answered by hash parts.

Documents are dealt into blocks of bounded size by a hash of the row. A block sends each
hash part one packed message with its distinct keys there, so a key takes part once per
block however often it occurs; the part answers each message in the order of its entries.
Nothing is ever gathered by a raw key, and both sides stay bounded: a block by its bytes,
a part by the number of parts, which grows with the input.

All rounds are one Spark plan; the text is shuffled once, to the blocks, and that exchange
is reused by every round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable, textnum

BLOCK_BYTES = 3 << 20  # text in a block, about
PART_BYTES = 16 << 20  # text for each hash part, about
LEAST = 64  # blocks and parts of a small input

MESSAGE = "part int, block int, data binary"
NO_ID = np.iinfo(np.int64).max  # a null doc_id comes after all others


@dataclass
class Parts:
    """2 ** bits hash parts, asked by so many blocks."""

    bits: int
    n_blocks: int = LEAST

    def split(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        """(part, from, to) of sorted keys."""
        parts = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(keys) else np.empty(0, int)
        return [(int(parts[a]), int(a), int(b)) for a, b in zip(cuts, np.append(cuts[1:], len(keys)))]


def deal(docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> tuple[DataFrame, Parts]:
    """Rows (block, doc_id, text), and the hash parts for their size."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(LEAST, -(-total // block_bytes))
    part_bits = max(LEAST, -(-total // part_bytes)).bit_length()
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")
    rows = docs.select(block.alias("block"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows, Parts(part_bits - 1, n_blocks)


class Block:
    """A block's rows in an order that does not depend on how they arrived."""

    def __init__(self, table: pa.Table):
        order = pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_end")
        table = table.take(order).combine_chunks()
        self.number = table["block"][0].as_py()
        self.doc_id = table["doc_id"]
        self.ids = table["doc_id"].combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.data, at = textnum.string_buffer(table["text"])
        self.data, self.offsets = self.data[at[0] : at[-1]], at - at[0]

    def chunks(self, max_bytes: int = 1 << 20):
        """Runs of rows as chunks, each with the offset of its first byte."""
        row, n = 0, len(self.ids)
        while row < n:
            stop = max(row + 1, int(np.searchsorted(self.offsets, self.offsets[row] + max_bytes, "right")) - 1)
            stop = min(stop, n)
            base = self.offsets[row]
            yield textnum.Chunk(self.data[base : self.offsets[stop]], self.offsets[row : stop + 1] - base, row), base
            row = stop


def later_copies(rows: DataFrame) -> DataFrame:
    """A message to each block with the places of its texts that a smaller doc_id has in full.

    Only ids and digests (MD5 and length) are grouped and joined. Both sides of the join are
    written first and the smallest id of a text is one row there, so a text in a third of all
    rows is split like any skewed join.
    """
    slim = durable.cut(
        rows.select(
            "block",
            F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
            F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"),
            F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"),
        )
    )
    first = durable.cut(
        slim.groupBy("digest", "size").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1")
    )
    copies = slim.join(first, ["digest", "size"]).filter("id > low").select("block", "id", "digest")

    def pack(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy().astype("<i8")
        found = sorted(i.tobytes() + d for i, d in zip(ids, table["digest"].to_pylist()))
        return message([0], table["block"][0].as_py(), [b"".join(found)])

    return copies.groupBy("block").applyInArrow(pack, MESSAGE)


def copy_mask(block: Block, marks: dict[int, bytes]) -> np.ndarray:
    """Which rows of the block ``later_copies`` marked."""
    data = marks.get(0, b"")
    marked = {data[k : k + 24] for k in range(0, len(data), 24)}
    mask = np.zeros(len(block.ids), bool)
    at = block.offsets
    text = memoryview(block.data)
    some = np.frombuffer(b"".join(m[:8] for m in marked), "<i8")
    for k in np.flatnonzero(np.isin(block.ids, some)).tolist():  # the text is digested where the id is marked
        mask[k] = block.ids[k].astype("<i8").tobytes() + hashlib.md5(text[at[k] : at[k + 1]]).digest() in marked
    return mask


def message(parts: list[int], block: int | list[int], data: list[bytes]) -> pa.Table:
    blocks = [block] * len(parts) if isinstance(block, (int, np.integer)) else block
    return pa.table(
        {"part": pa.array(parts, pa.int32()), "block": pa.array(blocks, pa.int32()), "data": pa.array(data, pa.binary())}
    )


def ask(rows: DataFrame, send: Callable[[Block], pa.Table]) -> DataFrame:
    """First round: the messages of every block."""
    return rows.groupBy("block").applyInArrow(lambda t: send(Block(t)), MESSAGE)


def answer(messages: DataFrame, reply: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """One reply to each message: ``reply`` gets the blocks and data of a part, blocks ascending."""

    def run(table: pa.Table) -> pa.Table:
        blocks = table["block"].to_pylist()
        data = table["data"].to_pylist()
        order = sorted(range(len(blocks)), key=blocks.__getitem__)
        blocks, data = [blocks[i] for i in order], [data[i] for i in order]
        return message(table["part"].to_pylist(), blocks, reply(blocks, data))

    return messages.groupBy("part").applyInArrow(run, MESSAGE)


def meet(rows: DataFrame, replies: list[DataFrame], work: Callable[..., pa.Table], schema: str) -> DataFrame:
    """``work(block, *replies)`` for every block; a reply is a dict from part to data."""
    tagged = [r.withColumn("round", F.lit(k)) for k, r in enumerate(replies)]
    both, rounds = tagged[0], len(replies)
    for more in tagged[1:]:
        both = both.unionByName(more)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got: list[dict[int, bytes]] = [{} for _ in range(rounds)]
        for k, part, data in zip(right["round"].to_pylist(), right["part"].to_pylist(), right["data"].to_pylist()):
            got[k][part] = data
        return work(Block(left), *got)

    return rows.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(run, schema)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


# Keys travel as the 40 bits after the part's: a chance meeting only costs an idle check later.


def send_keys(parts: Parts, number: int, keys: np.ndarray, often: np.ndarray, dense: np.ndarray | None = None) -> pa.Table:
    """One message per part: the sorted distinct keys, and for each whether the block alone repeats it, or even crowds it."""
    to, data = [], []
    for part, a, b in parts.split(keys):
        short = (keys[a:b] << np.uint64(parts.bits)) >> np.uint64(24)
        data.append(
            np.uint32(b - a).tobytes()
            + (short >> np.uint64(8)).astype(np.uint32).tobytes()
            + (short & np.uint64(255)).astype(np.uint8).tobytes()
            + pack_bits(often[a:b])
            + (b"" if dense is None else pack_bits(dense[a:b]))
        )
        to.append(part)
    return message(to, number, data)


def reply_shared(crowd: int) -> Callable[[list[int], list[bytes]], list[bytes]]:
    """For each key two bits: it is repeated somewhere; at least ``crowd`` blocks have it, or one crowds it alone."""

    def reply(blocks: list[int], data: list[bytes]) -> list[bytes]:
        keys, often, dense, sizes = [], [], [], []
        for d in data:
            n = int(np.frombuffer(d, np.uint32, 1)[0])
            high = np.frombuffer(d, np.uint32, n, 4).astype(np.uint64)
            low = np.frombuffer(d, np.uint8, n, 4 + 4 * n).astype(np.uint64)
            keys.append((high << np.uint64(8)) | low)
            at = 4 + 5 * n + -(-n // 8)
            often.append(unpack_bits(d[4 + 5 * n : at], n))
            dense.append(unpack_bits(d[at:], n) if len(d) > at else np.zeros(n, bool))
            sizes.append(n)
        _, back, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = (count[back] > 1) | np.concatenate(often)
        hot = count >= crowd
        hot[back[np.concatenate(dense)]] = True
        hot = hot[back]
        ends = np.cumsum(sizes)
        return [pack_bits(np.concatenate((shared[e - n : e], hot[e - n : e]))) for e, n in zip(ends, sizes)]

    return reply


def read_shared(parts: Parts, keys: np.ndarray, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(repeated, crowded) of the sorted distinct keys that ``send_keys`` sent."""
    shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for part, a, b in parts.split(keys):
        bits = unpack_bits(replies[part], 2 * (b - a))
        shared[a:b], hot[a:b] = bits[: b - a], bits[b - a :]
    return shared, hot
