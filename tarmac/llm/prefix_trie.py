"""Conversation prefix trie with count-min screening of prefix digests.

A conversation's prefixes are keyed by running digests. Most prefixes belong to one
conversation, so a count-min sketch of the digests is built first: an estimate of one proves
a prefix to be a singleton, and all longer prefixes of that conversation with it. Such tails
are nodes of one member and are emitted where they lie. Only prefixes that may be shared are
shuffled, grouped exactly and given their subtree sums.

Subtree sums need no walk over the tree. A node's representative is its smallest member; a
conversation that is the representative at one depth is so at all deeper ones. A node's
leaves are then its members that represent their own, childless end; and ``n_convs - 1``
times the words of a turn is the words of the members that do not represent it, so a sum over
a subtree is, for each member, one difference of running word counts.

Turns are laid out by range over (family, conversation, turn), so that one very long
conversation is split over tasks like any other rows; what a task must know of the ones
before it (three records each) goes through the driver. The running digest is a polynomial
over SHA-256 values of the turns modulo 2**127 - 1, which can be continued from any place.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable

FAMILY = 20  # conversations that share a base
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:15], "big")
BACK = [pow(BASE, -k, PRIME) for k in range(4)]

ROWS_A_TASK = 1_000_000  # turns in a range, about
CELLS_A_PREFIX = 8
MOST_CELLS = 1 << 27  # in each of the sketch's two rows: 32 MB as bits in all
SLICE_BITS = 20  # cells packed together, as a power of two

PREFIXES = (
    "conv_id long, depth long, hi long, lo long, words long, before long, last boolean, opens boolean"
)
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def head_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the base of its family."""
    return zlib.crc32(str(conv_id).encode()) % 4


class _Seen:
    """What is known of one conversation's turns so far: number, digest, words, first three turns."""

    def __init__(self):
        self.count, self.poly, self.words = 0, 0, 0
        self.first: list[tuple[int, int]] = []

    def add(self, count: int, poly: int, words: int, first: list[tuple[int, int]]) -> None:
        self.poly = (self.poly + poly * pow(BASE, self.count, PRIME)) % PRIME
        self.count += count
        self.words += words
        self.first = (self.first + first)[:3]

    def copy(self) -> _Seen:
        other = _Seen()
        other.count, other.poly, other.words, other.first = self.count, self.poly, self.words, list(self.first)
        return other


def _fields(turns: list[bytes]) -> list[int]:
    """A turn's SHA-256 as a number below the modulus, never zero."""
    return [int.from_bytes(t[:16], "big") % (PRIME - 1) + 1 for t in turns]


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(values)]))


def _columns(batches) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray] | None:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return None
    table = pa.Table.from_batches(batches)
    return (
        table["family"].to_numpy(),
        table["conv_id"].to_numpy(),
        table["turn_digest"].to_pylist(),
        table["words"].to_numpy(),
    )


def _edges(batches) -> Iterator[pa.RecordBatch]:
    """Records of a task's first and last conversation, and of the base of its last family."""
    got = _columns(batches)
    if got is None:
        return
    family, conv, digest, words = got
    runs = _runs(conv)
    wanted = {0, len(runs) - 1}
    wanted |= {k for k, (a, _) in enumerate(runs) if family[a] == family[-1] and conv[a] == family[-1]}
    out = {"conv_id": [], "place": [], "count": [], "poly": [], "words": [], "first": []}
    for k in sorted(wanted):
        a, b = runs[k]
        fields, poly = _fields(digest[a:b]), 0
        for f in reversed(fields):
            poly = (poly * BASE + f) % PRIME
        out["conv_id"].append(int(conv[a]))
        out["place"].append(k)
        out["count"].append(b - a)
        out["poly"].append(str(poly))
        out["words"].append(int(words[a:b].sum()))
        out["first"].append([f"{f} {w}" for f, w in zip(fields[:3], words[a:b].tolist())])
    yield pa.RecordBatch.from_pydict(
        out, pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("count", pa.int64()), ("poly", pa.string()), ("words", pa.int64()), ("first", pa.list_(pa.string()))])
    )


def _before(records: list) -> tuple[dict, dict]:
    """For each task what precedes it; and the whole number of turns of conversations seen by several tasks."""
    known: dict[int, _Seen] = {}
    tasks: dict[int, tuple] = {}
    times: dict[int, int] = {}
    for r in sorted(records, key=lambda r: (r["task"], r["place"])):
        c = r["conv_id"]
        if r["place"] == 0:
            base = known.get(c - int(np.fmod(c, FAMILY)))
            tasks[r["task"]] = (known[c].copy() if c in known else None, list(base.first) if base else [])
        first = [tuple(map(int, f.split())) for f in r["first"]]
        known.setdefault(c, _Seen()).add(r["count"], int(r["poly"]), r["words"], first)
        times[c] = times.get(c, 0) + 1
    return tasks, {c: known[c].count for c, n in times.items() if n > 1}


def _prefixes(tasks: dict, totals: dict):
    """Every prefix of every rebuilt conversation, the empty one too, in order of conversation and depth.

    ``before`` is the words of the turns before the prefix's last; ``opens`` is false on a
    row that continues a conversation of the task before.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        got = _columns(batches)
        if got is None:
            return
        family, conv, digest, words = got
        earlier, head = tasks[TaskContext.get().partitionId()]
        out: list[tuple] = []
        current = int(family[0])
        for k, (a, b) in enumerate(_runs(conv)):
            c = int(conv[a])
            seen = earlier if k == 0 and earlier is not None else _Seen()
            fields = list(zip(_fields(digest[a:b]), words[a:b].tolist()))
            if int(family[a]) != current:
                current, head = int(family[a]), []
            if c == current:
                head = (seen.first + fields)[:3]
            total = totals.get(c, seen.count + b - a)
            h = head_turns(c)
            taken = head[:h]
            shift = h - len(taken)
            poly, power, before = 0, 1, 0
            for f, w in taken:
                poly, power, before = (poly + f * power) % PRIME, power * BASE % PRIME, before + w
            depth = len(taken)
            end = depth + max(0, total - h)
            if seen.count == 0:
                out.append((c, 0, 0, 0, 0, end == 0, True))
                p, q, s = 0, 1, 0
                for d, (f, w) in enumerate(taken, 1):
                    p, q = (p + f * q) % PRIME, q * BASE % PRIME
                    out.append((c, d, p, w, s, d == end, True))
                    s += w
            elif seen.count > h:  # own turns of earlier tasks, without those that the head replaces
                own, step = seen.poly, 1
                for f, w in seen.first[:h]:
                    own, step, before = (own - f * step) % PRIME, step * BASE % PRIME, before - w
                poly = (poly + own * BACK[shift]) % PRIME
                before += seen.words
                depth += seen.count - h
                power = pow(BASE, depth, PRIME)
            opens = seen.count == 0
            for f, w in fields[max(0, h - seen.count) :]:
                poly, power, depth = (poly + f * power) % PRIME, power * BASE % PRIME, depth + 1
                out.append((c, depth, poly, w, before, depth == end, opens))
                before += w
                opens = True
        yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    mask, low = (1 << 63) - 1, (1 << 64) - 1
    columns = list(zip(*rows)) or [[]] * 7
    names = ["conv_id", "depth", "hi", "lo", "words", "before", "last", "opens"]
    numbers = [columns[0], columns[1], [p >> 64 & mask for p in columns[2]], [p & low & mask for p in columns[2]], columns[3], columns[4]]
    arrays = [pa.array(n, pa.int64()) for n in numbers] + [pa.array(c, pa.bool_()) for c in columns[5:]]
    return pa.RecordBatch.from_arrays(arrays, names)


def _laid_out(conversations: DataFrame) -> DataFrame:
    """Turns by family and conversation, in order, cut into ranges that do not respect either."""
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col("conv_id").cast("long")
    turns = conversations.select(
        conv.alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    ).filter("conv_id is not null")
    slim = turns.select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"),
        "conv_id",
        "turn",
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("turn_digest"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-conversations.count() // ROWS_A_TASK))
    order = [F.col("family"), F.col("conv_id") != F.col("family"), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_digest")]
    spread = slim.repartitionByRange(tasks, *order, F.rand(13))  # equal turns may part too
    return durable.cut(spread.sortWithinPartitions(*order))


def prefixes(conversations: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation (columns of ``PREFIXES``).

    Turns are ordered by number, null first; turns that share a number by a digest of role
    and text. A null role or text is empty; rows without conv_id belong to no conversation.
    """
    turns = _laid_out(conversations)
    record = "conv_id long, place long, count long, poly string, words long, first array<string>"
    records = turns.mapInArrow(_edges, record).select("*", F.spark_partition_id().alias("task")).collect()
    return durable.cut(turns.mapInArrow(_prefixes(*_before(records)), PREFIXES))


def sketch(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the two sketch rows, one after the other: a cell counts more than one; and a row's cells.

    Counters saturate at two, so a bit each is all that is kept.
    """
    n, at_once = rows.count(), 1 << SLICE_BITS
    cells = at_once
    while cells < min(n * CELLS_A_PREFIX, MOST_CELLS):
        cells *= 2
    cell = F.explode(F.array(F.col("lo") % cells, F.col("hi") % cells + cells))
    full = rows.select(cell.alias("cell")).groupBy("cell").count().filter("count > 1")
    packed = full.groupBy(F.shiftright("cell", SLICE_BITS).alias("slice")).agg(F.collect_list((F.col("cell") % at_once).cast("int")).alias("at"))

    def pack(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for at in batch["at"]:
                bits = np.zeros(at_once, bool)
                bits[at.values.to_numpy()] = True
                data.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch["slice"], pa.array(data, pa.binary())], ["slice", "data"])

    bits = np.zeros((2 * cells // at_once, at_once // 8), np.uint8)
    for row in packed.mapInArrow(pack, "slice long, data binary").toLocalIterator():
        bits[row["slice"]] = np.frombuffer(row["data"], np.uint8)
    return bits.reshape(-1), cells


def _screen(bits, cells: int):
    """Marks the tails: ``tail`` on proved singletons, ``next_tail`` on the row before the first of them."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        look = bits.value
        conv, depth = table["conv_id"].to_numpy(), table["depth"].to_numpy()
        many = np.ones(len(conv), bool)
        for key, offset in (("lo", 0), ("hi", cells)):
            at = table[key].to_numpy() % cells + offset
            many &= (look[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)
        # The empty prefix is everyone's; a row that continues an earlier task's conversation has no row before it here.
        one = ~many & (depth > 0) & table["opens"].to_numpy(zero_copy_only=False)
        first = np.concatenate(([True], conv[1:] != conv[:-1]))
        total = np.cumsum(one)
        start = np.flatnonzero(first)
        run_of = np.cumsum(first) - 1
        tail = total - (total - one)[start][run_of] > 0
        after = np.concatenate((tail[1:] & ~first[1:], [False]))
        last = table["last"].to_numpy(zero_copy_only=False)
        last_after = np.concatenate((last[1:], [False]))
        for name, flags in (("tail", tail), ("inner", tail & np.concatenate(([False], tail[:-1])) & ~first), ("next_tail", after & ~tail), ("next_last", last_after)):
            table = table.append_column(name, pa.array(flags))
        yield from table.to_batches()

    return run


def _pack_ends(batches) -> Iterator[pa.RecordBatch]:
    """Runs of sorted members of a node as joined text, a row for 64 KB at most."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("member", pa.int64()), ("data", pa.string())])
    for batch in batches:
        node = np.stack([batch["conv_id"].to_numpy(), batch["depth"].to_numpy()], 1)
        member = batch["member"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]).any(1)))) if len(member) else []
        out: list[list] = [[], [], [], []]
        for a, b in zip(cuts, [*cuts[1:], len(member)]):
            for k in range(a, b, 3000):
                part = member[k : min(k + 3000, b)].tolist()
                for column, value in zip(out, (int(node[a, 0]), int(node[a, 1]), part[0], ",".join(map(str, part)))):
                    column.append(value)
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, out)), schema)


def _digest_ends(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 over a node's rows, which arrive in order; only the running hash is held."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    key, running = None, None
    for batch in batches:
        out: list[tuple] = []
        for c, d, data in zip(batch["conv_id"].to_pylist(), batch["depth"].to_pylist(), batch["data"].to_pylist()):
            if (c, d) != key:
                if key is not None:
                    out.append((*key, running.hexdigest()))
                key, running = (c, d), hashlib.sha256(data.encode())
            else:
                running.update(b"," + data.encode())
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))), schema)
    if key is not None:
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip((*key, running.hexdigest())))), schema)


def _ends(rows: DataFrame) -> DataFrame:
    """Digest of the members that end at each node. A node with very many is packed by several tasks first."""
    node = ["conv_id", "depth"]
    packed = rows.repartitionByRange(*node, "member").sortWithinPartitions(*node, "member").mapInArrow(
        _pack_ends, "conv_id long, depth long, member long, data string"
    )
    return packed.repartition(*node).sortWithinPartitions(*node, "member").mapInArrow(
        _digest_ends, "conv_id long, depth long, ends_sha256 string"
    )


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the prefix trie of the rebuilt conversations (columns of ``NODE``).

    Conversations are rebuilt as :func:`prefixes` says. Repeated turns are turns of their own.
    A conversation of which nothing is left is a member of the root; a table without
    conversations has no node. Texts of any length take part by their digest. Extra columns
    are ignored.
    """
    spark = conversations.sparkSession
    every = prefixes(conversations)
    bits, cells = sketch(every.filter("depth > 0"))
    shared = spark.sparkContext.broadcast(bits)
    marked = every.mapInArrow(
        _screen(shared, cells), PREFIXES + ", tail boolean, inner boolean, next_tail boolean, next_last boolean"
    )
    maybe = durable.cut(marked.filter("not tail"))
    own_end = F.sha2(F.when(F.col("last"), F.col("conv_id").cast("string")).otherwise(""), 256)
    alone = [F.lit(1).cast("long").alias("n_convs"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens")]
    tails = marked.filter("inner").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), alone[0], (~F.col("last")).cast("long").alias("n_children"), *alone[1:], own_end.alias("ends_sha256")
    )

    key = ["depth", "hi", "lo"]
    exact = maybe.groupBy(*key).agg(F.min("conv_id").alias("rep"), F.min("last").alias("childless"))
    rows = durable.cut(maybe.join(exact, key))
    mine = F.col("rep") == F.col("conv_id")
    here = F.struct("depth", "before")
    below = F.struct((F.col("depth") + 1).alias("depth"), (F.col("before") + F.col("words")).alias("before"))
    start = F.min(F.when(mine, here).when(F.col("next_tail"), below))
    about = rows.groupBy("conv_id").agg(
        start["depth"].alias("own_depth"),
        F.coalesce(start["before"], F.max(F.col("before") + F.col("words"))).alias("own_before"),
        F.max(F.col("next_tail") | (F.col("last") & mine & F.col("childless"))).cast("long").alias("leaf"),
        F.max(F.when(~mine, F.struct("depth", "rep")))["rep"].alias("above"),
    )
    full = rows.join(about, "conv_id")
    nodes = full.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.min(F.when(mine & (F.col("depth") > 0), F.when(F.col("depth") == F.col("own_depth"), F.col("above")).otherwise(F.col("conv_id")))).alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.sum((~F.col("last") & (F.col("own_depth") <= F.col("depth") + 1)).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.col("own_before") - F.col("before"), F.lit(0))).cast("long").alias("saved_tokens"),
    )
    ends = _ends(rows.filter("last").select(F.col("rep").alias("conv_id"), "depth", F.col("conv_id").alias("member")))
    inner = nodes.join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    tops = rows.filter("next_tail").select(
        "conv_id",
        (F.col("depth") + 1).alias("depth"),
        F.col("rep").alias("parent_conv_id"),
        alone[0],
        (~F.col("next_last")).cast("long").alias("n_children"),
        *alone[1:],
        F.sha2(F.when(F.col("next_last"), F.col("conv_id").cast("string")).otherwise(""), 256).alias("ends_sha256"),
    )
    columns = [c.split()[0] for c in NODE.split(", ")]
    result = inner.select(*columns)
    for part in (tops, tails):
        result = result.unionByName(part.select(*columns))
    return result.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
