"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, A-Z folded, and single characters in scripts without
spaces. Documents and benchmark items are joined
on seeds, the hashes of ``SEED`` consecutive tokens. For each joined pair the running
Karp-Rabin tiling starts: seeds on one diagonal grow to maximal matches, which are verified
token by token; the longest match whose tokens are all free becomes a tile, matches that it
cuts into go back with what is left of them, and so on until none has ``SEED`` tokens. A text
and an item that repeat their seeds, whose pairs of places would be many, are searched by length
instead, longest matches first, which gives the same tiles in linear memory. Tiles
may lie in any order, so passages that were reordered are caught too. A document leaks an
item when tiles cover at least ``COVERAGE`` of the item's tokens. An item with fewer than
``SEED`` tokens has its whole token sequence for a seed, and leaks where that is found.

The benchmark is read in blocks of bounded size; each is broadcast and meets every document
in Arrow tasks, so the documents are never shuffled and no document is compared with another.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import learn, textnum

SEED = 5  # tokens of a seed, and the least of a tile
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20  # benchmark text broadcast at once, about
SEED_PAIRS = 1 << 16  # with more pairs of places of a row and an item matches are searched by length; equal results
EXPANDED = 1 << 20  # places in items at once, about


@dataclass
class Index:
    """A block of the benchmark: its items' tokens, and their seeds in hash order."""

    item_id: list
    tokens: list[np.ndarray]
    seeds: np.ndarray  # distinct, sorted
    begin: np.ndarray  # of each seed's places
    item: np.ndarray
    at: np.ndarray
    maybe: np.ndarray  # by the top bits of a hash: some seed has them
    short: dict[int, dict[int, list[int]]]  # items of fewer than SEED tokens: by number of tokens and hash of all


_TOP = 20


def _tokens(chunk: textnum.Chunk):
    starts, ends, first = chunk.words(textnum.PUNCTUATION, apart=True)
    return textnum.digests(textnum.LOWER[chunk.data], starts, ends), first


def build_index(items: list[tuple]) -> Index:
    """From (item_id, text) rows."""
    ids, tokens, hashes, owner, place, short = [], [], [], [], [], {}
    for item_id, text in items:
        data = np.frombuffer((text or "").encode(), np.uint8)
        own, _ = _tokens(textnum.Chunk(data, np.array([0, len(data)]), 0))
        seeds = textnum.PrefixHash(own).windows(SEED)
        if 0 < len(own) < SEED:
            whole = int(textnum.PrefixHash(own).windows(len(own))[0])
            short.setdefault(len(own), {}).setdefault(whole, []).append(len(ids))
        hashes.append(seeds)
        owner.append(np.full(len(seeds), len(ids)))
        place.append(np.arange(len(seeds)))
        ids.append(item_id)
        tokens.append(own)
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
    hashes, owner, place = join(hashes, np.uint64), join(owner, np.int64), join(place, np.int64)
    order = np.argsort(hashes, kind="stable")
    seeds, begin = np.unique(hashes[order], return_index=True)
    maybe = np.zeros(1 << _TOP, bool)
    maybe[seeds >> np.uint64(64 - _TOP)] = True
    return Index(ids, tokens, seeds, np.append(begin, len(order)), owner[order], place[order], maybe, short)


def tile(item: np.ndarray, doc: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in doc, tokens), longest first, grown from seeds at (i, j)."""
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    new = np.ones(len(i), bool)
    new[1:] = ((j - i)[1:] != (j - i)[:-1]) | (i[1:] != i[:-1] + 1)
    begin = np.flatnonzero(new)
    run = np.diff(np.append(begin, len(i)))
    heap = []
    for a, b, n in zip(i[begin].tolist(), j[begin].tolist(), (run + SEED - 1).tolist()):
        same = item[a : a + n] == doc[b : b + n]
        for lo, hi in _runs(same):
            heap.append((lo - hi, a + lo, b + lo))
    heapq.heapify(heap)
    free_item, free_doc, tiles = np.ones(len(item), bool), np.ones(len(doc), bool), []
    while heap:
        minus, a, b = heapq.heappop(heap)
        free = free_item[a : a - minus] & free_doc[b : b - minus]
        if free.all():
            free_item[a : a - minus] = False
            free_doc[b : b - minus] = False
            tiles.append((a, b, -minus))
        else:
            for lo, hi in _runs(free):
                heapq.heappush(heap, (lo - hi, a + lo, b + lo))
    return tiles


def tile_by_length(item: np.ndarray, doc: np.ndarray, free_doc: np.ndarray) -> list[tuple[int, int, int]]:
    """The tiles of :func:`tile`, in memory linear in item and document, however often seeds repeat.

    ``free_doc`` marks the places of the document that any seed covers. Longest first: the length
    of the longest match of free tokens is found by bisection over the digests of all windows of
    a length, then every match of that length is marked, in the order of its places. Each round
    leaves shorter matches only, and tiles of many lengths take many tokens of the item, so
    rounds are few.
    """
    free_item, free_doc, tiles = np.ones(len(item), bool), free_doc.copy(), []
    most = min(len(item), len(doc))
    while most >= SEED:
        ahead_item, ahead_doc = _ahead(free_item), _ahead(free_doc)

        def windows(n: int, ahead_item=ahead_item, ahead_doc=ahead_doc):
            """Places of free windows of ``n`` tokens that item and document share, and their digests."""
            a, b = np.flatnonzero(ahead_item >= n), np.flatnonzero(ahead_doc >= n)
            if not len(a) or not len(b):
                return a[:0], b[:0], None, None
            of_a, of_b = textnum.window_digests(item, n)[a], textnum.window_digests(doc, n)[b]
            a_in, b_in = np.isin(of_a, of_b), np.isin(of_b, of_a)
            return a[a_in], b[b_in], of_a[a_in], of_b[b_in]

        low, high = SEED - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(windows(middle)[0]):
                low = middle
            else:
                high = middle - 1
        if low < SEED:
            break
        a, b, of_a, of_b = windows(low)
        order = np.argsort(of_b, kind="stable")
        b, of_b = b[order], of_b[order]
        begin, end = np.searchsorted(of_b, of_a, "left"), np.searchsorted(of_b, of_a, "right")
        passed: dict[int, int] = {}  # of each digest: places before this one are taken
        for x, lo, hi in zip(a.tolist(), begin.tolist(), end.tolist()):
            if not (free_item[x] and free_item[x + low - 1]):
                continue  # a tile of this length took one of its ends
            at = passed.get(lo, lo)
            while at < hi and not (free_doc[b[at]] and free_doc[b[at] + low - 1]):
                at += 1
            passed[lo] = at
            while at < hi:
                y = int(b[at])
                if free_doc[y] and free_doc[y + low - 1] and (item[x : x + low] == doc[y : y + low]).all():
                    free_item[x : x + low] = False
                    free_doc[y : y + low] = False
                    tiles.append((x, y, low))
                    break
                at += 1
        most = low - 1
    return tiles


def _ahead(free: np.ndarray) -> np.ndarray:
    """How many free tokens follow from each place on."""
    n = len(free)
    taken = np.where(free, n, np.arange(n))
    return np.minimum.accumulate(taken[::-1])[::-1] - np.arange(n)


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of true values with at least ``SEED`` of them."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2]) if b - a >= SEED]


def _short_leaks(tokens: np.ndarray, first: np.ndarray, index: Index) -> Iterator[tuple]:
    """As ``chunk_leaks``, the items of fewer than ``SEED`` tokens that a row holds whole."""
    for n, items in index.short.items():
        hashes = textnum.PrefixHash(tokens).windows(n)
        at = np.flatnonzero(np.isin(hashes, np.fromiter(items, np.uint64, len(items))))
        row = np.searchsorted(first, at, "right") - 1
        own = at + n <= first[row + 1]
        seen = set()
        for a, r in zip(at[own].tolist(), row[own].tolist()):
            for k in items[int(hashes[a])]:
                if (r, k) not in seen and (tokens[a : a + n] == index.tokens[k]).all():
                    seen.add((r, k))
                    yield r, k, 1, n


def chunk_leaks(chunk: textnum.Chunk, index: Index, coverage: float) -> Iterator[tuple]:
    """(row, item, tiles, tiled tokens) of the pairs that reach the coverage."""
    tokens, first = _tokens(chunk)
    yield from _short_leaks(tokens, first, index)
    if not len(index.seeds) or len(tokens) < SEED:
        return
    hashes = textnum.PrefixHash(tokens).windows(SEED)
    at = np.flatnonzero(index.maybe[hashes >> np.uint64(64 - _TOP)])
    found = np.minimum(np.searchsorted(index.seeds, hashes[at]), len(index.seeds) - 1)
    hit = index.seeds[found] == hashes[at]
    at, found = at[hit], found[hit]
    row = np.searchsorted(first, at, "right") - 1
    own = at + SEED <= first[row + 1]  # not over the end of the row
    at, found, row = at[own], found[own], row[own]
    last = None
    for r, k, seeds, i in _shared(row, found, index):
        whole = index.tokens[k]
        if textnum.covered(np.unique(i), SEED, len(whole)).sum() < coverage * len(whole):
            continue  # tiles cover no more than all seeds together
        if r != last:  # the row's seeds, in their order
            last = r
            part = slice(*np.searchsorted(row, [r, r + 1]).tolist())
            order = np.argsort(found[part], kind="stable")
            here, places = found[part][order], at[part][order] - first[r]
        text = tokens[first[r] : first[r + 1]]
        held = textnum.covered(np.unique(places[np.isin(here, seeds)]), SEED, len(text))
        if held.sum() < coverage * len(whole):
            continue  # nor more than they cover of the row
        begin, end = np.searchsorted(here, seeds, "left"), np.searchsorted(here, seeds, "right")
        times = end - begin
        if times.sum() <= SEED_PAIRS:
            j = places[np.repeat(begin, times) + _counted(times)]
            tiles = tile(whole, text, np.repeat(i, times), j)
        else:
            tiles = tile_by_length(whole, text, held)
        tiled = sum(n for _, _, n in tiles)
        if tiled >= coverage * len(whole):
            yield r, k, len(tiles), tiled


def _counted(times: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of ``times``, one after another."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def _shared(row: np.ndarray, found: np.ndarray, index: Index) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row, item, seeds, their places in the item) of the rows and items that share seeds, by row.

    However often a row repeats a seed it counts once here. Rows are taken in runs of about
    ``EXPANDED`` places in items, or one by one where a row alone has more.
    """
    rows, seeds = np.divmod(np.unique(row * len(index.seeds) + found), len(index.seeds))
    count = index.begin[seeds + 1] - index.begin[seeds]
    total = np.concatenate(([0], np.cumsum(count)))
    lo = 0
    while lo < len(rows):
        hi = int(np.searchsorted(total, total[lo] + EXPANDED, "right")) - 1
        if hi < len(rows):  # whole rows only
            hi = int(np.searchsorted(rows, rows[max(hi, lo)]))
            if hi <= lo:
                hi = int(np.searchsorted(rows, rows[lo], "right"))
        times = count[lo:hi]
        place = np.repeat(index.begin[seeds[lo:hi]], times) + _counted(times)
        r, s, item, i = np.repeat(rows[lo:hi], times), np.repeat(seeds[lo:hi], times), index.item[place], index.at[place]
        order = np.lexsort((item, r))
        r, s, item, i = r[order], s[order], item[order], i[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1])
        begin = np.append(np.flatnonzero(new), len(r)).tolist()
        for x, y in zip(begin[:-1], begin[1:]):
            yield int(r[x]), int(item[x]), s[x:y], i[x:y]
        lo = hi


def _indexes(benchmark: DataFrame, block_bytes: int) -> Iterator[Index]:
    """The benchmark block by block; a block is what the driver holds and broadcasts at once."""
    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield build_index([tuple(r) for r in own.collect()])


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per leaking row and leaked item: doc_id, item_id, n_tiles, n_tokens (tiled), item_tokens, coverage.

    Clean documents have no row. Null and empty texts and items leak nothing, items with
    fewer than five tokens are leaked by documents that hold them whole. Repeated rows and repeated items
    each count. Extra columns are ignored.
    """
    out = None
    rows = docs.select(F.col("doc_id").alias("doc_id"), "text")
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    for index in _indexes(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for chunk in textnum.chunks(batch.column(1)):
                    found = list(chunk_leaks(chunk, index, coverage))
                    if found:
                        row, item, n_tiles, tiled = zip(*found)
                        size = [len(index.tokens[k]) for k in item]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array([chunk.first + r for r in row])),
                                pa.array([index.item_id[k] for k in item]),
                                pa.array(n_tiles, pa.int64()),
                                pa.array(tiled, pa.int64()),
                                pa.array(size, pa.int64()),
                                pa.array([t / s for t, s in zip(tiled, size)], pa.float64()),
                            ],
                            names=["doc_id", "item_id", "n_tiles", "n_tokens", "item_tokens", "coverage"],
                        )

        id_type = docs.schema["doc_id"].dataType.simpleString()
        part = rows.mapInArrow(
            run, f"doc_id {id_type}, item_id {item_type}, n_tiles long, n_tokens long, item_tokens long, coverage double"
        )
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item."""
    name = learn.unused(docs, "leaks")
    for index in _indexes(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def leaky(chunk: textnum.Chunk, shared=shared) -> dict:
            flags = np.zeros(len(chunk), bool)
            flags[[r for r, *_ in chunk_leaks(chunk, shared.value, coverage)]] = True
            return {name: flags}

        marked = learn.score_rows(docs, leaky, f"`{name}` boolean", keep_text=True)
        docs = marked.filter(~F.col(name)).drop(name)
    return docs
