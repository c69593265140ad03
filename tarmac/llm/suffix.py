"""Suffix-array dedup over bytes with hash-compared suffix sorting.

A byte goes when a ``LENGTH``-byte string over it also starts in a document with a smaller
id. Every such string has an anchor: its ``GRAM``-byte piece with the smallest hash. Equal
strings have equal anchors, so only the pieces of text around anchors that occur more than
once need to be compared; a piece holds exactly the strings of its anchor.

A text that a smaller document has in full goes whole and takes no further part. Blocks of
documents, and then the hash parts of the anchors, sort their pieces as a suffix
array does. Pieces are first put in order of eight bytes. Where these agree, a mergesort
compares two pieces in logarithmic time: it finds their common extension by binary search
over prefix polynomial hashes, and then compares the next byte. Neighbours whose hashes say
that they are equal are verified byte by byte. Equal pieces share one entry with the smallest
document; where an anchor has several different pieces, their strings are sorted once more,
shift by shift.

An anchor with very many different pieces (the edge of a passage that a large share of all
documents holds) is not gathered in one part: its strings travel singly and meet by their own
hash. It is known by the number of blocks that have it, or by one block that has more than its
share, so the pieces of any other anchor are about ``CROWD`` at most.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm import blocks, textnum

LENGTH = 50  # bytes of a string
GRAM = 24  # bytes of an anchor
STEPS = LENGTH - GRAM + 1  # places of the anchor in the string
BLOCK_BYTES = 3 << 20  # text in a block, about
PART_BYTES = 16 << 20  # text for each hash part, about
WINDOW = 1 << 15  # string starts whose anchors are sought at once, in the processor's cache
SLICES = 8  # of a part's keys, sorted one after another to bound its memory
CROWD = 1 << 16  # different pieces; an anchor that may have so many sends its strings singly

_POSITION = np.uint64((1 << 24) - 1)


def sort_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, class of each piece): pieces ``data[start:end]`` in byte order, equal ones in one class.

    Classes count up in that order. Ties keep the order given.
    """
    classes = piece_classes(data, starts, ends)
    return np.argsort(classes, kind="stable"), classes


def piece_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each piece as ``sort_pieces`` has it; equal pieces are put together first, so that only different ones are sorted."""
    if len(starts) == 0:
        return np.empty(0, np.int64)
    length = ends - starts
    digest = textnum.digests(data, starts, ends, long=int(length.max()))
    _, one, back = np.unique(digest, return_index=True, return_inverse=True)
    if not _same_bytes(data, starts, starts[one[back]], length, length[one[back]]).all():  # a collision: all are sorted
        one = back = np.arange(len(starts))
    order, new = _sort_distinct(data, starts[one], length[one])
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(new) - 1
    return classes[back]


def _sort_distinct(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether each piece in that order differs from the one before it)."""
    n = len(starts)
    eight = textnum.eights(data)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    heads = []
    for k in (0, 8):
        left = np.minimum(length - k, 8)
        some = eight[np.where(left > 0, starts + k, 0)].byteswap()
        heads.append(np.where(left > 0, some & (ones << (8 * (8 - np.maximum(left, 1))).astype(np.uint64)), np.uint64(0)))
    order = np.lexsort(heads[::-1])
    run_new = np.ones(n, bool)
    run_new[1:] = False
    for head in heads:
        run_new[1:] |= head[order][1:] != head[order][:-1]
    if run_new.all():
        return order, run_new
    # Only pieces of runs of several go on, in a sequence of their own.
    run = np.cumsum(run_new) - 1
    tied = np.flatnonzero(np.bincount(run)[run] > 1)
    some = order[tied]
    run = np.cumsum(run_new[tied]) - 1
    run_start = np.flatnonzero(run_new[tied])
    run_size = np.diff(np.append(run_start, len(tied)))
    starts, length = starts[some], length[some]
    data = _gather(data, starts, length)
    starts = np.cumsum(length) - length
    prefix = textnum.PrefixHash(data)
    wide = np.append(data, np.uint8(0))

    def extension(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pieces a and b, by binary search over hash comparisons."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(length[a], length[b])
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            middle = (low[live] + high[live] + 1) // 2
            p, q = starts[a[live]], starts[b[live]]
            same = prefix.raw(p, p + middle) == prefix.raw(q, q + middle)
            low[live] = np.where(same, middle, low[live])
            high[live] = np.where(same, high[live], middle - 1)

    def before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Piece a sorts before piece b."""
        common = extension(a, b)
        end_a, end_b = common >= length[a], common >= length[b]
        byte_a = wide[starts[a] + common]
        byte_b = wide[starts[b] + common]
        return np.where(end_a | end_b, end_a & ~end_b, byte_a < byte_b)

    # Bottom-up mergesort inside the runs of one head: all runs take each round together.
    width = 1
    place = np.arange(len(tied)) - run_start[run]
    sorted_ = np.arange(len(tied))
    while True:
        active = np.flatnonzero(run_size[run] > width)
        if not len(active):
            break
        pair = place[active] // (2 * width)
        base = run_start[run[active]] + pair * 2 * width
        stop = run_start[run[active]] + run_size[run[active]]
        is_left = place[active] - pair * 2 * width < width
        other_low = np.where(is_left, np.minimum(base + width, stop), base)
        other_high = np.where(is_left, np.minimum(base + 2 * width, stop), np.minimum(base + width, stop))
        low, high = other_low.copy(), other_high.copy()
        mine = sorted_[active]
        while True:  # how many of the other half sort before each piece (of equals: the left half's)
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) // 2
            theirs, own = sorted_[middle], mine[live]
            ahead = before(theirs, own)
            tie = np.flatnonzero(~ahead & ~is_left[live])
            ahead[tie] = ~before(own[tie], theirs[tie])
            low[live] = np.where(ahead, middle + 1, low[live])
            high[live] = np.where(ahead, high[live], middle)
        half = np.where(is_left, base, base + width)
        target = base + (active - half) + (low - other_low)
        merged = sorted_.copy()
        merged[target] = mine
        sorted_ = merged
        width *= 2

    order[tied] = some[sorted_]
    new = run_new.copy()
    a, b = sorted_[:-1], sorted_[1:]
    alike = np.flatnonzero((length[a] == length[b]) & ~run_new[tied][1:])
    same = _same_bytes(data, starts[a[alike]], starts[b[alike]], length[a[alike]], length[b[alike]])
    new[tied[1:]] = True
    new[tied[alike[same] + 1]] = False
    return order, new


def _same_bytes(data: np.ndarray, p: np.ndarray, q: np.ndarray, size_p: np.ndarray, size_q: np.ndarray) -> np.ndarray:
    """Whether the pieces really are equal: collision verification, eight bytes at a time."""
    same = size_p == size_q
    eight = textnum.eights(data)
    live = np.flatnonzero(same & (p != q) & (size_p > 0))
    k = 0
    while len(live):
        left = size_p[live] - k
        drop = (8 * np.maximum(8 - left, 0)).astype(np.uint64)
        differ = (eight[p[live] + k] ^ eight[q[live] + k]) << drop != 0
        same[live[differ]] = False
        live = live[~differ & (left > 8)]
        k += 8
    return same


class _Anchored:
    """The anchors of a block: place, hash, and the range of string starts each one stands for."""

    def __init__(self, block: blocks.Block, copies: np.ndarray):
        place, key, first, last = [], [], [], []
        # Strings do not cross rows, and none starts in a copy.
        valid = np.ones(max(0, len(block.data) - LENGTH + 1), bool)
        for b in block.offsets[1:].tolist():
            valid[max(0, b - LENGTH + 1) : b] = False
        for row in np.flatnonzero(copies).tolist():
            valid[block.offsets[row] : block.offsets[row + 1]] = False
        for base in range(0, len(valid), WINDOW):
            ok = valid[base : base + WINDOW]
            n = len(ok)
            gram = _grams(block.data[base : base + n + LENGTH - 1])
            packed = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
            low, width = packed, 1
            while 2 * width <= STEPS:
                low = np.minimum(low[: len(low) - width], low[width:])
                width *= 2
            low = np.minimum(low[:n], low[STEPS - width : STEPS - width + n])
            turn = np.ones(n + 1, bool)
            turn[1:-1] = (low[1:] != low[:-1]) | (ok[1:] != ok[:-1])
            begin = np.flatnonzero(turn[:-1] & ok)
            at = (low[begin] & _POSITION).astype(np.int64)
            place.append(at + base)
            key.append(gram[at])
            first.append(begin + base)
            last.append(np.flatnonzero(turn[1:] & ok) + base)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        place, key, first, last = join(place, np.int64), join(key, np.uint64), join(first, np.int64), join(last, np.int64)
        new = np.ones(len(place) + 1, bool)  # an anchor cut by a window's end is one again
        new[1:-1] = (place[1:] != place[:-1]) | (first[1:] != last[:-1] + 1)
        self.place, self.first, self.last = place[new[:-1]], first[new[:-1]], last[new[1:]]
        self.key = textnum.mix(key[new[:-1]])  # the smallest hashes crowd near zero: spread them over the parts
        self.row = np.searchsorted(block.offsets, self.first, "right") - 1
        self.ids = block.ids[self.row]

    def keys(self):
        """(sorted distinct keys, index of each anchor's key, key found in several documents here)."""
        keys, back = np.unique(self.key, return_inverse=True)
        low, high = np.full(len(keys), blocks.NO_ID), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, back, self.ids)
        np.maximum.at(high, back, self.ids)
        return keys, back, low < high

    def dense(self, data: np.ndarray, back: np.ndarray, n_keys: int, least: int) -> np.ndarray:
        """Keys with ``least`` different pieces here, by digests."""
        some = np.flatnonzero((np.bincount(back, minlength=n_keys) >= least)[back])
        digest = textnum.digests(data, self.first[some], self.last[some] + LENGTH, long=LENGTH + STEPS)
        _, one = np.unique(digest ^ textnum.mix(self.key[some]), return_index=True)
        return np.bincount(back[some[one]], minlength=n_keys) >= least


_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on, read as three words; it orders anchors and brings them together, no more."""
    words = textnum.eights(data)[: len(data) - 7].copy()
    n = len(data) - GRAM + 1
    found = words[:n] * _FACTORS[0]
    for k in (1, 2):
        found += words[8 * k : 8 * k + n] * _FACTORS[k]
    found ^= found >> np.uint64(32)
    found *= _FACTORS[0]
    return found


class _Pieces:
    """The distinct pieces a block sends: of each shared anchor its piece, of a crowded one its strings."""

    def __init__(self, block: blocks.Block, copies: np.ndarray, parts: blocks.Parts, replies: dict[int, bytes]):
        anchored = _Anchored(block, copies)
        keys, back, _ = anchored.keys()
        shared, hot = blocks.read_shared(parts, keys, replies)
        shared, hot = shared[back], hot[back]
        whole = np.flatnonzero(shared & ~hot)
        crowded = np.flatnonzero(hot)
        count = (anchored.last - anchored.first + 1)[crowded]
        single = np.repeat(crowded, count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        self.first = np.concatenate((anchored.first[whole], anchored.first[single] + step))
        self.last = np.concatenate((anchored.last[whole], anchored.first[single] + step))
        owner = np.concatenate((whole, single))
        self.ids = anchored.ids[owner]
        place = anchored.place[owner]
        end = self.last + LENGTH
        self.piece = piece_classes(block.data, self.first, end)
        n = int(self.piece.max()) + 1 if len(self.piece) else 0
        self.low = np.full(n, blocks.NO_ID)
        np.minimum.at(self.low, self.piece, self.ids)
        one = np.zeros(n, np.int64)
        one[self.piece] = np.arange(len(self.piece))
        self.begin, self.length, self.shift = self.first[one], (end - self.first)[one], (place - self.first)[one]
        # Whole pieces meet by their anchor, single strings by themselves.
        key = anchored.key[owner][one]
        alone = one >= len(whole)
        if alone.any():
            at = self.begin[alone]
            key[alone] = textnum.digests(block.data, at, at + LENGTH)
        order = np.argsort(key, kind="stable")
        self.rank = np.empty(n, np.int64)  # place of each distinct piece among those sent
        self.rank[order] = np.arange(n)
        self.order, self.sent = order, key[order]
        self.data = block.data


def _gather(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces one after another."""
    ends = np.cumsum(length)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - length), length)]


def _send_pieces(parts: blocks.Parts, number: int, p: _Pieces) -> pa.Table:
    to, data = [], []
    for part, a, b in parts.split(p.sent):
        some = p.order[a:b]
        slices = (p.sent[a:b] << np.uint64(parts.bits)) // np.uint64((1 << 64) // SLICES)
        data.append(
            np.bincount(slices.astype(np.int64), minlength=SLICES).astype(np.uint32).tobytes()
            + p.length[some].astype(np.uint8).tobytes()
            + p.shift[some].astype(np.uint8).tobytes()
            + p.low[some].tobytes()
            + _gather(p.data, p.begin[some], p.length[some]).tobytes()
        )
        to.append(part)
    return blocks.message(to, number, data)


def _reply_pieces(_: list[int], messages: list[bytes]) -> list[bytes]:
    """For each piece a mask over its strings: bit k is set if a smaller document has string k."""
    opened = []
    for d in messages:
        counts = np.frombuffer(d, np.uint32, SLICES).astype(np.int64)
        n, at = int(counts.sum()), 4 * SLICES
        length = np.frombuffer(d, np.uint8, n, at).astype(np.int64)
        shift = np.frombuffer(d, np.uint8, n, at + n).astype(np.int64)
        low = np.frombuffer(d[at + 2 * n : at + 10 * n], np.int64)
        text = np.frombuffer(d, np.uint8, -1, at + 10 * n)
        opened.append((np.concatenate(([0], np.cumsum(counts))), length, shift, low, text, np.concatenate(([0], np.cumsum(length)))))
    replies: list[list[bytes]] = [[] for _ in messages]
    for k in range(SLICES):
        some = [(c[k], c[k + 1]) for c, *_ in opened]
        if not any(b > a for a, b in some):
            continue
        masks = _masks(
            np.concatenate([m[1][a:b] for m, (a, b) in zip(opened, some)]),
            np.concatenate([m[2][a:b] for m, (a, b) in zip(opened, some)]),
            np.concatenate([m[3][a:b] for m, (a, b) in zip(opened, some)]),
            np.concatenate([m[4][m[5][a] : m[5][b]] for m, (a, b) in zip(opened, some)]),
        )
        at = 0
        for reply, (a, b) in zip(replies, some):
            reply.append(masks[at : at + b - a].tobytes())
            at += b - a
    return [b"".join(reply) for reply in replies]


def _masks(length: np.ndarray, shift: np.ndarray, low: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The mask of each piece among pieces that hold every string's anchor group whole."""
    ends = np.cumsum(length)
    starts = ends - length
    piece = piece_classes(data, starts, ends)
    n_pieces = int(piece.max()) + 1 if len(piece) else 0
    least = np.full(n_pieces, blocks.NO_ID)
    np.minimum.at(least, piece, low)
    strings = length - LENGTH + 1
    mask = np.where(least[piece] < low, _full(strings), np.uint64(0))

    # Different pieces of one anchor may still share strings: compare these, shift by shift.
    one = np.zeros(n_pieces, np.int64)
    one[piece] = np.arange(len(piece))
    anchor = textnum.digests(data, starts[one] + shift[one], starts[one] + shift[one] + GRAM)
    _, kind, count = np.unique(anchor, return_inverse=True, return_counts=True)
    longer = np.bincount(kind, strings[one] > 1) > 0  # different single strings share none
    several = np.flatnonzero((count > 1)[kind] & longer[kind])
    if len(several):
        of = one[several]
        per = strings[of]
        owner = np.repeat(np.arange(len(several)), per)
        step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        text = _gather(data, starts[of], length[of])
        group = _string_classes(text, (np.cumsum(length[of]) - length[of])[owner] + step)
        first = np.full(int(group.max()) + 1, blocks.NO_ID)
        np.minimum.at(first, group, least[several][owner])
        # The smallest document of each string of each distinct piece, then of every copy of the piece.
        width = int(per.max())
        table = np.full((len(several), width), blocks.NO_ID)
        table[owner, step] = first[group]
        row_of = np.full(n_pieces, -1)
        row_of[several] = np.arange(len(several))
        rows = np.flatnonzero(row_of[piece] >= 0)
        row = row_of[piece[rows]]
        found = np.zeros(len(rows), np.uint64)
        for k in range(width):
            smaller = (table[row, k] < low[rows]) & (k < strings[rows])
            found |= smaller.astype(np.uint64) << np.uint64(k)
        mask[rows] = found
    return mask


def _full(strings: np.ndarray) -> np.ndarray:
    """The mask of all strings."""
    return (np.uint64(1) << strings.astype(np.uint64)) - np.uint64(1)


def _string_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each string. Strings with one hash are verified; a collision is sorted out by ``piece_classes``."""
    hashes = textnum.PrefixHash(data).raw(starts, starts + LENGTH)
    _, one, group = np.unique(hashes, return_index=True, return_inverse=True)
    size = np.full(len(starts), LENGTH)
    same = _same_bytes(data, starts, starts[one[group]], size, size)
    return group if same.all() else piece_classes(data, starts, starts + LENGTH)


def _counts(flags: np.ndarray) -> np.ndarray:
    """How many are set before each place, and in all."""
    counts = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, dtype=counts.dtype, out=counts[1:])
    return counts


def remove_later_copies(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Strings are judged on the input and never cross texts. Rows with one doc_id are one
    document here: they do not remove from each other. Null ids come after all others and
    are alike. Null, empty and short texts have no string. Extra columns are ignored.
    """
    rows, parts = blocks.deal(docs, BLOCK_BYTES, PART_BYTES)
    copies = blocks.later_copies(rows)
    share = max(2, -(-CROWD // parts.n_blocks))  # of a block in the pieces that an anchor may have

    def first(block: blocks.Block, marks: dict) -> pa.Table:
        anchored = _Anchored(block, blocks.copy_mask(block, marks))
        keys, back, often = anchored.keys()
        return blocks.send_keys(parts, block.number, keys, often, anchored.dense(block.data, back, len(keys), share))

    anchors = blocks.answer(blocks.meet(rows, [copies], first, blocks.MESSAGE), blocks.reply_shared(CROWD))

    def second(block: blocks.Block, marks: dict, replies: dict) -> pa.Table:
        return _send_pieces(parts, block.number, _Pieces(block, blocks.copy_mask(block, marks), parts, replies))

    pieces = blocks.answer(blocks.meet(rows, [copies, anchors], second, blocks.MESSAGE), _reply_pieces)

    def last(block: blocks.Block, marks: dict, replies: dict, verdicts: dict) -> pa.Table:
        copied = blocks.copy_mask(block, marks)
        p = _Pieces(block, copied, parts, replies)
        mask = np.zeros(len(p.sent), np.uint64)
        for part, a, b in parts.split(p.sent):
            mask[a:b] = np.frombuffer(verdicts[part], np.uint64)
        mask = mask[p.rank[p.piece]] if len(p.piece) else mask
        per = p.last - p.first + 1
        full = _full(p.last - p.first + 1)
        mask = np.where(p.ids > p.low[p.piece], full, mask)
        # Ranges to take out: whole pieces, and single strings of the others.
        whole = np.flatnonzero(mask == full)
        some = np.flatnonzero((mask != full) & (mask != 0))
        per = (p.last - p.first + 1)[some]
        owner = np.repeat(some, per)
        step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        gone = (mask[owner] >> step.astype(np.uint64)) & np.uint64(1) == 1
        single = (p.first[owner] + step)[gone]
        edges = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(edges, np.concatenate((p.first[whole], single)), 1)
        np.add.at(edges, np.concatenate((p.last[whole], single)) + LENGTH, -1)
        removed = np.cumsum(edges[:-1], out=edges[:-1]) > 0
        size = np.diff(block.offsets)
        removed |= np.repeat(copied & (size >= LENGTH), size)
        total = _counts(removed)
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        edge = block.offsets[:-1][block.offsets[:-1] < len(removed)]
        opens[edge] = removed[edge]
        spans = _counts(opens)
        at = block.offsets
        kept = memoryview(block.data[~removed].tobytes())
        left = at - total[at]
        return pa.table(
            {
                "doc_id": block.doc_id,
                "n_bytes": np.diff(at),
                "n_removed": (total[at[1:]] - total[at[:-1]]).astype(np.int64),
                "n_spans": (spans[at[1:]] - spans[at[:-1]]).astype(np.int64),
                "kept_sha256": [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(left[:-1], left[1:])],
            }
        )

    return blocks.meet(rows, [copies, anchors, pieces], last, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
