"""Substring dedup over words with difference-cover anchors.

Every repeated run of ``LENGTH`` words is to go. Hashing each window of each text would move
all windows of the corpus; instead only windows at cover positions are hashed. The cover is a
perfect difference set modulo a period: for any two positions there is one shift, below the
period, that puts both on cover positions. So two equal runs, wherever they lie in their
texts, share an anchor: the ``LENGTH - PERIOD + 1`` words at that shift are inside both.

Round one finds the anchors that occur more than once. Round two extends them: each full
window that contains such an anchor is compared with all its like by two independent 64-bit
digests of its words, in block-wise distinct form. Words covered by a window found twice are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm import blocks, textnum

LENGTH = 35  # words in a window
PERIOD = 21
#: A perfect difference set modulo 21: each other residue is one difference of two of these.
COVER = [3, 6, 7, 12, 14]
ANCHOR = LENGTH - PERIOD + 1


class _Words:
    """The words of a block's rows, one after another."""

    def __init__(self, block: blocks.Block):
        starts, ends, hashes, counts = [], [], [], []
        for chunk, base in block.chunks():
            s, e, first = chunk.words()
            hashes.append(textnum.digests(chunk.data, s, e))
            starts.append(s + base)
            ends.append(e + base)
            counts.append(np.diff(first))
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.hashes = np.concatenate(hashes)
        self.first = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
        self.data = block.data
        n = np.diff(self.first)
        row = np.repeat(np.arange(len(n)), n)
        position = np.arange(len(row)) - self.first[row]
        left = n[row] - position  # words from here to the end of the row
        on_cover = np.zeros(PERIOD, bool)
        on_cover[COVER] = True
        self.anchors = np.flatnonzero(on_cover[position % PERIOD] & (left >= ANCHOR) & (n[row] >= LENGTH))
        self.whole = left >= LENGTH  # a window starts here
        self.low = self.first[row]  # first word of the row

    def anchor_keys(self):
        """(sorted distinct keys, index of each anchor's key, key found more than once here)."""
        hashes = textnum.window_digests(self.hashes, ANCHOR)[self.anchors]
        keys, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
        return keys, back, count > 1

    def extended(self, anchors: np.ndarray):
        """Starts of the windows around the anchors, their sorted distinct hashes, and how these relate."""
        mask = np.zeros(len(self.whole), bool)
        if len(anchors):
            low = np.maximum(anchors - PERIOD + 1, self.low[anchors])
            delta = np.zeros(len(mask) + 1, np.int64)
            np.add.at(delta, low, 1)
            np.add.at(delta, anchors + 1, -1)
            mask = (np.cumsum(delta[:-1]) > 0) & self.whole
        starts = np.flatnonzero(mask)
        one = textnum.window_digests(self.hashes, LENGTH)[starts]
        inside = np.flatnonzero(textnum.covered(starts, LENGTH, len(mask)))
        second = np.zeros(len(mask), np.uint64)
        second[inside] = textnum.digests(self.data, self.starts[inside], self.ends[inside], seed=1)
        two = textnum.window_digests(second, LENGTH)[starts]
        order = np.lexsort((two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        number = np.cumsum(new) - 1
        back = np.empty(len(order), np.int64)
        back[order] = number
        count = np.bincount(number, minlength=int(new.sum()))
        return starts, one[order][new], two[order][new], back, count > 1


def _send_windows(parts: blocks.Parts, number: int, one, two, often) -> pa.Table:
    to, data = [], []
    for part, a, b in parts.split(one):
        data.append(np.uint32(b - a).tobytes() + one[a:b].tobytes() + two[a:b].tobytes() + blocks.pack_bits(often[a:b]))
        to.append(part)
    return blocks.message(to, number, data)


def _reply_windows(_: list[int], data: list[bytes]) -> list[bytes]:
    """A bit for each window: it occurs more than once in the corpus."""
    one, two, often, sizes = [], [], [], []
    for d in data:
        n = int(np.frombuffer(d, np.uint32, 1)[0])
        one.append(np.frombuffer(d[4 : 4 + 8 * n], np.uint64))
        two.append(np.frombuffer(d[4 + 8 * n : 4 + 16 * n], np.uint64))
        often.append(blocks.unpack_bits(d[4 + 16 * n :], n))
        sizes.append(n)
    one, two = np.concatenate(one), np.concatenate(two)
    order = np.lexsort((two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    number = np.cumsum(new) - 1
    twice = np.empty(len(order), bool)
    twice[order] = np.bincount(number)[number] > 1
    twice |= np.concatenate(often)
    ends = np.cumsum(sizes)
    return [blocks.pack_bits(twice[e - n : e]) for e, n in zip(ends, sizes)]


def _kept_digests(block: blocks.Block, words: _Words, removed: np.ndarray) -> list[str]:
    """SHA-256 of each row's kept words joined by one space."""
    stay = ~removed
    n = len(block.data)
    delta = np.zeros(n + 1, np.int8)
    delta[words.starts[stay]] += 1
    np.subtract.at(delta, words.ends[stay], 1)
    keep = np.cumsum(delta[:-1], dtype=np.int8) > 0
    row = np.repeat(np.arange(len(block.ids)), np.diff(words.first))[stay]
    follows = np.zeros(len(row), bool)
    follows[1:] = row[1:] == row[:-1]
    blank = words.starts[stay][follows] - 1
    data = block.data.copy()
    keep[blank] = True
    data[blank] = 0x20
    at = np.concatenate(([0], np.cumsum(keep)))[block.offsets]
    joined = memoryview(data[keep].tobytes())
    return [hashlib.sha256(joined[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256.

    Windows are judged on the input; a window that occurs again in its own text counts.
    Null, empty and short texts have no window and keep what they have. A repeated row is a
    text of its own, so its windows occur again. Extra columns are ignored.
    """
    rows, parts = blocks.deal(docs)

    def first(block: blocks.Block) -> pa.Table:
        keys, _, often = _Words(block).anchor_keys()
        return blocks.send_keys(parts, block.number, keys, often)

    anchors = blocks.answer(blocks.ask(rows, first), blocks.reply_shared(1 << 30))

    def repeated_anchors(words: _Words, replies: dict) -> np.ndarray:
        keys, back, _ = words.anchor_keys()
        return words.anchors[blocks.read_shared(parts, keys, replies)[0][back]]

    def second(block: blocks.Block, replies: dict) -> pa.Table:
        words = _Words(block)
        _, one, two, _, often = words.extended(repeated_anchors(words, replies))
        return _send_windows(parts, block.number, one, two, often)

    windows = blocks.answer(blocks.meet(rows, [anchors], second, blocks.MESSAGE), _reply_windows)

    def last(block: blocks.Block, replies: dict, verdicts: dict) -> pa.Table:
        words = _Words(block)
        starts, one, _, back, _ = words.extended(repeated_anchors(words, replies))
        twice = np.zeros(len(one), bool)
        for part, a, b in parts.split(one):
            twice[a:b] = blocks.unpack_bits(verdicts[part], b - a)
        removed = textnum.covered(starts[twice[back]], LENGTH, len(words.starts))
        total = np.concatenate(([0], np.cumsum(removed)))
        return pa.table(
            {
                "doc_id": block.doc_id,
                "n_words": np.diff(words.first),
                "n_removed": total[words.first[1:]] - total[words.first[:-1]],
                "kept_sha256": _kept_digests(block, words, removed),
            }
        )

    return blocks.meet(rows, [anchors, windows], last, "doc_id long, n_words long, n_removed long, kept_sha256 string")
