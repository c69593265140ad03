"""Quality rules by line sequence labelling.

A linear-chain conditional random field marks every line of a text as content or
boilerplate; Viterbi decoding finds the most likely labelling of all its lines, and the
share of the text's characters in content lines decides whether it is kept. Plain counts
(words, symbols, repeated lines and words) are returned beside the verdict; texts that are
too short or mostly repetition fail on those counts alone.

No line labels exist, so they are latent: a document's label only says what most of its lines
are. Fitting starts with every line labelled like its text; these labels never change inside a
text, so only what single lines look like is learned from them, and no move between labels.
Then it alternates (hard expectation maximisation): the likeliest labelling of each text in
which the lines of its own label keep the majority, and all weights by gradient ascent on the
exact log-likelihood (forward-backward). So a good text keeps its menu and a bad one its
paragraph, and the field sees where labels change. All in numpy, on a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import learn, textnum

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WORDS = 3  # words in a window of the repetition count
CONTENT_SHARE = 0.5
MAX_ROWS = 3000  # labelled rows learned from
MAX_TEXT_BYTES = 1 << 15  # longest text learned from
STEPS = 150  # of gradient ascent for the first labels
ROUNDS = 3  # of labelling lines anew
ROUND_STEPS = 60  # of gradient ascent after each
LEAN = 0.5  # log-odds by which a line leans to its text's label when labelled anew

# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_START = np.ones(256, bool)  # bytes that start a code point
_START[0x80:0xC0] = False
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;")] = True

#: Upper bounds of the bins of each line feature; a last bin lies above them.
BINS = {
    "words": [1, 2, 4, 8, 16, 32],
    "symbols a character": [0.0, 0.02, 0.05, 0.1, 0.2],
    "capitals a character": [0.02, 0.1, 0.3, 0.6],
    "digits a character": [0.0, 0.05, 0.2],
    "words equal to the word before": [0.0, 0.1, 0.3, 0.6],
    "ends as a sentence": [0.5],
    "equal to an earlier line": [0.5],
    "words a line of three-word repeats": [0.05, 0.3, 0.7],
}
_EDGES = [np.array(b) for b in BINS.values()]
_SIZES = [len(e) + 1 for e in _EDGES]
N_FEATURES = sum(_SIZES)
_OFFSETS = np.concatenate(([0], np.cumsum(_SIZES)[:-1]))


@dataclass
class Field:
    emit: np.ndarray  # (features, 2): boilerplate, content
    move: np.ndarray  # (2, 2) from, to
    begin: np.ndarray


def _between(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends] - total[starts]


def measure(chunk: textnum.Chunk) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(counts of each row, bins of each line with a word, characters in its words, first line of each row)."""
    data, at = chunk.data, chunk.offsets
    starts, ends, first = chunk.words()
    row = chunk.row_of(first)
    row64 = textnum.mix(row.astype(np.uint64) + np.uint64(1))
    inside = ~textnum.SEPARATOR[data]
    hashes = textnum.digests(data, starts, ends)

    # Windows of three words found twice or more in their own row.
    n = len(starts)
    repeated = np.zeros(n, bool)
    size = n - REPEAT_WORDS + 1
    if size > 0:
        key = hashes[:size].copy()
        for k in range(1, REPEAT_WORDS):
            key = textnum.mix(key + hashes[k : k + size] * np.uint64(2 * k + 1))
        own = np.flatnonzero(row[:size] == row[REPEAT_WORDS - 1 :])
        _, back, times = np.unique(key[own] ^ row64[own], return_inverse=True, return_counts=True)
        repeated = textnum.covered(own[times[back] > 1], REPEAT_WORDS, n)

    # Lines: pieces between line breaks and row ends that hold a word.
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.unique(np.concatenate((at[:-1], breaks + 1)))
    line_start = line_start[line_start < len(data)]
    line_end = np.searchsorted(breaks, line_start)
    line_end = np.concatenate((breaks, [len(data)]))[line_end]
    line_row = np.searchsorted(at, line_start, "right") - 1
    line_end = np.minimum(line_end, at[line_row + 1])
    full = _between(inside, line_start, line_end) > 0
    line_start, line_end, line_row = line_start[full], line_end[full], line_row[full]
    key = textnum.digests(data, line_start, line_end) ^ textnum.mix(line_row.astype(np.uint64) + np.uint64(1))
    _, where, back = np.unique(key, return_index=True, return_inverse=True)
    again = where[back] != np.arange(len(key)) if len(key) else np.zeros(0, bool)

    word_first = np.searchsorted(starts, line_start)
    word_last = np.searchsorted(starts, line_end)
    n_words = word_last - word_first
    same = np.zeros(n, bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    chars = _between(inside & _START[data], line_start, line_end)
    per = np.maximum(chars, 1)
    final = data[ends[word_last - 1] - 1] if len(line_start) else np.empty(0, np.uint8)
    values = [
        n_words,
        _between(_SYMBOL[data], line_start, line_end) / per,
        _between(_UPPER[data], line_start, line_end) / per,
        _between(_DIGIT[data], line_start, line_end) / per,
        _between(same, word_first, word_last) / np.maximum(n_words, 1),
        _STOP[final],
        again,
        _between(repeated, word_first, word_last) / np.maximum(n_words, 1),
    ]
    bins = np.stack([off + np.searchsorted(edge, v, "left") for off, edge, v in zip(_OFFSETS, _EDGES, values)], 1)
    line_first = np.searchsorted(line_row, np.arange(len(chunk) + 1))
    counts = {
        "n_words": np.diff(first),
        "word_chars": chunk.per_row(inside & _START[data]),
        "n_symbols": chunk.per_row(_SYMBOL[data]),
        "n_dup_lines": _between(again, line_first[:-1], line_first[1:]),
        "n_repeat_words": _between(repeated, first[:-1], first[1:]),
    }
    return counts, bins, chars, line_first


def viterbi(scores: np.ndarray, field: Field) -> np.ndarray:
    """Most likely label of each line, given (lines, 2) emission scores; of equals the lower label."""
    (a, b), ((m00, m01), (m10, m11)) = field.begin, field.move
    rows = scores.tolist()
    back0, back1 = [], []
    v0, v1 = a + rows[0][0], b + rows[0][1]
    for e0, e1 in rows[1:]:
        from0, from1 = v0 + m00, v1 + m10
        to0, to1 = v0 + m01, v1 + m11
        back0.append(0 if from0 >= from1 else 1)
        back1.append(0 if to0 >= to1 else 1)
        v0, v1 = max(from0, from1) + e0, max(to0, to1) + e1
    label = 0 if v0 >= v1 else 1
    out = [label]
    for k in range(len(back0) - 1, -1, -1):
        label = back1[k] if label else back0[k]
        out.append(label)
    return np.array(out[::-1])


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class _Sample:
    """Labelled texts, the longest first, that step through their lines together."""

    def __init__(self, texts: list[tuple[np.ndarray, int]]):
        texts = sorted((t for t in texts if len(t[0])), key=lambda t: -len(t[0]))
        self.n, self.longest = len(texts), len(texts[0][0]) if texts else 0
        self.length = np.array([len(b) for b, _ in texts], np.int64)
        self.label = np.array([y for _, y in texts], np.int64)
        self.bins = np.zeros((self.longest, self.n, len(_SIZES)), np.int64)
        for j, (b, _) in enumerate(texts):
            self.bins[: len(b), j] = b
        self.live = np.array([(self.length > t).sum() for t in range(self.longest)])  # a prefix of the texts
        self.lines = np.broadcast_to(self.label, (self.longest, self.n)).copy()
        share = np.maximum(np.bincount(self.label, minlength=2), 1)
        if self.n:
            self.weight = (self.n / (2 * share))[self.label] / self.length  # a text counts once, both labels alike

    def relabel(self, field: Field) -> None:
        """The likeliest lines of each text, if most of them still have the text's label."""
        for j in range(self.n):
            scores = field.emit[self.bins[: self.length[j], j]].sum(1)
            scores[:, self.label[j]] += LEAN
            lines = viterbi(scores, field)
            if 2 * (lines == self.label[j]).sum() > len(lines):
                self.lines[: self.length[j], j] = lines


def _ascend(field: Field, sample: _Sample, steps: int, moves: bool = True) -> None:
    """Adagrad steps up the log-likelihood of the sample's lines; without ``moves`` lines are independent."""
    n, longest, live, lines, weight = sample.n, sample.longest, sample.live, sample.lines, sample.weight
    parameters = [field.emit, field.move, field.begin]
    memory = [np.zeros_like(p) for p in parameters]
    for _ in range(steps):
        scores = [field.emit[sample.bins[t, : live[t]]].sum(1) for t in range(longest)]
        forward = [field.begin + scores[0]]
        for t in range(1, longest):
            before = forward[-1][: live[t]]
            forward.append(scores[t] + _logsumexp(before[:, :, None] + field.move, 1))
        last = np.stack([forward[k - 1][j] for j, k in enumerate(sample.length)])
        norm = _logsumexp(last, 1)
        gradient = [-0.01 * p for p in parameters]
        backward = np.zeros((n, 2))
        for t in range(longest - 1, -1, -1):
            m = live[t]
            if t + 1 < longest:
                k = live[t + 1]
                ahead = backward[:k] + scores[t + 1]
                pair = np.exp(forward[t][:k, :, None] + field.move + ahead[:, None, :] - norm[:k, None, None])
                gradient[1] -= (pair * weight[:k, None, None]).sum(0) / n
                np.add.at(gradient[1], (lines[t, :k], lines[t + 1, :k]), weight[:k] / n)
                backward[:k] = _logsumexp(field.move + ahead[:, None, :], 2)
            delta = -np.exp(forward[t] + backward[:m] - norm[:m, None])
            delta[np.arange(m), lines[t, :m]] += 1
            delta *= weight[:m, None] / n
            np.add.at(gradient[0], sample.bins[t, :m].ravel(), np.repeat(delta, len(_SIZES), 0))
            if t == 0:
                gradient[2] += delta.sum(0)
        if not moves:
            gradient[1][:] = 0
        for p, g, m in zip(parameters, gradient, memory):
            m += g * g
            p += 0.3 * g / np.sqrt(m + 1e-12)


def _fit(texts: list[tuple[np.ndarray, int]]) -> Field:
    field = Field(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    sample = _Sample(texts)
    if not sample.n:
        return field
    _ascend(field, sample, STEPS, moves=False)
    for _ in range(ROUNDS):
        sample.relabel(field)
        _ascend(field, sample, ROUND_STEPS)
    return field


def _sample_bins(chunk: textnum.Chunk) -> dict:
    import pyarrow as pa

    _, bins, _, first = measure(chunk)
    return {"bins": pa.array([bins[a:b].astype(np.uint8).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())}


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_text_bytes: int = MAX_TEXT_BYTES) -> Field:
    """Learn the field from at most ``max_rows`` labelled texts of at most ``max_text_bytes`` bytes."""
    sample = learn.labelled_sample(docs, labels, "quality", F.lit(True), max_rows, max_text_bytes)
    rows = learn.score_rows(sample, _sample_bins, "bins binary", text="_text").collect()
    rows = sorted(rows, key=lambda r: (r["_id"], r["bins"]))
    return _fit([(np.frombuffer(r["bins"], np.uint8).reshape(-1, len(_SIZES)), r["_label"]) for r in rows])


def judge(docs: DataFrame, field: Field) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept, content_share (of word characters).

    A null or empty text has no line: all counts 0, base_failed, content_share 0. Extra
    columns are ignored.
    """

    def run(chunk: textnum.Chunk) -> dict:
        counts, bins, chars, first = measure(chunk)
        scores = field.emit[bins].sum(1)
        share = np.zeros(len(chunk))
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            if b > a:
                content = viterbi(scores[a:b], field)
                share[i] = (chars[a:b] * content).sum() / chars[a:b].sum()
        failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
        return {
            **{k: v.astype(np.int64) for k, v in counts.items()},
            "base_failed": failed,
            "kept": ~failed & (share >= CONTENT_SHARE),
            "content_share": share,
        }

    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"
    return learn.score_rows(docs.select("doc_id", "text"), run, schema)


def line_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with a field learned from the labelled rows of ``docs``."""
    return judge(docs, fit(docs, labels))
