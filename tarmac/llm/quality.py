"""Supervised subword embeddings for text quality.

A document is the average of learned vectors of its words, its character 3- and 4-grams
(white space counts as one blank) and two marks: a word equal to the one before it, and a
word in a line already seen in the text. Vectors live in hashed buckets. A softmax over the
average gives the label; vectors and output are trained together by stochastic gradient
descent in numpy on a bounded labelled sample, on the driver.

Because the output is linear in the average, a trained model is one number per bucket; every
text is scored whole in Arrow tasks by summing those numbers, without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import learn, textnum

BITS = 16  # buckets of each kind: words, 3-grams, 4-grams
WIDTH = 8  # numbers in a vector
MAX_ROWS = 3000  # labelled rows learned from
MAX_TEXT_BYTES = 1 << 15  # longest text learned from
EPOCHS = 6

_GRAM = np.random.default_rng(7).integers(1, 1 << 32, (4, 256), dtype=np.uint32)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[textnum.SEPARATOR] = 0x20
_MARK_WORD, _MARK_LINE = 3 << BITS, (3 << BITS) + 1
N_FEATURES = (3 << BITS) + 2


@dataclass
class Model:
    weight: np.ndarray  # of each feature
    bias: float


def _grams(chunk: textnum.Chunk, n: int) -> np.ndarray:
    """Bucket of the n bytes at each position."""
    data = _FOLD[chunk.data]
    size = len(data) - n + 1
    if size <= 0:
        return np.empty(0, np.uint32)
    h = _GRAM[0][data[:size]]
    for k in range(1, n):
        h = h * np.uint32(0x01000193) + _GRAM[k][data[k : k + size]]
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _marks(chunk: textnum.Chunk, starts: np.ndarray, words: np.ndarray, first: np.ndarray):
    """Masks over words: equal to the word before it in the row; in a line equal to an earlier one."""
    same = np.zeros(len(words), bool)
    if len(words):
        same[1:] = words[1:] == words[:-1]
        same[first[:-1][first[:-1] < len(words)]] = False
        breaks = np.cumsum(chunk.data == 0x0A)
        row = chunk.row_of(first)
        line = breaks[starts] + row  # grows at a line break and at a new row
        new = np.concatenate(([True], line[1:] != line[:-1]))
        at = np.flatnonzero(new)
        digest = np.add.reduceat(textnum.mix(words + np.arange(len(words), dtype=np.uint64) - at[np.cumsum(new) - 1].astype(np.uint64)), at)
        digest = textnum.mix(digest + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, where, back = np.unique(digest, return_index=True, return_inverse=True)
        again = where[back] != np.arange(len(at))
        repeated = again[np.cumsum(new) - 1]
    else:
        repeated = same
    return same, repeated


def _features(chunk: textnum.Chunk):
    """(feature of each position, prefix counter) pairs: positions of row i are the slice given by the counter."""
    starts, ends, first = chunk.words()
    hashes = textnum.PrefixHash(chunk.data).of(starts, ends)
    same, repeated = _marks(chunk, starts, hashes, first)
    at = chunk.offsets
    yield (hashes >> np.uint64(64 - BITS)).astype(np.int64), first[:-1], first[1:]
    for kind, n in ((1, 3), (2, 4)):
        grams = _grams(chunk, n).astype(np.int64) + (kind << BITS)
        yield grams, np.minimum(at[:-1], len(grams)), np.clip(at[1:] - n + 1, np.minimum(at[:-1], len(grams)), len(grams))
    for mark, mask in ((_MARK_WORD, same), (_MARK_LINE, repeated)):
        where = np.flatnonzero(mask)
        bounds = np.searchsorted(where, first)
        yield np.full(len(where), mark), bounds[:-1], bounds[1:]


def _bags(chunk: textnum.Chunk) -> dict:
    """For each row the distinct features and their counts, as 32-bit numbers in bytes: the driver keeps them so."""
    import pyarrow as pa

    parts = list(_features(chunk))
    ids, counts = [], []
    for i in range(len(chunk)):
        got = np.concatenate([f[a[i] : b[i]] for f, a, b in parts])
        u, c = np.unique(got, return_counts=True)
        ids.append(u.astype(np.int32).tobytes())
        counts.append(c.astype(np.int32).tobytes())
    return {"ids": pa.array(ids, pa.binary()), "counts": pa.array(counts, pa.binary())}


def _fit(bags: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 11) -> Model:
    """Stochastic gradient descent on the log loss of the softmax, one small batch at a time."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((N_FEATURES, WIDTH), np.float32) - np.float32(0.5)) / WIDTH
    out = (rng.random((WIDTH, 2), np.float32) - np.float32(0.5)) / WIDTH
    bias = np.zeros(2, np.float32)
    if len({y for _, _, y in bags}) < 2:  # one label or none: its share, whatever the text
        share = np.mean([y for _, _, y in bags]) if bags else 0.5
        return Model(np.zeros(N_FEATURES, np.float32), float(np.log((share + 0.01) / (1.01 - share))))
    flat, batch, steps = vectors.reshape(-1), 16, 0
    total = EPOCHS * -(-len(bags) // batch)
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            some = [bags[i] for i in order[lo : lo + batch]]
            ids = np.concatenate([b[0] for b in some])
            share = np.concatenate([b[1] / b[1].sum() for b in some]).astype(np.float32)
            bounds = np.concatenate(([0], np.cumsum([len(b[0]) for b in some])[:-1]))
            mean = np.add.reduceat(vectors[ids] * share[:, None], bounds, axis=0)
            logit = mean @ out + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), [b[2] for b in some]] -= 1  # gradient of the logits
            rate = np.float32(0.5 * (1 - steps / total))
            steps += 1
            pull = p @ out.T
            out -= rate * (mean.T @ p)
            bias -= rate * p.sum(0)
            row = np.repeat(np.arange(len(some)), [len(b[0]) for b in some])
            # A feature's own step grows with its rarity, so that few-percent marks are learned too.
            step = (rate * np.float32(60.0)) * share[:, None] * pull[row]
            np.subtract.at(flat, (ids[:, None] * WIDTH + np.arange(WIDTH)).ravel(), step.ravel())
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, max_rows: int = MAX_ROWS, max_text_bytes: int = MAX_TEXT_BYTES) -> Model:
    """Learn from at most ``max_rows`` labelled texts of at most ``max_text_bytes`` bytes."""
    sample = learn.labelled_sample(docs, labels, "quality", learnable, max_rows, max_text_bytes)
    bags = learn.score_rows(sample, _bags, "ids binary, counts binary", text="_text")
    rows = sorted(bags.collect(), key=lambda r: (r["_id"], r["ids"]))
    return _fit([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.int32), r["_label"]) for r in rows if r["ids"]])


def _scorer(weight: np.ndarray, bias: float, name: str):
    def score(chunk: textnum.Chunk) -> dict:
        total, n = np.zeros(len(chunk)), np.zeros(len(chunk))
        for features, a, b in _features(chunk):
            sums = np.concatenate(([0.0], np.cumsum(weight[features], dtype=np.float64)))
            total += sums[b] - sums[a]
            n += b - a
        return {name: learn.sigmoid(total / np.maximum(n, 1) + bias)}

    return score


def score(docs: DataFrame, model: Model, name: str = "score", keep_text: bool = False) -> DataFrame:
    """``docs``, its ``text`` only if ``keep_text``, plus a column ``name``: the share of label 1.

    A null or empty text has no feature and gets the score of the bias alone.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.weight)
    bias = model.bias
    return learn.score_rows(docs, lambda chunk: _scorer(shared.value, bias, name)(chunk), f"`{name}` double", keep_text=keep_text)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    name = learn.unused(docs, "quality_score")
    return score(docs, model, name, keep_text=True).filter(F.col(name) >= threshold).drop(name)


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 from a score of 0.5).

    Learns only from labelled rows outside the fold ``crc32(doc_id) mod modulus = held``.
    Null ids are scored and belong to the fold of the empty text. Extra columns are ignored.
    """
    model = fit(docs, labels, textnum.fold(F.col("doc_id"), modulus) != held)
    rows = docs.select("doc_id", (textnum.fold(F.col("doc_id"), modulus) == held).alias("held_out"), "text")
    return score(rows, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
