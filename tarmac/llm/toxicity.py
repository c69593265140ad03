"""Convolutional text classifier for toxicity.

Words (letters and digits, A-Z folded) are hashed into an embedding table, longer words also
by their first ``STEM`` bytes, and a word's embedding is the sum of both. Words and stems in
too few of the labelled texts share the bucket of the empty word, else single rare words
would explain their texts; texts are counted over all labelled rows. Filters of width
1, 2 and 3 slide over the word sequence; each filter keeps its largest response in the text
(max pooling); a logistic output reads the pooled responses. All parts are trained together
with Adagrad on every labelled text of the fold, in Arrow tasks: shards of the rows train
copies of the parameters, whose changes are averaged ``ROUNDS`` times (``learn``).

A filter of width w is linear before pooling, so scoring looks up ``table[offset][word]``
and adds w rows: each text is scored whole, in Arrow tasks, without a shuffle. Words at the
end of a text see empty words beyond it.

The raw probability is calibrated by language: on a fifth of the rows, kept out of the
gradient, each language gets the threshold with the fewest errors, and its logit is
subtracted, so that 0.5 is the threshold everywhere. Logits are tallied in steps of
``1 / LOGIT_STEPS``, so all rows count and the driver sees tallies only. The language is guessed
from the text's own function words; the ``lang`` column is never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import learn, textnum

BITS = 15  # embedding buckets; bucket 0 is the empty word
WIDTH = 12  # numbers in an embedding
FILTERS = 8  # of each width
WIDTHS = (1, 2, 3)
STEM = 4  # bytes at the start of a word
EPOCHS = 10
ROUNDS = 5  # after each the shards' changes are averaged
MIN_TEXTS = 5  # a word needs so many texts for an embedding of its own, where a label has no more than
MIN_TEXTS_OF = 3000  # texts; where it has more, that share of them
KNOWN_BITS = 22  # of the table that says which hashes are known words
KNOWN_BLOCK = 1 << 16  # slots of that table counted together
DROP = 0.3  # share of words left out of each training step
CALIBRATION = 5  # every fifth row of a shard calibrates
PIECE = 1 << 18  # words of a batch whose responses are held at once
LOGIT_STEPS, LOGIT_LIMIT = 128, 60  # tallied logits: steps of one, and the largest

# Frequent function words of each language.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "are", "this", "by"],
    "fr": ["le", "la", "les", "des", "et", "du", "une", "un", "est", "que", "qui", "dans", "pour", "sur", "pas", "avec"],
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "ein", "eine", "nicht", "auf", "für", "sich", "dem"],
    "es": ["el", "los", "las", "de", "y", "que", "por", "con", "para", "una", "se", "del", "lo", "como", "más", "no"],
}
LANGUAGES = list(FUNCTION_WORDS)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - KNOWN_BITS)).astype(np.int32)


def _bucket(slots: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Embedding bucket of each word, 0 if it is not a known one; buckets are the low bits of slots."""
    return np.where(known[slots], slots & ((1 << BITS) - 1) | 1, 0).astype(np.int32)


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return textnum.PrefixHash(data).of(np.concatenate(([0], ends[:-1])), ends)


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the function words, and for each a row of votes."""
    pairs = [(h, k) for k, name in enumerate(LANGUAGES) for h in _hash_words(FUNCTION_WORDS[name])]
    keys = np.unique(np.array([h for h, _ in pairs], np.uint64))
    votes = np.zeros((len(keys), len(LANGUAGES)), np.int64)
    for h, k in pairs:
        votes[np.searchsorted(keys, h), k] += 1
    return keys, votes


_LANGUAGE_KEYS, _LANGUAGE_VOTES = _language_table()


@dataclass
class Model:
    known: np.ndarray  # by slot: a word with an embedding
    tables: list[np.ndarray]  # by width: (w, buckets, filters)
    shift: list[np.ndarray]  # by width: a number for each filter
    out: np.ndarray
    bias: float
    threshold: np.ndarray  # a logit for each language


def _words(chunk: textnum.Chunk):
    """(hash of each word, hash of its stem or 0, index of each row's first word)."""
    starts, ends, first = chunk.words(textnum.PUNCTUATION)
    prefix = textnum.PrefixHash(textnum.LOWER[chunk.data])
    stems = textnum.mix(prefix.of(starts, np.minimum(starts + STEM, ends)))
    return prefix.of(starts, ends), np.where(ends - starts > STEM, stems, np.uint64(0)), first


def _language(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of each row's language: most function words, ties and none to the first listed."""
    at = np.minimum(np.searchsorted(_LANGUAGE_KEYS, hashes), len(_LANGUAGE_KEYS) - 1)
    found = np.flatnonzero(_LANGUAGE_KEYS[at] == hashes)
    votes = np.concatenate((np.zeros((1, len(LANGUAGES)), np.int64), np.cumsum(_LANGUAGE_VOTES[at[found]], 0)))
    bounds = np.searchsorted(found, first)
    return (votes[bounds[1:]] - votes[bounds[:-1]]).argmax(1)


def _padded(buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets (words, stems) with empty words after each row, so that a filter never reaches the next row."""
    pad = max(WIDTHS)
    n = np.diff(first)
    ids = np.zeros((2, buckets.shape[1] + pad * len(n) + pad), np.int32)
    rows = np.repeat(np.arange(len(n)), n)
    ids[:, np.arange(buckets.shape[1]) + pad * rows] = buckets
    return ids, first[:-1] + pad * np.arange(len(n))


def _pool(ids: np.ndarray, begin: np.ndarray, tables, shift):
    """Largest response of each filter in each row: rows by all filters, widths one after another."""
    size = ids.shape[1] - max(WIDTHS)
    out = []
    for table, add in zip(tables, shift):
        response = table[0][ids[0, :size]]
        response += table[0][ids[1, :size]]
        for k in range(1, len(table)):
            for own in ids:
                response += table[k][own[k : k + size]]
        out.append(np.maximum(np.maximum.reduceat(response, begin, axis=0) + add, 0) if len(begin) else np.empty((0, FILTERS)))
    return np.concatenate(out, 1)


def _sequences(chunk: textnum.Chunk) -> dict:
    import pyarrow as pa

    hashes, stems, first = _words(chunk)
    slots = _slot(np.stack((hashes, stems)))
    return {
        "ids": pa.array([slots[:, a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
        "language": _language(hashes, first).astype(np.int32),
    }


class Parameters:
    """All numbers that are learned, in two arrays; a row of ``table`` is an embedding and its Adagrad memory."""

    def __init__(self, table: np.ndarray, flat: np.ndarray):
        self.E, self.E_memory = table[:, :WIDTH], table[:, WIDTH:]
        shapes = [(w, WIDTH, FILTERS) for w in WIDTHS] + [(FILTERS,)] * len(WIDTHS) + [(FILTERS * len(WIDTHS),), (1,)]
        dense = []
        for half in flat.reshape(2, -1):  # the numbers, then their memories
            ends = np.cumsum([int(np.prod(shape)) for shape in shapes])
            dense.append([a.reshape(shape) for a, shape in zip(np.split(half, ends[:-1]), shapes)])
        n = len(WIDTHS)
        self.filters, self.shift, self.out, self.bias = dense[0][:n], dense[0][n : 2 * n], dense[0][-2], dense[0][-1]
        self.memory = {id(a): m for a, m in zip(dense[0], dense[1])}
        self._dense = dense  # keeps the views that ``memory`` names by id


def _begin(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Table and flat array of the parameters before training."""
    rng = np.random.default_rng(seed)
    table = np.full((1 << BITS, 2 * WIDTH), 1e-7, np.float32)
    dense = sum(w * WIDTH * FILTERS + 2 * FILTERS for w in WIDTHS) + 1
    flat = np.full(2 * dense, 1e-7, np.float32)
    flat[:dense] = 0
    p = Parameters(table, flat)
    p.E[:] = rng.standard_normal(p.E.shape) * 0.1
    p.E[0] = 0
    for f in p.filters:
        f[:] = rng.standard_normal(f.shape) * 0.3
    p.out[:] = rng.standard_normal(p.out.shape) * 0.3
    return table, flat


def _peaks(own: list[np.ndarray], back: np.ndarray, begin: np.ndarray, row_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of each filter's largest response in each row, first of equals: rows by filters."""
    size = int(row_end[-1])
    best, place = np.full((len(begin), FILTERS), -np.inf, np.float32), np.zeros((len(begin), FILTERS), np.int64)
    for lo in range(0, size, PIECE):
        hi = min(size, lo + PIECE)
        response = np.zeros((hi - lo, FILTERS), np.float32)
        for k, numbers in enumerate(own):
            response += numbers[back[0, lo + k : hi + k]]
            response += numbers[back[1, lo + k : hi + k]]
        for i in range(int(np.searchsorted(row_end, lo, "right")), int(np.searchsorted(begin, hi, "left"))):
            a, b = max(int(begin[i]), lo), min(int(row_end[i]), hi)
            at = response[a - lo : b - lo].argmax(0)
            value = response[a - lo + at, np.arange(FILTERS)]
            better = value > best[i]
            best[i][better], place[i][better] = value[better], (a + at)[better]
    return place, best


def _train(p: Parameters, train: list[tuple[np.ndarray, int]], positive: float, rng: np.random.Generator) -> None:
    """Some epochs of Adagrad on the weighted log loss, in place; rows are (buckets of words and stems, label)."""
    weight = {1: min(5.0, 0.5 / positive), 0: 1.0}
    rate, batch, pad = np.float32(0.03), 16, max(WIDTHS)

    def step(a, g):
        p.memory[id(a)] += g * g
        a -= rate * g / np.sqrt(p.memory[id(a)])

    for _ in range(EPOCHS // ROUNDS):
        order = rng.permutation(len(train))
        for lo in range(0, len(order), batch):
            some = [train[i] for i in order[lo : lo + batch]]
            first = np.concatenate(([0], np.cumsum([r[0].shape[1] for r in some])))
            ids = np.zeros((2, first[-1] + pad * (len(some) + 1)), np.int32)
            begin = first[:-1] + pad * np.arange(len(some))
            for a, r in zip(begin, some):
                ids[:, a : a + r[0].shape[1]] = np.where(rng.random(r[0].shape, np.float32) < DROP, 0, r[0])
            row_end = np.append(begin[1:], ids.shape[1] - pad)
            used, back = np.unique(ids, return_inverse=True)
            back = back.reshape(ids.shape)
            local = p.E[used]
            pooled, where = [], []
            for f, add in zip(p.filters, p.shift):
                at, value = _peaks([local @ own for own in f], back, begin, row_end)
                where.append(at)
                pooled.append(value + add)
            act = np.concatenate(pooled, 1)
            live = act > 0
            y = np.array([r[1] for r in some])
            chance = learn.sigmoid(np.maximum(act, 0) @ p.out + p.bias[0])
            g = ((chance - y) * np.array([weight[int(v)] for v in y]) / len(some)).astype(np.float32)
            g_act = (g[:, None] * p.out) * live
            g_out = np.maximum(act, 0).T @ g
            g_E = np.zeros((len(used), WIDTH), np.float32)
            for j, (f, add, at) in enumerate(zip(p.filters, p.shift, where)):
                part = g_act[:, j * FILTERS : (j + 1) * FILTERS]
                g_f = np.empty_like(f)
                for k in range(len(f)):
                    pull = (part[:, :, None] * f[k].T[None]).reshape(-1, WIDTH)
                    g_f[k] = 0
                    for own in back:
                        seen = own[at + k]  # rows by filters
                        g_f[k] += np.einsum("rf,rfd->df", part, local[seen])
                        np.add.at(g_E, seen.ravel(), pull)
                step(f, g_f)
                step(add, part.sum(0))
            step(p.out, g_out)
            step(p.bias, g.sum(keepdims=True))
            if used[0] == 0:
                g_E[0] = 0
            p.E_memory[used] += g_E * g_E
            p.E[used] -= rate * g_E / np.sqrt(p.E_memory[used])


def _slots_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int32).reshape(2, -1)


def _known_words(rows: DataFrame, texts: dict[int, int]) -> np.ndarray:
    """By slot whether it is a known word: counted over all labelled texts, each label's by blocks of slots."""
    share = [min(1.0, MIN_TEXTS_OF / max(1, texts.get(y, 0))) for y in (0, 1)]

    def count(batches):
        import pyarrow as pa

        for _, _, some in learn.parts(batches, ["ids"]):
            found = [[np.unique(_slots_of(ids)) for label, ids in some if label == y] for y in (0, 1)]
            for y in (0, 1):
                slots, n = np.unique(np.concatenate([np.empty(0, np.int32), *found[y]]), return_counts=True)
                bounds = np.searchsorted(slots, np.arange(0, (1 << KNOWN_BITS) + 1, KNOWN_BLOCK))
                at = [(k, a, b) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _, _ in at], pa.int32()),
                        pa.array([y] * len(at), pa.int32()),
                        pa.array([slots[a:b].tobytes() for _, a, b in at], pa.binary()),
                        pa.array([n[a:b].astype(np.int32).tobytes() for _, a, b in at], pa.binary()),
                    ],
                    names=["block", "label", "slots", "texts"],
                )

    def judge(group):
        import pyarrow as pa

        block = group.column("block")[0].as_py()
        total = np.zeros((2, KNOWN_BLOCK), np.int64)
        for y, slots, n in zip(*(group.column(c).to_pylist() for c in ("label", "slots", "texts"))):
            total[y][np.frombuffer(slots, np.int32) - block * KNOWN_BLOCK] += np.frombuffer(n, np.int32)
        bits = np.packbits(total[0] * share[0] + total[1] * share[1] >= MIN_TEXTS)
        return pa.table({"block": pa.array([block], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    known = np.zeros(1 << KNOWN_BITS, bool)
    counts = rows.mapInArrow(count, "block int, label int, slots binary, texts binary")
    for r in counts.groupBy("block").applyInArrow(judge, "block int, bits binary").toLocalIterator():
        known[r["block"] * KNOWN_BLOCK :][:KNOWN_BLOCK] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    known[0] = False  # no stem
    return known


def _fit(rows: DataFrame, texts: dict[int, int], seed: int = 5) -> Model:
    """Rounds of Adagrad over all shards; ``texts`` says how many rows each label has."""
    known = _known_words(rows, texts)
    flat_threshold = np.zeros(len(LANGUAGES))
    total = sum(texts.values())
    positive = texts.get(1, 0) / total if total else 0.5
    if not 0 < positive < 1:  # one label or none: its share, whatever the text
        zero = [np.zeros((w, 1 << BITS, FILTERS), np.float32) for w in WIDTHS]
        none, out = [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32)
        return Model(known, zero, none, out, float(np.log((positive + 0.01) / (1.01 - positive))), flat_threshold)
    context = rows.sparkSession.sparkContext
    words = context.broadcast(np.packbits(known))
    table, flat = _begin(seed)

    for turn in range(ROUNDS):
        shared = context.broadcast((table, flat))

        def run(batches, shared=shared, turn=turn):
            is_known = np.unpackbits(words.value).astype(bool)

            def train(now, shard, first, some):
                kept = [(_bucket(_slots_of(ids), is_known), y) for i, (y, ids) in enumerate(some, first) if i % CALIBRATION]
                _train(Parameters(*now), kept, positive, np.random.default_rng([seed, turn, shard, first]))

            return learn.learn_shards(batches, ["ids"], lambda: shared.value, train)

        learn.merge_shards(rows.mapInArrow(run, learn.CHANGES), table, flat)
        shared.destroy()
    p = Parameters(table, flat)
    tables = [np.stack([p.E @ own for own in f]) for f in p.filters]
    model = Model(known, tables, [a.copy() for a in p.shift], p.out.copy(), float(p.bias[0]), flat_threshold)
    model.threshold = _thresholds(rows, model)
    words.destroy()
    return model


def _thresholds(rows: DataFrame, model: Model) -> np.ndarray:
    """By language the logit between the classes with the fewest errors, of equals the middle one."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def tally(batches):
        import pyarrow as pa

        for _, first, some in learn.parts(batches, ["language", "ids"]):
            model = shared.value
            got = [
                (language, y, _logits(_bucket(slots, model.known), np.array([0, slots.shape[1]]), model)[0])
                for i, (y, language, slots) in enumerate(((y, k, _slots_of(ids)) for y, k, ids in some), first)
                if i % CALIBRATION == 0
            ]
            steps = np.round(np.clip([x for _, _, x in got], -LOGIT_LIMIT, LOGIT_LIMIT) * LOGIT_STEPS).astype(np.int64)
            keys, n = np.unique(np.array([[k, x, y] for (k, y, _), x in zip(got, steps)], np.int64).reshape(-1, 3), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys.T, n)], names=["language", "step", "label", "n"])

    tallies = rows.mapInArrow(tally, "language long, step long, label long, n long")
    tallies = tallies.groupBy("language", "step").agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)), F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)))
    table = np.array([tuple(r) for r in tallies.toLocalIterator()], np.int64).reshape(-1, 4)
    shared.destroy()

    def best(mask):
        x, back = np.unique(table[mask, 1], return_inverse=True)
        zeros, ones = (np.bincount(back, table[mask, c], len(x)).astype(np.int64) for c in (2, 3))
        if zeros.sum() + ones.sum() < 20 or not zeros.sum() or not ones.sum():
            return None
        errors = np.concatenate(([0], np.cumsum(ones))) + np.concatenate((np.cumsum(zeros[::-1])[::-1], [0]))
        cut = np.flatnonzero(errors == errors.min())
        cut = cut[(cut > 0) & (cut < len(x))]
        if not len(cut):
            return None
        edges = (x[cut - 1] + x[cut]) / 2 / LOGIT_STEPS
        return float(edges[len(edges) // 2])

    common = best(np.ones(len(table), bool)) or 0.0
    own = [best(table[:, 0] == k) for k in range(len(LANGUAGES))]
    return np.array([common if t is None else t for t in own])


def _logits(buckets: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    ids, begin = _padded(buckets, first)
    return _pool(ids, begin, model.tables, model.shift) @ model.out + model.bias


def fit(docs: DataFrame, labels: DataFrame, learnable: Column) -> Model:
    """Learn from every labelled text, whole; ``learnable`` is a predicate on doc_id."""
    rows = learn.labelled_shards(docs, labels, "toxic", learnable, _sequences, "ids binary, language int")
    return _fit(rows, {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (any columns with ``text``) without the text, plus ``score``: the calibrated share of label 1.

    A null or empty text pools the responses of empty words only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(chunk: textnum.Chunk) -> dict:
        hashes, stems, first = _words(chunk)
        shift = shared.value.threshold[_language(hashes, first)]
        return {"score": learn.sigmoid((_logits(_bucket(_slot(np.stack((hashes, stems))), shared.value.known), first, shared.value) - shift).astype(np.float64))}

    return learn.score_rows(docs, run, "score double", max_bytes=1 << 19)


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 from a score of 0.5).

    Learns only from labelled rows outside the fold ``crc32(doc_id) mod modulus = held``.
    Null ids are scored and belong to the fold of the empty text. Extra columns are ignored.
    """
    model = fit(docs, labels, textnum.fold(F.col("doc_id"), modulus) != held)
    rows = docs.select("doc_id", (textnum.fold(F.col("doc_id"), modulus) == held).alias("held_out"), "text")
    return score(rows, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
