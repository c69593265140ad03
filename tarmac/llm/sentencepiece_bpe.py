"""SentencePiece encoding and decoding with a merge-type (BPE) model, by a prefix table.

Encoding merges the adjacent pair of best score again and again. Of a text's every prefix the
last token is unique, and a sequence of tokens is an encoding exactly when each of its
adjacent pairs, encoded alone, stays that pair. So one pass fills a table: an automaton gives
the tokens that end at a position, and the one of them that is compatible with the last token
of the prefix before it is stored. The ids are recovered backwards from the end of the text.
The work is linear in the text, however long it is, where merging pair by pair is not.

No piece of such a vocabulary has a space after another character. Nothing then merges across
a place where a space follows a non-space, and the text is encoded in these parts; the parts
of a task's texts repeat, and are kept. A vocabulary that has such a piece is encoded whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tarmac.llm import textnum

SPACE = "▁"  # stands for a blank inside pieces
NORMAL, BYTE, CONTROL, UNKNOWN = "normal", "byte", "control", "unknown"
UNKNOWN_TEXT = " ⁇ "  # what an unknown id decodes to

KEPT_PARTS = 300_000  # parts of texts that a task keeps, each of ``KEPT_LENGTH`` code points at most
KEPT_LENGTH = 48
KEPT_PAIRS = 2_000_000


@dataclass
class Vocabulary:
    """Pieces, their scores and kinds; the id is the place."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]
    end: int

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a model file, on the driver. Only models that normalise by identity, put a blank
        before the text, keep extra blanks and fall back to bytes are taken."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kind = lambda i: CONTROL if model.is_control(i) else UNKNOWN if model.is_unknown(i) else BYTE if model.is_byte(i) else NORMAL
        found = cls([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], [kind(i) for i in ids], model.eos_id())
        probe = " Ａ ﬁ  é\t"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normalisation is not the identity with a blank before the text")
        if found.kinds.count(BYTE) != 256 or any(model.is_unused(i) for i in ids):
            raise ValueError("the model has no byte fallback, or unused pieces")
        return found


class Encoder:
    """Encodes and decodes in one Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.ids = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.kinds[i] == NORMAL}
        #: Byte pieces come in the order of their values.
        self.first_byte = vocabulary.kinds.index(BYTE)
        self.pairs: list[dict[int, bool]] = [{} for _ in vocabulary.pieces]
        self.n_pairs = 0
        self.whole = [False] * len(vocabulary.pieces)
        self.length = [len(p) for p in vocabulary.pieces]
        for piece, i in self.ids.items():
            self.whole[i] = self.merge(piece) == [piece]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.whole[i]:  # other pieces are never the last token of anything
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        apart = not any(p[k] != SPACE and p[k + 1] == SPACE for p in self.ids for k in range(len(p) - 1))
        self.part = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s:.+)")
        self.kept: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text, by merging the best pair, leftmost first."""
        at = list(text)
        scores = self.vocabulary.scores
        while True:
            best, place = None, -1
            for k in range(len(at) - 1):
                i = self.ids.get(at[k] + at[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, place = scores[i], k
            if place < 0:
                return at
            at[place : place + 2] = [at[place] + at[place + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """The two pieces, encoded together, stay these two."""
        if self.n_pairs >= KEPT_PAIRS:
            self.pairs = [{} for _ in self.length]
            self.n_pairs = 0
        a, b = self.vocabulary.pieces[left], self.vocabulary.pieces[right]
        found = self.pairs[left][right] = self.merge(a + b) == [a, b]
        self.n_pairs += 1
        return found

    def encode_part(self, text: str) -> list[int]:
        """Ids of a part, from its prefix table."""
        n = len(text)
        # -1: a character outside the vocabulary
        last = array("i", [-1]) * (n + 1) if n > 1 << 16 else [-1] * (n + 1)
        pairs, length = self.pairs, self.length
        for end, i in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:  # the token is unique
                continue
            start = end - length[i]
            # Before the start lies the text's begin or an outside character, which merges with nothing, or a token.
            left = last[start]
            if left >= 0:
                fits = pairs[left].get(i)
                if fits is None:
                    fits = self.compatible(left, i)
                    pairs = self.pairs
                if not fits:
                    continue
            last[end] = i
        out: list[int] = []
        while n:
            i = last[n]
            if i >= 0:
                out.append(i)
                n -= length[i]
            else:
                n -= 1
                out.extend(self.first_byte + b for b in reversed(text[n].encode("utf-8", "replace")))
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text as the library gives them, without control ids. An empty text has none."""
        if not text:
            return []
        parts = self.part.findall(SPACE + text.replace(" ", SPACE))
        found = list(map(self.kept.get, parts))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self.kept.get(parts[k]) or self._keep(parts[k])
        return list(chain.from_iterable(found))

    def _keep(self, part: str) -> tuple[int, ...]:
        ids = tuple(self.encode_part(part))
        if len(part) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_PARTS:
                self.kept.clear()
            self.kept[part] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids give nothing, runs of byte ids are read as UTF-8, where
        each byte that is not part of a character gives U+FFFD; one blank at the begin goes."""
        vocabulary, out, run = self.vocabulary, [], bytearray()
        for i in ids:
            kind = vocabulary.kinds[i]
            if kind == BYTE:
                run.append(i - self.first_byte)
                continue
            if run:
                out.append(_characters(bytes(run)))
                run.clear()
            if kind == NORMAL:
                piece = vocabulary.pieces[i]
                if not out and piece.startswith(SPACE):
                    piece = piece[1:]
                    out.append("")
                out.append(piece.replace(SPACE, " "))
            elif kind == UNKNOWN:
                out.append(UNKNOWN_TEXT)
        if run:
            out.append(_characters(bytes(run)))
        return "".join(out)


def _characters(data: bytes) -> str:
    """UTF-8 text; each byte outside a valid character becomes U+FFFD."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        out, k = [], 0
        while k < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[k : k + size].decode("utf-8"))
                    k += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                k += 1
        return "".join(out)


class Decoder:
    """Decodes the id lists of a batch together: pieces as bytes, one after another."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        vocabulary = encoder.vocabulary
        texts = {NORMAL: lambda p, i: p.replace(SPACE, " ").encode(), UNKNOWN: lambda p, i: UNKNOWN_TEXT.encode(), CONTROL: lambda p, i: b"", BYTE: lambda p, i: bytes([i - encoder.first_byte])}
        pieces = [texts[k](p, i) for i, (p, k) in enumerate(zip(vocabulary.pieces, vocabulary.kinds))]
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.blank = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(vocabulary.pieces, vocabulary.kinds)])
        self.control = np.array([k == CONTROL for k in vocabulary.kinds])

    def decode(self, flat: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of ``flat[offsets[k]:offsets[k + 1]]``."""
        size = self.size[flat]
        end = np.cumsum(size)
        data = self.data[np.repeat(self.start[flat] - end + size, size) + np.arange(end[-1] if len(end) else 0)].tobytes()
        at = np.concatenate(([0], end))[offsets]
        shown = np.concatenate(([0], np.cumsum(size > 0)))  # the first id that gives text may lose its blank
        place = np.searchsorted(shown, shown[offsets[:-1]], "right") - 1
        # A control id inside a text parts the byte ids around it; the end id does not.
        inside = np.concatenate(([0], np.cumsum(self.control[flat])))
        parted = (inside[np.maximum(offsets[1:] - 1, offsets[:-1])] - inside[offsets[:-1]]).tolist()
        out = []
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            if parted[k]:
                out.append(self.encoder.decode(flat[offsets[k] : offsets[k + 1]].tolist()))
                continue
            if a < b and self.blank[flat[place[k]]]:
                a += 1
            try:  # pieces are whole characters, so bytes that are wrong together are wrong in a run of byte ids
                out.append(data[a:b].decode("utf-8"))
            except UnicodeDecodeError:
                out.append(self.encoder.decode(flat[offsets[k] : offsets[k + 1]].tolist()))
        return out


_encoders: list[tuple[Vocabulary, Encoder]] = []


def _encoder(shared) -> Encoder:
    """One for each Python worker and vocabulary; the last one used is kept."""
    vocabulary = shared.value
    if not _encoders or _encoders[0][0] != vocabulary:
        _encoders[:] = [(vocabulary, Encoder(vocabulary))]
    return _encoders[0][1]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about 1 MB, each with the place of its first."""
    for chunk in textnum.chunks(column):
        yield chunk.first, [chunk.text_bytes(i).decode("utf-8", "replace") for i in range(len(chunk))]


def encode(docs: DataFrame, model: str, text: str = "text", end: bool = True, column: str = "ids") -> DataFrame:
    """``docs`` with the array column ``column``: the ids of ``text``, and the end id with ``end``.

    The vocabulary is read on the driver and broadcast; its size is the model's, whatever the
    corpus. Null and empty texts have no ids but the end's. Bytes that are not UTF-8 count as
    U+FFFD. A column named like the new one is replaced; all rows and other columns stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model))
    docs = docs.drop(column)
    place = docs.columns.index(text)

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        tail = [encoder.vocabulary.end] if end else []
        for batch in batches:
            for first, texts in _texts(batch.column(place)):
                found = [np.array(encoder.encode(t) + tail, np.int32) for t in texts]
                sizes = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(found)))
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*rows.columns, ids], [*rows.schema.names, column])

    schema = StructType([*docs.schema.fields, StructField(column, ArrayType(IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the string column ``column``: the text that the id array ``ids`` stands for (null: empty).

    An id outside the vocabulary fails, as in the library. A column named like the new one is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.read(model))
    rows = rows.drop(column)
    place = rows.columns.index(ids)

    def run(batches) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_encoder(shared))
        for batch in batches:
            lists = batch.column(place).fill_null([]) if batch.column(place).null_count else batch.column(place)
            offsets = lists.offsets.to_numpy()
            row = 0
            while row < batch.num_rows:  # runs of ids whose text is about a megabyte
                stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + (1 << 18), "right")) - 1)
                at = offsets[row : stop + 1]
                texts = decoder.decode(lists.values[at[0] : at[-1]].to_numpy(), at - at[0])
                part = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, column])
                row = stop

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(column, StringType())]))


def digests(docs: DataFrame, model: str) -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256. A null doc_id stays null."""
    rows = decode(encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).drop("text"), model)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
