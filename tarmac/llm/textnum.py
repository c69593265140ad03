"""Numpy views of text columns inside Arrow tasks: words, lines and substring hashes.

A chunk is a run of rows whose UTF-8 bytes lie in one buffer. Words are maximal runs of
bytes other than space and 0x09-0x0D; these separators are ASCII, so splitting bytes and
splitting characters agree.

Where equal digests decide a result, they come from ``digests`` and ``window_digests``, which
mix eight bytes, or two halves, at a time. ``PrefixHash`` gives the hash of any substring in
O(1) from prefix polynomial hashes modulo 2**64; sequences can be built that agree under it
(Thue-Morse words), so it serves only where equal hashes are compared again by content, and
for hashed features of a model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64)

#: True for bytes that separate words.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

#: True for every ASCII byte that is neither a letter nor a digit.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[128:] = False
PUNCTUATION[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False

#: Folds A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base (kind "up") or of its inverse (kind "down")."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), U64(_BASE if kind == "up" else _INVERSE))
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0x9FB21C651E98DF25)
    return h ^ (h >> U64(32))


class PrefixHash:
    """Prefix polynomial hashes of a sequence; ``of`` gives substring hashes in O(1) each."""

    def __init__(self, values: np.ndarray):
        mapped = _BYTES[values] if values.dtype == np.uint8 else mix(values.astype(U64) + U64(_BASE))
        self.prefix = np.zeros(len(values) + 1, U64)
        np.cumsum(mapped * _power("up", len(values)), out=self.prefix[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Comparable only between substrings of one length."""
        return (self.prefix[end] - self.prefix[start]) * _power("down", len(self.prefix))[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(U64) * U64(0xA24BAED4963EE407))

    def windows(self, size: int) -> np.ndarray:
        """Hash of the substring of ``size`` values at every start."""
        n = len(self.prefix) - size
        if n <= 0:
            return np.empty(0, U64)
        return mix((self.prefix[size:] - self.prefix[:n]) * _power("down", n))


_HALF = U64(0x9E3779B97F4A7C15)
_OTHER = U64(0xC2B2AE3D27D4EB4F)
LONG = 64  # bytes of a range from which on it is digested on its own


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, the first byte lowest; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, long: int = LONG) -> np.ndarray:
    """A 64-bit digest of each byte range; other seeds give independent ones.

    Ranges are read eight bytes at a time, all of them together; those over ``long`` bytes one by one.
    """
    import xxhash

    size = ends - starts
    state = mix(size.astype(U64) * _OTHER + U64(seed) * _HALF + U64(1))
    eight = eights(data)
    active = np.flatnonzero((size > 0) & (size <= long))
    for k in range(0, long, 8):
        active = active[size[active] > k] if k else active
        if not len(active):
            break
        left = size[active] - k
        block = eight[starts[active] + k] & (U64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(8 - left, 0)).astype(U64))
        state[active] = mix(state[active] + block * _HALF)
    view = memoryview(np.ascontiguousarray(data))
    for k in np.flatnonzero(size > long).tolist():
        state[k] = xxhash.xxh3_64_intdigest(view[starts[k] : ends[k]], seed)
    return state


def window_digests(values: np.ndarray, size: int) -> np.ndarray:
    """A digest of the ``size`` digests from each place on: of two halves, each digested so."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, U64)
    have, width = values, 1
    while 2 * width <= size:
        have = mix(have[:-width] * _OTHER + have[width:])
        width *= 2
    return mix(have[:n] * _OTHER + have[size - width : size - width + n] + U64(size))


def unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and bytes of each character of a script without spaces, first byte of their punctuation marks, in UTF-8.

    Thai, Lao, Myanmar, Khmer, Chinese and Japanese characters, full-width forms among them.
    """
    at = np.flatnonzero(data >= 0xE0)
    a, b, c = data[at], data[at + 1], data[at + 2]
    within = lambda x, lo, hi: (x >= lo) & (x <= hi)
    three = (a == 0xE0) & within(b, 0xB8, 0xBB) | (a == 0xE1) & (within(b, 0x80, 0x81) | within(b, 0x9E, 0x9F))
    three |= (a == 0xE2) & (b >= 0xBA) | within(a, 0xE3, 0xE9) | (a == 0xEF) & (within(b, 0xA4, 0xAB) | within(b, 0xBC, 0xBD))
    four = (a == 0xF0) & within(b, 0xA0, 0xB3)
    mark = (a == 0xE3) & (b == 0x80) | (a == 0xEF) & (b == 0xBC) & (within(c, 0x81, 0x8F) | within(c, 0x9A, 0xA0))
    lead = three | four
    return at[lead], np.where(four[lead], 4, 3), at[mark]


class Chunk:
    """Whole texts of consecutive rows: ``data`` bytes, row ``i`` at ``offsets[i]:offsets[i+1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, separator: np.ndarray = SEPARATOR, apart: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and for each row the index of its first word (one more at the end).

        ``separator`` says of each byte value whether it separates words. With ``apart`` each
        character of a script without spaces is a word, and its punctuation separates.
        """
        inside = ~separator[self.data]
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        if apart:
            lead, size, mark = unspaced(self.data)
            edge[lead] = edge[lead + size] = True
            for k in range(3):
                inside[mark + k] = False
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        after = np.zeros(n + 1, bool)
        after[:-1] = inside
        starts = np.flatnonzero(after & (~before | edge))
        ends = np.flatnonzero(before & (~after | edge))
        return starts, ends, np.searchsorted(starts, self.offsets)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte 0/1 array over each row."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def row_of(self, first_index: np.ndarray) -> np.ndarray:
        """Row of each item, given for each row the index of its first item."""
        return np.repeat(np.arange(len(self)), np.diff(first_index))

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def string_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), at


def chunks(column, max_bytes: int = 1 << 20) -> Iterator[Chunk]:
    """The rows of a string column in runs of about ``max_bytes``; a longer text makes a chunk of its own."""
    data, at = string_buffer(column)
    row, n = 0, len(at) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + max_bytes, "right")) - 1)
        stop = min(stop, n)
        yield Chunk(data[at[row] : at[stop]], at[row : stop + 1] - at[row], row)
        row = stop


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of ``n`` positions lying in some window ``start .. start + width``."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + width, n), -1)
    return np.cumsum(delta[:-1]) > 0


def fold(doc_id, modulus: int):
    """crc32 of the id as text, modulo; a Spark column. A null id counts as the text ''."""
    from pyspark.sql import functions as F

    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
