"""Word and byte fingerprints of batches of texts, for functions that run inside mapInArrow.

A fingerprint of a byte range is a polynomial over random byte values, so that prefix sums give
the fingerprint of any range of a text in constant time. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in pieces of about so many bytes; a longer text is one piece.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20_011))
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SECOND = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_of(base: int, n: int) -> np.ndarray:
    table = np.full(n, base, np.uint64)
    table[0] = 1
    return np.cumprod(table)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse; those for pieces of the usual size are kept."""
    if n > CHUNK_BYTES + 1:
        return _powers_of(_BASE, n), _powers_of(_INVERSE, n)
    if len(_powers[0]) < n:
        _powers[:] = [_powers_of(b, CHUNK_BYTES + 1) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: equal inputs stay equal, close inputs end far apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text starts; null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of a bounded size with the bytes of their texts and the offsets of the texts."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


class ByteSums:
    """Fingerprints of byte ranges [start, end) of one piece; `second` gives independent ones."""

    def __init__(self, data: np.ndarray, lowered: bool = False, second: bool = False):
        power, self._inverse = _power_tables(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_SECOND if second else _LOWERED if lowered else _VALUES)[data] * power[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])


class RangeSums:
    """Fingerprints of ranges [start, end) of a row of 64-bit values, by content and length."""

    def __init__(self, values: np.ndarray):
        power, self._inverse = _power_tables(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word (one more at the end).

    Words are runs of bytes other than `breaks`, by default the six ASCII spaces; they never cross texts.
    """
    solid = ~breaks[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    cut = first[:-1]
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    starts = np.flatnonzero(solid & (~before | cut))
    ends = np.flatnonzero(solid & (~after | np.concatenate([cut[1:], [True]]))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A fingerprint for each word with A-Z lowered, and each text's first word."""
    starts, ends, first = word_spans(data, offsets)
    return ByteSums(data, lowered=True).of(starts, ends), first


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Fingerprints of all runs of `size` words of one text or of several texts in a row."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + words[k : k + n]
    return mix(out)


def shingle_sets(words: np.ndarray, first: np.ndarray, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text.

    A text of fewer words is one shingle of all its words; a text without words has none.
    """
    runs = shingle_hashes(words, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            yield shingle_hashes(words[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def window_minima(values: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `width` values within one text: its start, and the place of its least value.

    Values are compared by their upper bits; the first of equal ones counts, which depends on what
    the window holds and not on where it is.
    """
    n = len(values)
    bits = np.uint64(max(24, n.bit_length()))
    least = (values >> bits << bits) | np.arange(n, dtype=np.uint64)
    have = 1
    while 2 * have <= width and n > have:
        least = np.minimum(least[: n - 2 * have + 1], least[have : n - have + 1]) if n >= 2 * have else least[:0]
        have *= 2
    if have < width:
        m = max(0, n - width + 1)
        least = np.minimum(least[:m], least[width - have : width - have + m])
    starts = np.arange(len(least))
    inside = np.ones(len(least), bool)
    for edge in offsets[1:-1].tolist():
        inside[max(0, edge - width + 1) : edge] = False
    starts = starts[inside]
    return starts, (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
