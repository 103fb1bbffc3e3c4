"""Words and shingles of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text's shingles are its windows of ``width`` words;
with fewer words the whole sequence is one shingle; without words there is none. Null counts as empty.
Hashes are 64-bit: two different words or shingles share one with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1B54A32D192ED03)
_M1, _M2, _S = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(32)
#: Bytes of text whose numpy arrays a task holds at once (a longer single text is taken whole).
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _S)
    x = x * _M1
    x ^= x >> _S
    x *= _M2
    x ^= x >> _S
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over bytes, for :func:`span_hash`."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=total[1:])
    return total


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end; equal bytes give equal hashes wherever they stand."""
    inverse = powers(_INVERSE, len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64) * _STEP)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, bytes, offsets."""
    data, offsets = utf8(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def alphanumeric(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to words of ASCII letters and digits and any non-ASCII characters."""
    low = data | 32
    return ((low >= 97) & (low <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (n + 1 entries)."""
    if inside is None:
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def window_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = (total * _STEP) + mix(words[i : i + n] + np.uint64(i))
    return mix(total)


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes in order, their starts and ends, and the first word of each text."""
    starts, ends, first = word_spans(data, offsets, inside)
    return span_hash(prefix_hash(lowered(data)), starts, ends), starts, ends, first


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes in rising order."""
    for _, data, offsets in slices(column):
        words, _, _, first = word_hashes(data, offsets)
        grams = window_hash(words, width)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                yield np.unique(grams[a : b - width + 1])
            elif b > a:
                yield window_hash(words[a:b], b - a)
            else:
                yield np.zeros(0, dtype=np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)
