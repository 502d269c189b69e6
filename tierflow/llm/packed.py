"""Texts of an Arrow column as flat byte arrays: words, word hashes and window hashes without a Python loop per row.

Every function works on a *chunk*: the bytes of some whole rows in one array, and the row boundaries in ``offsets``. A
null text counts as an empty one. Hashes are 64 bit, equal on every machine, and depend on nothing but the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD1342543DE82EF95 | 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values, so that any of their bits can serve as a bucket number."""
    x = values.astype(_U)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def _byte_set(excluded: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for first, last in excluded:
        table[first:last + 1] = False
    return table


#: Bytes of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (the latter on lower-cased text).
VISIBLE = _byte_set([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = _byte_set([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.steps = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            size = max(n, 1 << 16) + n // 2
            for k, step in enumerate(self.steps):
                factors = np.full(size, step, dtype=_U)
                factors[0] = 1
                self.tables[k] = np.multiply.accumulate(factors)
        return self.tables


_BYTE_POWERS, _WINDOW_POWERS = _Powers(_BASE), _Powers(_WINDOW_BASE)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    _, where, data = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32, count=len(column) + 1, offset=column.offset * (8 if wide else 4))
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)`` of consecutive whole rows of about ``size`` bytes; a longer row is a chunk of its own."""
    if not len(column):
        return
    data, offsets = flat(column)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1, first + 65536)
        part = data[offsets[first]:offsets[last]]
        yield slice(first, last), _LOWER[part] if lower else part, offsets[first:last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of ``members`` bytes; a run never crosses rows."""
    inside = members[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, from prefix sums of byte value times base power (Rabin-Karp)."""
    power, inverse = _BYTE_POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE_VALUES[data] * power[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def window_hashes(values: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive values, rows not regarded: ``len(values) - width + 1`` hashes."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=_U)
    power, inverse = _WINDOW_POWERS.upto(n + 1)
    sums = np.zeros(n + 1, dtype=_U)
    np.cumsum((mix(values + _U(salt)) if salt else values) * power[:n], out=sums[1:])
    return mix((sums[width:] - sums[:n - width + 1]) * inverse[:n - width + 1] + _U(width))


def row_starts(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's values in an array sorted by row."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def whole_windows(bounds: np.ndarray, width: int) -> np.ndarray:
    """Start indices of windows that lie within one row, for values with row offsets ``bounds``."""
    n = int(bounds[-1])
    usable = np.ones(max(n, 0), dtype=bool)
    for back in range(1, width):
        ends = bounds[1:] - back
        usable[ends[ends >= bounds[:-1]]] = False
    return np.flatnonzero(usable)


def shingles(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, rows)`` of the ``width``-word shingles of each row; a row with fewer words, but not none, has its whole sequence."""
    n_rows = len(bounds) - 1
    at = whole_windows(bounds, width)
    hashes = window_hashes(words, width)[at] if len(at) else np.zeros(0, dtype=_U)
    rows = np.searchsorted(bounds, at, side="right") - 1
    lengths = np.diff(bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    extra = np.zeros(len(short), dtype=_U)
    for size in np.unique(lengths[short]):
        chosen = lengths[short] == size
        extra[chosen] = window_hashes(words, int(size))[bounds[short[chosen]]]
    if len(short):
        hashes, rows = np.concatenate([hashes, extra]), np.concatenate([rows, short])
    return hashes, rows if n_rows else rows


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def strings(arrays: list[bytes]) -> pa.Array:
    return pa.array(arrays, type=pa.binary())


def binary_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows ``values[bounds[i]:bounds[i + 1]]`` as one binary column, without copying row by row."""
    width = values.dtype.itemsize
    offsets = pa.py_buffer((bounds * width).astype(np.int64).tobytes())
    column = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values).tobytes())])
    return column.cast(pa.binary())


def list_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows ``values[bounds[i]:bounds[i + 1]]`` as one list column."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
