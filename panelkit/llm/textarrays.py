"""Texts as flat byte arrays: word bounds and 64-bit hashes without per-word
Python objects. Used inside tasks, on Arrow columns, one bounded chunk of
bytes at a time (a single longer document forms a chunk of its own)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: (just below a power of two, to which the tables of powers are rounded)
CHUNK_BYTES = (1 << 20) - (1 << 12)
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INV = _U(pow(int(_BASE), -1, 1 << 64))

#: Space and control characters of ``[\x20\x09-\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that begin a UTF-8 code point.
LEAD = (np.arange(256) & 0xC0) != 0x80

_powers = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, _INV)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``values[start:end]``; equal runs hash alike wherever they stand."""
    power, inverse = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum((values.astype(_U) + _U(1)) * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts."""
    data, at = buffers(column)
    low, n = 0, len(at) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield low, high, data[at[low]:at[high]], at[low:high + 1] - at[low]
        low = high


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] |= inside[edges]
    end[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def count_where(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set within each document."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]
