"""Cutting texts where byte-level tokenizers cut them too, so that a piece met
again is not encoded again.

A space between two characters that are no white space always begins a new
pre-token of the pattern, whatever stands around it: the pieces between such
spaces can be encoded one by one, and their ids joined are the ids of the text.
Pieces are found, hashed and looked up as arrays; only those a worker has not
met lately become Python strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .textarrays import buffers, span_hash

#: Bytes of text that are cut and looked up together (a longer text alone).
CHUNK_BYTES = (1 << 20) - (1 << 12)
_U = np.uint64
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: UTF-8 bytes of the white space beyond ASCII, by lead byte.
_WIDE_SPACE = {
    0xC2: [b"\x85", b"\xa0"],
    0xE1: [b"\x9a\x80"],
    0xE2: [b"\x80" + bytes([x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)] + [b"\x81\x9f"],
    0xE3: [b"\x80\x80"],
}


def white_space(data: np.ndarray) -> np.ndarray:
    """Bytes that are, or belong to, white space."""
    out = _ASCII_SPACE[data]
    for lead, tails in _WIDE_SPACE.items():
        at = np.flatnonzero(data[:-1] == lead)
        if not len(at):
            continue
        for tail in tails:
            hit = at[at + len(tail) < len(data)]
            for k, byte in enumerate(tail, 1):
                hit = hit[data[hit + k] == byte]
            for k in range(len(tail) + 1):
                out[hit + k] = True
    return out


def piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Start of every piece; the pieces tile the texts."""
    begins = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        space = white_space(data)
        begins[1:-2] = (data[1:-1] == 0x20) & ~space[:-2] & ~space[2:]
    begins[at[:-1]] = True
    begins[len(data)] = False
    return np.flatnonzero(begins)


def joins_safely(piece: str) -> bool:
    """Whether the piece, put after another such piece, still begins a pre-token."""
    return len(piece) > 1 and piece[0] == " " and not piece[1].isspace() and not piece[-1].isspace()


class PieceTable:
    """Ids of pieces this worker has met, by the pieces' 64-bit hash and length:
    an open-addressed table of places in one pool of ids. Beyond ``most`` pieces
    it starts anew. ``encode`` gives the ids of new pieces and how many each has."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 800_000):
        self.encode, self.most = encode, most
        self.bits = int(2 * most - 1).bit_length()
        self.key = np.zeros(1 << self.bits, _U)
        self.place = np.full(1 << self.bits, -1, np.int32)
        self.clear()

    def clear(self) -> None:
        self.place[:] = -1
        self.used = 0
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.int32)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Number of the piece with each key, or -1."""
        out = np.full(len(key), -1, np.int64)
        slot = (key >> _U(64 - self.bits)).astype(np.int64)
        at = np.arange(len(key))
        while len(at):
            place = self.place[slot]
            full = place >= 0
            hit = full & (self.key[slot] == key)
            out[at[hit]] = place[hit]
            on = full & ~hit
            at, key, slot = at[on], key[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def _insert(self, key: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        number = np.arange(self.used, self.used + len(key), dtype=np.int32)
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size.astype(np.int32)])
        self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        self.used += len(key)
        slot = (key >> _U(64 - self.bits)).astype(np.int64)
        left = np.arange(len(key))
        while len(left):  # each round, one key takes each free slot
            free = self.place[slot[left]] < 0
            _, first = np.unique(slot[left[free]], return_index=True)
            taken = left[free][first]
            self.key[slot[taken]], self.place[slot[taken]] = key[taken], number[taken]
            rest = np.ones(len(key), bool)
            rest[taken] = False
            left = left[rest[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def ids(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the n+1 offsets of the texts in them."""
        begin = piece_starts(data, at)
        end = np.append(begin[1:], len(data))
        key = span_hash(data, begin, end)
        piece = self._find(key)
        missing = np.flatnonzero(piece < 0)
        if len(missing):
            _, first = np.unique(key[missing], return_index=True)
            new = missing[first]
            if self.used + len(new) > self.most:
                self.clear()
                piece = np.full(len(key), -1, np.int64)
                missing = np.arange(len(key))
                _, first = np.unique(key, return_index=True)
                new = missing[first]
            raw = data.tobytes()
            values = [raw[a:b].decode() for a, b in zip(begin[new].tolist(), end[new].tolist())]
            ids, size = self.encode(values)
            if len(new) > self.most:  # a single text of more pieces than the table holds
                order = np.searchsorted(key[new], key)
                return _gather(ids, (np.cumsum(size) - size)[order], size[order].astype(np.int64), begin, at)
            self._insert(key[new], ids, size)
            piece[missing] = self._find(key[missing])
        return _gather(self.pool, self.start[piece], self.size[piece].astype(np.int64), begin, at)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of every pair, one after the other."""
    end = np.cumsum(size)
    return np.repeat(start - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)


def _gather(pool, start, size, begin, at) -> tuple[np.ndarray, np.ndarray]:
    return pool[ragged(start, size)], np.append(0, np.cumsum(size))[np.searchsorted(begin, at)]


def encoded(texts: pa.Array, table: PieceTable, most: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, n+1 offsets) of runs of consecutive texts; null counts as empty."""
    data, at = buffers(texts)
    low, n = 0, len(at) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield table.ids(data[at[low]:at[high]], at[low:high + 1] - at[low])
        low = high
