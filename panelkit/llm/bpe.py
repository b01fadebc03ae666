"""Byte-level BPE: encoding by merge ranks and decoding.

Each match of the pre-token pattern is a row of byte ids. Rows are put into
padded matrices by length; in every round all rows of a matrix look up the rank
of each neighbouring pair in a hash table, every row merges its leftmost pair
of least rank, and the matrix is compacted; rows without a mergeable pair
leave. A pair's rank is that of the token its bytes form, as in the ranks file.
A very long row (a text without spaces) is a matrix of its own with the least rank
of every block of columns beside it, and links over the merged columns in place of
compaction: a merge then touches a block or two, not the whole row.

Only pieces that a worker has not met lately are encoded (see token_chunks).

Defined results: a null text counts as empty and has no ids. Repeated rows are
encoded alike. An empty table gives an empty result. Bytes that do not form
text decode to the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, column_of, packed
from .token_chunks import PieceTable, encoded, joins_safely, ragged

_U = np.uint64
_NONE = np.int64(1) << 40
_SPREAD = _U(0x9E3779B97F4A7C15)
#: Rows of one matrix, and pieces a worker remembers.
ROWS, PIECES = 1 << 14, 500_000
#: Bytes from which a row is merged alone, and columns whose least rank is held together.
LONG, BLOCK = 1 << 10, 1 << 10


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Tables made from merge ranks: byte -> id, (left id, right id) -> merged id, id -> bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.byte_id < 0).any():
            raise ValueError("the ranks must hold every single byte")
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        pairs = [(ranks[t[:k]] << 32 | ranks[t[k:]], r) for t, r in ranks.items()
                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self._fill(np.array([p for p, _ in pairs], _U), np.array([r for _, r in pairs], np.int64))

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open-addressed hash table with linear probing, at most half full."""
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = _U(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(_U).max, _U)
        self.values = np.full(1 << bits, _NONE, np.int64)
        self.probes = 0
        slot = ((keys * _SPREAD) >> self.shift).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):  # one key per free slot in each round
            self.probes += 1
            free = self.keys[slot[left]] == np.iinfo(_U).max
            _, winner = np.unique(slot[left[free]], return_index=True)
            taken = left[free][winner]
            self.keys[slot[taken]], self.values[slot[taken]] = keys[taken], ranks[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)
            slot[left] = (slot[left] + 1) & self.mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a value above all ranks."""
        key = (left.astype(_U) << _U(32)) | right.astype(_U)
        slot = ((key * _SPREAD) >> self.shift).astype(np.int64)
        out = np.full(key.shape, _NONE, np.int64)
        at = np.arange(len(key))
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == key
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (there != np.iinfo(_U).max)
            at, key, slot = at[on], key[on], (slot[on] + 1) & self.mask
            if not len(at):
                break
        return out

    def merge(self, rows: list[bytes]) -> list[bytes]:
        """Ids of each row of bytes, as little-endian 32-bit integers."""
        out = [b""] * len(rows)
        length = np.fromiter(map(len, rows), np.int64, len(rows))
        order = np.argsort(length, kind="stable")
        order = order[length[order] > 0]
        by_length = length[order]
        low = 0
        while low < len(order):
            width = int(by_length[low])
            if width >= LONG:
                out[order[low]] = self._merge_long(rows[order[low]])
                low += 1
                continue
            # a bucket: lengths up to a quarter above its least
            high = min(int(np.searchsorted(by_length, min(width + width // 4, LONG - 1), "right")), low + max(1, ROWS * 16 // width))
            self._merge_matrix([rows[i] for i in order[low:high].tolist()], order[low:high], out)
            low = high
        return out

    def _merge_long(self, row: bytes) -> bytes:
        """Ids of one long row: the leftmost pair of least rank is merged until none is left."""
        n, ranks, tokens = len(row), self.ranks, self.tokens
        first = self.byte_id[np.frombuffer(row, np.uint8)]
        rank = np.full(-(-n // BLOCK) * BLOCK, _NONE, np.int64)  # of the pair that begins in a column
        rank[:n - 1] = self.pair_ranks(first[:-1], first[1:])
        blocks = rank.reshape(-1, BLOCK)
        least = blocks.min(1)
        ids, after, before = first.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        none = int(_NONE)
        while True:
            block = int(least.argmin())
            best = int(least[block])
            if best == none:
                break
            at = block * BLOCK + int(blocks[block].argmin())
            gone = after[at]
            follow = after[gone]
            ids[at], ids[gone], after[at] = best, -1, follow
            rank[gone] = _NONE
            changed = {block, gone // BLOCK}
            if follow < n:
                before[follow] = at
                rank[at] = ranks.get(tokens[best] + tokens[ids[follow]], none)
            else:
                rank[at] = _NONE
            ahead = before[at]
            if ahead >= 0:
                rank[ahead] = ranks.get(tokens[ids[ahead]] + tokens[best], none)
                changed.add(ahead // BLOCK)
            for k in changed:
                least[k] = blocks[k].min()
        merged = np.array(ids, np.int64)
        return merged[merged >= 0].astype("<i4").tobytes()

    def _merge_matrix(self, rows: list[bytes], places: np.ndarray, out: list[bytes]) -> None:
        length = np.fromiter(map(len, rows), np.int64, len(rows))
        width = int(length.max())
        ids = np.zeros((len(rows), width), np.int64)
        column = np.arange(width)
        filled = column < length[:, None]
        ids[filled] = self.byte_id[np.frombuffer(b"".join(rows), np.uint8)]
        rank = np.full((len(rows), max(width - 1, 1)), _NONE, np.int64)
        pair = filled[:, 1:]
        if width > 1:
            rank[:, :width - 1][pair] = self.pair_ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        while len(ids):
            spot = rank.argmin(1)  # the leftmost least
            every = np.arange(len(ids))
            best = rank[every, spot]
            done = best == _NONE
            if done.any():
                ended = ids[done]
                flat = ended[np.arange(ended.shape[1]) < length[done, None]].astype("<i4").tobytes()
                ends = (4 * np.cumsum(length[done])).tolist()
                for place, a, b in zip(places[done].tolist(), [0, *ends], ends):
                    out[place] = flat[a:b]
                on = ~done
                ids, rank, length, places, spot, best = ids[on], rank[on], length[on], places[on], spot[on], best[on]
                if not len(ids):
                    return
                width = int(length.max())
                ids, rank = ids[:, :width], rank[:, :max(width - 1, 1)]
                every = np.arange(len(ids))
            # put the merged id in place, close the gap behind it
            ids[every, spot] = best
            columns = np.arange(ids.shape[1] - 1)
            gap = columns > spot[:, None]
            ids[:, :-1][gap] = ids[:, 1:][gap]
            length = length - 1
            columns = np.arange(rank.shape[1] - 1)
            gap = columns >= spot[:, None]
            rank[:, :-1][gap] = rank[:, 1:][gap]
            rank[:, -1] = _NONE
            for before in (True, False):  # the merged id's two neighbours
                at = spot - 1 if before else spot
                rows_at = np.flatnonzero((at >= 0) & (at + 1 < length))
                a = at[rows_at]
                rank[rows_at, a] = self.pair_ranks(ids[rows_at, a], ids[rows_at, a + 1])
                ended = np.flatnonzero((at >= 0) & (at + 1 >= length) & (at < rank.shape[1]))
                rank[ended, at[ended]] = _NONE

    def encode_pieces(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        safe = np.fromiter(map(joins_safely, values), bool, len(values))
        order = np.concatenate([np.flatnonzero(safe), np.flatnonzero(~safe)])
        values = [values[i] for i in order.tolist()]
        alone = int(safe.sum())
        findall = self.pattern.findall
        matches = findall("".join(values[:alone]))
        for v in values[alone:]:
            matches += findall(v)
        unique = {m: k for k, m in enumerate(dict.fromkeys(matches))}
        ids, size = self._whole_or_merged([m.encode() for m in unique])
        match = np.fromiter(map(unique.__getitem__, matches), np.int64, len(matches))
        # pieces end where matches end: characters tell which matches are whose
        length = size[match]
        chars = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        own = np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))
        last = np.searchsorted(chars, own, "right")
        first = np.append(0, last[:-1])
        before = np.append(0, np.cumsum(length))
        # back to the given order: matches of piece after piece
        back = np.argsort(order)
        first, last = first[back], last[back]
        match = match[ragged(first, last - first)]
        start = np.cumsum(size) - size
        return ids[ragged(start[match], size[match])], before[last] - before[first]

    def _whole_or_merged(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A match that is a token is that token; the others are merged."""
        ranks = self.ranks
        rank = np.fromiter((ranks.get(m, -1) for m in matches), np.int64, len(matches))
        rest = np.flatnonzero(rank < 0)
        merged = self.merge([matches[i] for i in rest.tolist()])
        out = rank.astype("<i4").tobytes()
        parts = [out[4 * i:4 * i + 4] for i in range(len(matches))]
        for i, ids in zip(rest.tolist(), merged):
            parts[i] = ids
        return np.frombuffer(b"".join(parts), "<i4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4

    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()])


_caches: dict[tuple[str, str], tuple[Encoder, PieceTable]] = {}


def worker_encoder(path: str, pattern: str) -> tuple[Encoder, PieceTable]:
    """This worker's encoder; the vocabulary file lies at the same path on every node."""
    if (path, pattern) not in _caches:
        encoder = Encoder(read_ranks(path), pattern)
        _caches[path, pattern] = encoder, PieceTable(encoder.encode_pieces, PIECES)
    return _caches[path, pattern]


CHECKED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def encode_udf(path: str, pattern: str):
    """UDF text -> array of ids."""
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(text: pa.Array) -> pa.Array:
        _, table = worker_encoder(path, pattern)
        parts = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)) for ids, at in encoded(text, table)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode


def decode_udf(path: str, pattern: str):
    """UDF array of ids -> bytes."""
    @F.arrow_udf(T.BinaryType())
    def decode(ids: pa.Array) -> pa.Array:
        encoder, _ = worker_encoder(path, pattern)
        return pa.array([encoder.decode(x.values.to_numpy()) if x.is_valid else b"" for x in ids], pa.binary())

    return decode


def checksum_udf(path: str, pattern: str):
    """UDF text -> number of ids, sha256 of the ids, sha256 of the bytes decoded from them."""
    @F.arrow_udf(CHECKED)
    def check(text: pa.Array) -> pa.Array:
        encoder, table = worker_encoder(path, pattern)
        n, left, right = [], [], []
        for ids, at in encoded(text, table):
            raw = ids.astype("<u4").tobytes()
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                n.append(b - a)
                left.append(hashlib.sha256(raw[4 * a:4 * b]).hexdigest())
                right.append(hashlib.sha256(encoder.decode(ids[a:b])).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(left, pa.string()), pa.array(right, pa.string())],
                                          names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return check


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` packed as ``row``, with ``ids``."""
    return packed(docs, ids=encode_udf(path, pattern)(column_of(docs, text_col).cast("string")))


def decode(encoded_docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decoded`` bytes beside the columns of ``encode``."""
    return encoded_docs.withColumn("decoded", decode_udf(path, pattern)("ids"))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    checked = checksum_udf(path, pattern)(column_of(docs, text_col).cast("string"))
    return docs.select(column_of(docs, id_col).alias("doc_id"), checked.alias("c")).select("doc_id", "c.*")
