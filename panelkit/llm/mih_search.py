"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a 1 for each positive entry. Codes are cut into segments of
about log2(n) bits, each with an index from segment value to codes. A code
within Hamming distance ``m * r + j`` of a query differs by at most ``r`` bits
in one of the segments 0..j, or by less than ``r`` in a later one; so after
all probes of radius ``r`` in segments 0..j everything up to that distance has
been seen. Radii grow, segment by segment, until the k-th verified distance is
covered, which proves the result.

Rows with equal codes are one entry of the index, with their least k + o ids, so
a code that a third of all rows share is searched once; o is the largest number
of codes that one id has, as so many entries may be the query's own. Index
entries and distinct query codes are dealt into blocks; a task searches one block
of queries in one block of entries and returns at most k + o entries per query.

Defined results: a null vector has no code, is not found and finds nothing. A
null or not-a-number entry counts as 0, shorter vectors are filled with zeros.
Ties in distance go to the smaller id. Rows that agree in id and code are one. An
id with several codes is a neighbour, and a query, with each of them, and never a
neighbour of itself. Rows without id are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import column_of, stage
from .token_chunks import ragged

K = 10
INDEX_BLOCK, QUERY_BLOCK = 1 << 14, 1 << 10
#: Probes of one step that are held at once.
PROBES = 1 << 20


def code_udf(width: int):
    """UDF vector -> bits, eight to a byte, padded with zeros to ``width`` bytes."""
    @F.arrow_udf(T.BinaryType())
    def code(vectors: pa.Array) -> pa.Array:
        size = np.array([0 if v is None else len(v) for v in vectors.to_pylist()]) if vectors.null_count else np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        bits = np.zeros((len(vectors), width * 8), bool)
        bits[np.arange(width * 8) < size[:, None]] = flat > 0
        raw = np.packbits(bits, axis=1)
        return pa.array([r.tobytes() for r in raw], pa.binary(), mask=np.asarray(vectors.is_null()))

    return code


def _words(codes: pa.Array) -> np.ndarray:
    """Codes as bytes, a row each."""
    joined = b"".join(codes.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(codes), -1)


def _segments(codes: np.ndarray, m: int) -> tuple[list[np.ndarray], np.ndarray]:
    bits = np.unpackbits(codes, axis=1)
    cuts = np.linspace(0, bits.shape[1], m + 1).round().astype(int)
    return [bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a)[::-1]) for a, b in zip(cuts, cuts[1:])], np.diff(cuts)


def search_block(index: np.ndarray, weight: np.ndarray, least: np.ndarray, queries: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, entry, distance): for each query the ``need`` first entries by distance, then
    ``least``, if fewer do not already weigh ``need``. ``index`` and ``queries`` are codes as bytes."""
    bits = index.shape[1] * 8
    m = max(1, round(bits / max(4.0, np.log2(max(len(index), 2)))))
    entry_segments, sizes = _segments(index, m)
    query_segments, _ = _segments(queries, m)
    buckets = []
    for j in range(m):
        order = np.argsort(entry_segments[j], kind="stable")
        buckets.append((order, np.searchsorted(entry_segments[j][order], np.arange((1 << sizes[j]) + 1))))
    seen = np.zeros((len(queries), bits + 1), np.int64)  # weight found at each distance
    active = np.arange(len(queries))
    found: list[tuple] = []
    for r in range(int(sizes.max()) + 1):
        for j in range(m):
            if not len(active):
                break
            if r <= sizes[j]:
                masks = np.array([sum(1 << b for b in c) for c in combinations(range(sizes[j]), r)], np.int64)
                order, starts = buckets[j]
                step = max(1, PROBES // len(masks))
                for low in range(0, len(active), step):
                    q = active[low:low + step]
                    value = (query_segments[j][q][:, None] ^ masks).reshape(-1)
                    hits = starts[value + 1] - starts[value]
                    entry = order[ragged(starts[value], hits)]
                    query = np.repeat(np.repeat(q, len(masks)), hits)
                    # an entry counts where it is met first: no other segment is nearer, none before this one as near
                    first = np.ones(len(entry), bool)
                    for other in range(m):
                        if other != j:
                            apart = np.bitwise_count(entry_segments[other][entry] ^ query_segments[other][query])
                            first &= (apart >= r) if other > j else (apart > r)
                    entry, query = entry[first], query[first]
                    distance = np.bitwise_count(index[entry] ^ queries[query]).sum(1, dtype=np.int64)
                    np.add.at(seen, (query, distance), weight[entry])
                    found.append((query, entry, distance))
            covered = min(m * r + j, bits)
            active = active[seen[active, :covered + 1].sum(1) < need]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    query, entry, distance = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((least[entry], distance, query))
    query, entry, distance = query[order], entry[order], distance[order]
    nth = np.arange(len(query)) - np.searchsorted(query, query)
    return query[nth < need], entry[nth < need], distance[nth < need]


def top_k(vectors: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          index_block: int = INDEX_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, neighbor_id, distance) for the rows of ``vectors`` where ``queries`` holds."""
    vector = column_of(vectors, vector_col)
    longest = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    rows = vectors.select(column_of(vectors, id_col).alias("id"), queries.alias("asks"), code_udf(max(1, (longest + 7) // 8))(vector).alias("code"))
    rows = rows.where("code IS NOT NULL AND id IS NOT NULL").groupBy("code", "id").agg(F.max("asks").alias("asks"))
    rows = stage(rows, "codes")
    most = k + (rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1)

    # equal codes are one entry, with its least ids (cut before the shuffle, too)
    order = Window.partitionBy("code").orderBy("id")
    members = rows.select("code", "id").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    members = stage(members, "members")
    entries = members.groupBy("code").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("least"))
    asked = rows.where("asks").select("code", F.col("id").alias("query_id"))
    codes = stage(asked.select("code").distinct(), "queries")
    total, many = members.where("nth = 1").count(), codes.count()
    across, down = -(-total // index_block) or 1, -(-many // query_block) or 1

    spread = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = entries.withColumn("i", spread(across)).withColumn("q", every(down))
    right = codes.withColumn("q", spread(down)).withColumn("i", every(across))

    def search(index: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(index) or not len(asked):
            return pa.table({"query": pa.array([], pa.binary()), "code": pa.array([], pa.binary()), "distance": pa.array([], pa.int64())})
        codes, asks = index.column("code").combine_chunks(), asked.column("code").combine_chunks()
        least = index.column("least").to_pandas().rank(method="first").to_numpy()
        query, entry, distance = search_block(_words(codes), index.column("weight").to_numpy(), least, _words(asks), most)
        return pa.table({"query": asks.take(pa.array(query)), "code": codes.take(pa.array(entry)), "distance": pa.array(distance)})

    near = left.groupBy("i", "q").cogroup(right.groupBy("i", "q")).applyInArrow(search, "query binary, code binary, distance long")
    by_query = Window.partitionBy("query").orderBy("distance", "id")
    best = near.join(members.select("code", "id"), "code").withColumn("nth", F.row_number().over(by_query)).where(F.col("nth") <= most)
    best = best.select(F.col("query").alias("code"), "distance", "id")
    by_row = Window.partitionBy("query_id", "code").orderBy("distance", "id")
    out = asked.join(best, "code").where("id <> query_id").withColumn("rank", F.row_number().over(by_row)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("neighbor_id"), "distance")
