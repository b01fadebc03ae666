"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a
few differing bits through an inverted index over byte positions.

Fingerprints within ``max_bits`` differing bits share at least
``8 - max_bits`` of their 8 positional bytes. With the positions in two halves
of four, any five shared positions put three in one half; every fingerprint is
therefore indexed under its eight three-byte combinations within the halves,
and each linked pair meets in at least one. Within an index bucket the shared
positional bytes of each pair are tallied, pairs that reach the guaranteed
minimum are kept and their bits compared. Buckets longer than ``BLOCK`` are cut
into blocks and each pair of blocks is one unit of work, so no task holds a
whole hot bucket and no pair list is ever written: a unit emits the links of a
spanning forest of its verified pairs, which loses no connection.

Documents with equal fingerprints are one node; components are found over the
distinct fingerprints and carried back to the documents.

Defined results: null, empty and wordless texts have fingerprint zero and are
linked like any other. Fewer words than a shingle: the whole word sequence is
the one shingle. Repeated rows share a component; a null id is only the
smallest of its component if all ids are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, column_of, packed, stage
from .components import connected_components
from .textarrays import buffers

SHINGLE = 3
MAX_BITS = 3
#: Most fingerprints of one bucket in one block.
BLOCK = 2048
#: Hash of a shingle: XXH64 with this seed.
SEED = 42
_U = np.uint64


def fingerprint_udf(shingle: int = SHINGLE):
    @F.arrow_udf("bigint")
    def fingerprint(text: pa.Array) -> pa.Array:
        data, at = buffers(text)
        raw = data.tobytes()
        return pa.array(np.fromiter((_fingerprint(raw[a:b], shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist())), np.uint64, len(at) - 1).view(np.int64))

    return fingerprint


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - shingle + 1, 1)
    first, final = starts[:last].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, final)), np.uint64, last)
    ones = np.zeros(64, np.int64)
    for low in range(0, last, 1 << 16):
        ones += np.unpackbits(hashes[low:low + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def positional_byte(fingerprint: Column, position: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * position).bitwiseAND(F.lit(0xFF))


def index_keys(fingerprint: Column, max_bits: int) -> Column:
    """Array of bucket keys: for every combination of positions its number and the bytes there."""
    keys = []
    for i, places in enumerate(index_combinations(max_bits)):
        key = F.lit(i).cast("long")
        for p in places:
            key = F.shiftleft(key, 8).bitwiseOR(positional_byte(fingerprint, p))
        keys.append(key)
    return F.array(*keys)


def index_combinations(max_bits: int) -> list[tuple[int, ...]]:
    """Position sets of which any ``8 - max_bits`` shared positions contain one."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7: beyond, no positional byte need be shared")
    need = 8 - max_bits
    in_half = (need + 1) // 2
    return [c for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in combinations(half, in_half)]


def links_within(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): a spanning set of the links between the distinct values of column ``fp``."""
    spark = fingerprints.sparkSession
    indexed = fingerprints.select("fp", F.explode(index_keys(F.col("fp"), max_bits)).alias("key"))
    sizes = indexed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = indexed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = met.withColumn("block", block)
    # block i works with every block j: unit (i, j) is one pair of blocks
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.struct(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = met.select("fp", F.xxhash64("key", unit).alias("unit"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(parts, "unit").sortWithinPartitions("unit", "fp")
    return met.mapInArrow(lambda it: _forest_of_units(it, max_bits), "a long, b long").distinct()


def _forest_of_units(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; the last unit of a batch waits for the next batch."""
    unit, fp = np.zeros(0, np.int64), np.zeros(0, _U)
    for batch in batches:
        unit = np.concatenate([unit, batch.column(1).to_numpy()])
        fp = np.concatenate([fp, batch.column(0).to_numpy().view(_U)])
        cut = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
        yield from _emit(unit[:cut], fp[:cut], max_bits)
        unit, fp = unit[cut:], fp[cut:]
    yield from _emit(unit, fp, max_bits)


def _emit(unit: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    if len(unit) < 2:
        return
    at = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    sizes = np.diff(np.append(at, len(unit)))
    found = []
    small = sizes <= 64
    rows = np.repeat(small, sizes)
    u, f = unit[rows], fp[rows]
    for gap in range(1, int(sizes[small].max(initial=1))):
        together = np.flatnonzero(u[gap:] == u[:-gap])
        if not len(together):
            break
        a, b = f[together], f[together + gap]
        ok = _linked(a, b, max_bits)
        found.append(np.stack([a[ok], b[ok]], 1))
    for start, size in zip(at[~small], sizes[~small]):
        found.append(_forest(np.unique(fp[start:start + size]), max_bits))
    links = np.concatenate(found) if found else np.zeros((0, 2), _U)
    links = links[links[:, 0] != links[:, 1]]
    if len(links):
        links = np.unique(links, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(links[:, k]).view(np.int64)) for k in (0, 1)], ["a", "b"])


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter on shared positional bytes, then the differing bits."""
    differing = a ^ b
    shared = (np.ascontiguousarray(differing).view(np.uint8).reshape(-1, 8) == 0).sum(1)
    out = shared >= 8 - max_bits
    out[out] = np.bitwise_count(differing[out]) <= max_bits
    return out


def _forest(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Spanning forest of the verified links among distinct fingerprints: grown
    from one seed after another, each fingerprint is compared once with those not yet reached."""
    left, links = fp, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            ok = _linked(np.full(len(left), node), left, max_bits)
            if ok.any():
                reached = left[ok]
                links.append(np.stack([np.full(len(reached), node), reached], 1))
                queue.extend(reached)
                left = left[~ok]
    return np.concatenate(links) if links else np.zeros((0, 2), _U)


def components(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Adds ``component_id`` and ``root`` to rows with (doc_id, fp). ``rows`` must be a written table: it is read
    twice. ``root``, the least fingerprint of a component, names it also where ids are null or repeat."""
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    roots = connected_components(links_within(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    best = rooted.where("linked").groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(best, "root", "left").select("fp", "root", F.coalesce("component_id", "least").alias("component_id"), "linked", "n")
    # a document alone under its fingerprint, and unlinked, is its own component
    named = named.where("linked OR n > 1").select("fp", "root", "component_id")
    out = rows.join(named, "fp", "left")
    return out.withColumns({"component_id": F.coalesce("component_id", "doc_id"), "root": F.coalesce("root", "fp")})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    fp = fingerprint_udf(shingle)(column_of(docs, text_col).cast("string"))
    rows = stage(docs.select(column_of(docs, id_col).alias("doc_id"), fp.alias("fp")), "simhash")
    return components(rows, max_bits).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, unchanged, of which one per component stays: that
    with the smallest id (null ids last, of equal ids the first by text hash, of
    equal rows one). Rows that share an id, or have none, are in one component only if their texts are."""
    text = column_of(docs, text_col).cast("string")
    same = dict(doc_id=column_of(docs, id_col), tie=F.xxhash64(text))
    rows = stage(docs.select(*(c.alias(k) for k, c in same.items()), fingerprint_udf(shingle)(text).alias("fp")), "simhash")
    found = components(rows, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "tie")
    first = found.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("d"), F.col("k.tie").alias("t"))
    again = rows.groupBy(F.col("doc_id").alias("d"), F.col("tie").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    first = first.join(again, first["d"].eqNullSafe(again["d"]) & (first["t"] == again["t"])).select(first["d"], first["t"], "n")
    kept = packed(docs, **same).join(first, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")))
    # only rows that agree in id and text are brought together again
    repeated = kept.where("n > 1").dropDuplicates(["doc_id", "tie"])
    return kept.where("n = 1").unionAll(repeated).select(f"{ROW}.*")
