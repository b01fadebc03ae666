"""Ranked lexical search: exact inner products over sparse ball trees.

A document is the sparse vector of what each of its terms adds to a score (an
integer: term weight times saturated frequency), a query the indicator of its
terms, so a score is their inner product. The vectors hold the terms that some
query of the block has, as no other term can add to a score.

The vectors are laid out by their rarest terms and dealt in ranges, so that alike
documents meet; every task cuts its rows into blocks of bounded size and builds a
ball tree over each: a node's documents go to the nearer of two far members (half
to each, where nearly all would go to one), and it has their centroid, a radius
that covers them, and a radius upwards along each column. For a query q of k terms
no document below a node scores more than q.centroid plus the lesser of
sqrt(k) * radius (Cauchy-Schwarz) and the sum of the radii along q's columns;
radius and bound are rounded up by more than floating point can lose. Nodes are opened best-first, and a subtree whose bound is below the tenth
score so far is left out. At the leaves, scores are sums of 64-bit integers. A
task's tenth scores carry over from block to block; of its documents only the ten
best per query leave the task. All documents are held against all queries; a very
large query set is searched in blocks of some ``PAIRS`` (query, term) pairs.

Terms are matched by 64-bit hash and then by length and bytes. Statistics (N, L,
df) are counted over all documents.

Defined results: a null text has no terms, and a query or document without terms is
in no result. Rows with one item_id are one item with the terms of all of them
(null: an item of its own). Every row of the documents is a document, also if ids
repeat: equal scores stand by id, null first, and equal ids as often as they occur.
Empty tables give an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import column_of, ready, stage
from .textarrays import chunks, span_hash, word_bounds

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOP = 10
#: (query, term) pairs that are searched at once; they are collected, as the queries of a block go to every task.
PAIRS = 1 << 20
#: Most documents and entries of one tree, and documents of a leaf.
TREE_ROWS, TREE_ENTRIES, LEAF = 1 << 14, 1 << 21, 32
#: Relative room for rounding in squared distances and in bounds (sums of at most 2**21 doubles lose less).
ROOM = 1e-9
#: A split gives each side one part in so many, or else a half.
EVEN = 32

#: Bytes of terms with A-Z lower-cased; all others become spaces. Every byte above 0x7F belongs to a term.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


class Terms:
    """The different terms of a block of queries, found in texts by hash and bytes."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        data = np.frombuffer(b"".join(raw), np.uint8)
        self.size = np.array([len(t) for t in raw], np.int64)
        self.at = np.cumsum(self.size) - self.size
        hashes = span_hash(data, self.at, self.at + self.size)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.data = hashes[self.order], data
        same = np.diff(np.flatnonzero(np.append(True, np.append(self.hashes[1:] != self.hashes[:-1], True))))
        self.most = int(same.max(initial=1))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in starts, term) of every word that is one of the terms."""
        hashes = span_hash(data, starts, ends)
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.hashes, hashes[maybe])
        words, found = [], []
        for step in range(self.most):  # terms of one hash, if any, are all tried
            slot = low + step
            hit = slot < len(self.hashes)
            hit[hit] = self.hashes[slot[hit]] == hashes[maybe[hit]]
            word, term = maybe[hit], self.order[slot[hit]]
            equal = (ends[word] - starts[word]) == self.size[term]
            word, term = word[equal], term[equal]
            for size in np.unique(self.size[term]):
                k = np.flatnonzero(self.size[term] == size)
                span = np.arange(size)
                for part in np.array_split(k, max(1, len(k) * size >> 20)):
                    same = (data[starts[word[part]][:, None] + span] == self.data[self.at[term[part]][:, None] + span]).all(1)
                    words.append(word[part[same]])
                    found.append(term[part[same]])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *words]), np.concatenate([none, *found])


def _counted(terms_of: Callable[[], Terms]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = terms_of()
        width = len(terms.size)
        for batch in batches:
            for low, high, data, at in chunks(batch.column("text")):
                data = _FOLD[data]
                starts, ends, doc = word_bounds(data, at)
                word, term = terms.find(data, starts, ends)
                cell, tf = np.unique(doc[word] * width + term, return_counts=True)
                ptr = np.searchsorted(cell, np.arange(high - low + 1) * width)
                ptr = pa.array(ptr, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(low, high - low), pa.array(np.bincount(doc, minlength=high - low), pa.int64()),
                    pa.ListArray.from_arrays(ptr, pa.array(cell % max(width, 1), pa.int32())), pa.ListArray.from_arrays(ptr, pa.array(tf, pa.int64()))],
                    ["id", "n", "terms", "tf"])
    return run


def _weighed(weights: Callable[[], np.ndarray]) -> Callable:
    """Vectors (id, terms, adds) and their rarest two terms, of documents that add anything."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights()
        for batch in batches:
            terms, tf, ptr = _lists(batch, "terms", "tf")
            size = np.diff(ptr)
            adds = w[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(batch.column("m").to_numpy(zero_copy_only=False), size)))
            rows = np.flatnonzero(size)
            row = np.repeat(np.arange(len(size)), size)
            by_weight = np.lexsort((terms, -w[terms], row))
            first = ptr[rows]
            lead = terms[by_weight[first]]
            second = terms[by_weight[np.minimum(first + 1, ptr[rows + 1] - 1)]]
            p = pa.array(np.append(0, np.cumsum(size[rows])), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows)), pa.ListArray.from_arrays(p, pa.array(terms, pa.int32())),
                                              pa.ListArray.from_arrays(p, pa.array(adds, pa.int64())), pa.array(lead, pa.int32()), pa.array(second, pa.int32())],
                                             ["id", "terms", "adds", "lead", "second"])
    return run


def _lists(batch: pa.RecordBatch, first: str, second: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = batch.column(first), batch.column(second)
    ptr = a.offsets.to_numpy().astype(np.int64)
    return a.flatten().to_numpy().astype(np.int64), b.flatten().to_numpy().astype(np.int64), ptr - ptr[0]


class BallTree:
    """Ball tree over sparse vectors of non-negative integers, each with an entry or more."""

    def __init__(self, ptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, leaf: int = LEAF):
        self.names, cols = np.unique(cols, return_inverse=True)
        self.width = len(self.names)
        self.ptr, self.cols, self.vals = ptr, cols.astype(np.int64), vals
        self.square = np.add.reduceat(vals.astype(float) ** 2, ptr[:-1])
        self.order = np.arange(len(ptr) - 1)
        self.low, self.high, self.child, self.radius = [], [], [], []
        balls: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        todo = [(0, len(self.order), -1)]
        while todo:
            low, high, parent = todo.pop()
            node = len(self.low)
            if parent >= 0:
                self.child[parent].append(node)
            centre, radius, middle = self._ball(low, high, leaf)
            balls.append(centre)
            for into, x in ((self.low, low), (self.high, high), (self.child, []), (self.radius, radius)):
                into.append(x)
            if middle:
                todo += [(low, middle, node), (middle, high, node)]
        self.radius = np.array(self.radius)
        size = np.diff(ptr)[self.order]
        entries = self._entries(self.order)
        self.cols, self.vals, self.ptr = self.cols[entries], self.vals[entries], np.append(0, np.cumsum(size))
        # centroids by column
        col = np.concatenate([c for c, _, _ in balls])
        by_col = np.argsort(col, kind="stable")
        self.ball_node = np.repeat(np.arange(len(balls)), [len(c) for c, _, _ in balls])[by_col]
        self.ball_val = np.concatenate([v for _, v, _ in balls])[by_col]
        self.ball_far = np.concatenate([f for _, _, f in balls])[by_col]
        self.ball_ptr = np.searchsorted(col[by_col], np.arange(self.width + 1))

    def _entries(self, rows: np.ndarray) -> np.ndarray:
        size = self.ptr[rows + 1] - self.ptr[rows]
        return np.repeat(self.ptr[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def _ball(self, low: int, high: int, leaf: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], float, int]:
        """Centroid (columns, values) with the radius upwards along each column, radius, and
        where the node is split (0: nowhere); orders its rows for that."""
        rows = self.order[low:high]
        entries = self._entries(rows)
        cols, vals = self.cols[entries], self.vals[entries].astype(float)
        size = self.ptr[rows + 1] - self.ptr[rows]
        starts = np.cumsum(size) - size
        square = self.square[rows]

        def squared_distance(x: np.ndarray, x_square: float) -> np.ndarray:
            return square - 2 * np.add.reduceat(vals * x[cols], starts) + x_square

        def dense(k: int) -> np.ndarray:
            x = np.zeros(self.width)
            own = slice(starts[k], starts[k] + size[k])
            x[cols[own]] = vals[own]
            return x

        centre = np.bincount(cols, vals, self.width) / len(rows)
        c_square = float(centre @ centre)
        from_centre = squared_distance(centre, c_square)
        radius = math.sqrt(float((np.maximum(from_centre, 0) + ROOM * (square + c_square)).max()))
        most = np.zeros(self.width)
        np.maximum.at(most, cols, vals)
        held = np.flatnonzero(centre)
        ball = (held, centre[held], most[held] - centre[held])
        if len(rows) <= leaf:
            return ball, radius, 0
        a = int(from_centre.argmax())
        from_a = squared_distance(dense(a), square[a])
        b = int(from_a.argmax())
        from_b = squared_distance(dense(b), square[b])
        self.order[low:high] = rows[np.argsort(from_a - from_b, kind="stable")]
        nearer = int((from_a < from_b).sum())
        if min(nearer, len(rows) - nearer) * EVEN < len(rows):
            nearer = len(rows) // 2
        return ball, radius, low + nearer

    def columns(self, terms: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.names, terms)
        at = at[at < self.width] if len(at) else at
        return at[np.isin(self.names[at], terms)]

    def bounds(self, columns: np.ndarray) -> np.ndarray:
        """No vector below a node has a larger inner product with the indicator of ``columns``."""
        size = self.ball_ptr[columns + 1] - self.ball_ptr[columns]
        at = np.repeat(self.ball_ptr[columns] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        node = self.ball_node[at]
        centre = np.bincount(node, self.ball_val[at], len(self.radius))
        along = np.bincount(node, self.ball_far[at], len(self.radius))
        return (centre + np.minimum(along, math.sqrt(len(columns)) * self.radius)) * (1 + ROOM) + 1

    def search(self, terms: np.ndarray, least: Callable[[], int], offer: Callable[[np.ndarray, np.ndarray], None]) -> int:
        """Offer (rows, scores) of every leaf whose bound is at least ``least()``, best first; the number of leaves opened."""
        columns = self.columns(terms)
        if not len(columns):
            return 0
        bounds = self.bounds(columns)
        mask = np.zeros(self.width, np.int64)
        mask[columns] = 1
        heap, opened = [(-bounds[0], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least():
                break
            if self.child[node]:
                for x in self.child[node]:
                    heapq.heappush(heap, (-bounds[x], x))
                continue
            opened += 1
            low, high = self.low[node], self.high[node]
            own = slice(self.ptr[low], self.ptr[high])
            scores = np.add.reduceat(self.vals[own] * mask[self.cols[own]], self.ptr[low:high] - self.ptr[low])
            offer(self.order[low:high], scores)
        return opened


class Best:
    """The ``TOP`` best (score, id) of a query so far: highest score, then least id (null first)."""

    def __init__(self, top: int):
        self.top, self.rows, self.least = top, [], 1

    def offer(self, scores: np.ndarray, ids: pa.Array, rows: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least)
        if len(good):
            new = [(-int(s), i is not None, 0 if i is None else i) for s, i in zip(scores[good], ids.take(pa.array(rows[good])).to_pylist())]
            self.rows = heapq.nsmallest(self.top, self.rows + new)
            if len(self.rows) == self.top:
                self.least = -self.rows[-1][0]


def _searched(queries: Callable[[], list], top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [(number, np.array(terms, np.int64)) for number, terms in queries()]
        best = [Best(top) for _ in items]

        def held(block: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(block).combine_chunks().to_batches()[0]
            terms, adds, ptr = _lists(table, "terms", "adds")
            tree, ids = BallTree(ptr, terms, adds), table.column("id")
            for (_, own), b in zip(items, best):
                tree.search(own, lambda: b.least, lambda rows, scores: b.offer(scores, ids, rows))

        block: list[pa.RecordBatch] = []
        rows = entries = 0
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("id").type
            ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
            low = 0
            while low < batch.num_rows:
                fit = int(np.searchsorted(ends, ends[low] + TREE_ENTRIES - entries, "right")) - 1
                high = max(low + (not rows), min(fit, low + TREE_ROWS - rows, batch.num_rows))
                if high > low:
                    block.append(batch.slice(low, high - low))
                    rows, entries = rows + high - low, entries + int(ends[high] - ends[low])
                if high < batch.num_rows:
                    held(block)
                    block, rows, entries = [], 0, 0
                low = high
        if block:
            held(block)
        out = [(number, None if not given else i, -score) for (number, _), b in zip(items, best) for score, given, i in b.rows]
        if out:
            numbers, ids, scores = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())], ["number", "doc_id", "score"])
    return run


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(number, item_id, terms) of every item that has a term, written."""
    text = F.translate(F.coalesce(column_of(items, text_col).cast("string"), F.lit("")), _UPPER, _UPPER.lower())
    words = items.select(column_of(items, id_col).alias("item_id"), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))).alias("term"))
    sets = words.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    return stage(sets.select(F.monotonically_increasing_id().alias("number"), "item_id", "terms"), "items")


def ranked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
           top: int = TOP, pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item with a score above 0."""
    spark = docs.sparkSession
    ready(spark)
    queries = query_terms(items, item_id_col, item_text_col)
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // pairs) or 1
    found = None
    for k in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == k)
        one = _ranked_block(docs, block.select("number", "terms").collect(), id_col, text_col, top)
        found = one if found is None else found.union(one)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(queries.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def _ranked_block(docs: DataFrame, block: list, id_col: str, text_col: str, top: int) -> DataFrame:
    """(number, doc_id, score): among others the ``top`` best documents of the queries (number, terms) of one block."""
    spark = docs.sparkSession
    names = sorted({t for r in block for t in r.terms})
    place = {t: i for i, t in enumerate(names)}
    words = spark.sparkContext.broadcast(names)
    texts = docs.select(column_of(docs, id_col).alias("id"), F.coalesce(column_of(docs, text_col).cast("string"), F.lit("")).alias("text"))
    id_field = texts.schema["id"]
    counted = texts.mapInArrow(_counted(lambda: Terms(words.value)), f"id {id_field.dataType.simpleString()}, n long, terms array<int>, tf array<long>")
    counted = stage(counted, "counts")
    n_docs, length = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(names), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
    weights = spark.sparkContext.broadcast(weight)
    m = F.expr(f"10 + (CAST(90 AS DECIMAL(38, 0)) * n * {n_docs}) DIV {max(length, 1)}")
    vectors = counted.where("size(terms) > 0").select("id", "terms", "tf", m.alias("m")).mapInArrow(
        _weighed(lambda: weights.value), f"id {id_field.dataType.simpleString()}, terms array<int>, adds array<long>, lead int, second int")
    # documents with the same rarest terms next to each other; the id splits those that share them
    vectors = vectors.repartitionByRange("lead", "second", F.xxhash64("id")).sortWithinPartitions("lead", "second").select("id", "terms", "adds")
    numbered = spark.sparkContext.broadcast([(r.number, sorted(place[t] for t in r.terms)) for r in block])
    return vectors.mapInArrow(_searched(lambda: numbered.value, top), f"number long, doc_id {id_field.dataType.simpleString()}, score long")
