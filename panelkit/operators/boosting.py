"""Gradient-boosted regression trees for all folds at once (M6, M7).

A library fit is a job per level of every tree of every fold. Folds do not
depend on each other: rows are cut into bins once per fold and kept in blocks
of one fold each, and a task adds up count, sum and sum of squares of the
residuals per (node, feature, bin), from which the best split is taken. If a
fold is a single bounded block, its task goes on to the next level and round,
and one job grows all folds; else a job serves one level of one round of all
of them, adds the sums of a fold's blocks, and the driver sees a few numbers
per node.

The rules are those of ``GBTRegressor`` with squared error: up to 32 bins per
feature with cuts halfway between values, variance gain, first best split in
feature order, first tree with weight 1 and the others with ``step``. Shares of
rows are drawn by a hash of the row, shares of features by (fold, round, node),
so the same rows give the same trees however they are stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a feature, rows that its cuts are taken from (as many as the library takes), groups of folds, rounds between stored states.
BINS, CUT_ROWS, GROUPS, KEPT = 32, 10_000, 4, 10
#: Rows of a table whose folds are a block each.
BLOCK_ROWS = 50_000


def cuts_of(values: np.ndarray, most: int = BINS - 1) -> np.ndarray:
    """Cut points: between all different values, or at equal strides of rows."""
    v, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middle = (v[:-1] + v[1:]) / 2
    if len(middle) <= most:
        return middle
    stride, target, seen, out = len(values) / (most + 1), len(values) / (most + 1), int(counts[0]), []
    for i, c in enumerate(counts[1:].tolist()):
        before, seen = seen, seen + c
        if abs(before - target) < abs(seen - target):
            out.append(middle[i])
            target += stride
    return np.array(out)


def fold_cuts(rows: DataFrame, n: int, features: list[str], period: str, folds: list[str], medians: dict) -> list[list[np.ndarray]]:
    """Cuts per fold and feature, from its training rows (a bounded share of a large table of ``n`` rows); folds x features x 31 numbers."""
    some = rows if n <= CUT_ROWS else rows.where(F.pmod("_row", F.lit(1_000_000)) < 1_000_000 * CUT_ROWS / n)
    long = some.select(period, F.explode(F.array(*(F.struct(F.lit(i).alias("j"), F.col(f).cast("double").alias("v")) for i, f in enumerate(features)))).alias("x"))

    def cut(key, pdf):
        import pandas as pd
        own, v, j = pdf["p"].to_numpy(), pdf["v"].to_numpy(np.float64, na_value=np.nan), int(key[0])
        out = []
        for i, k in enumerate(folds):
            train = v[own != k]
            out.append((j, i, cuts_of(np.where(np.isnan(train), medians.get(k, {}).get(features[j], np.nan), train), min(BINS, max(len(train), 1)) - 1)))
        return pd.DataFrame(out, columns=["j", "k", "cuts"])

    cuts = [[np.zeros(0)] * len(features) for _ in folds]
    for r in long.select(F.col(period).alias("p"), "x.j", "x.v").groupBy("j").applyInPandas(cut, "j int, k int, cuts array<double>").collect():
        cuts[r.k][r.j] = np.array(r.cuts)
    return cuts


def binned(x: np.ndarray, k: int, cuts: list, fill: np.ndarray) -> np.ndarray:
    x = np.where(np.isnan(x), fill[k], x)
    return np.stack([np.searchsorted(c, x[:, j]).astype(np.uint8) for j, c in enumerate(cuts[k])], 1)


def placed(bins: np.ndarray, tree: tuple, depth: int) -> np.ndarray:
    """Node of every row; node i has the children 2i + 1 and 2i + 2."""
    feature, cut, _ = tree
    node, at = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = feature[node]
        node = np.where(f >= 0, 2 * node + 1 + (bins[at, np.maximum(f, 0)] > cut[node]), node)
    return node


def advanced(bins: np.ndarray, before: np.ndarray, trees: list, depth: int, step: float, first: int) -> np.ndarray:
    for m, tree in enumerate(trees, first):
        before = before + (1.0 if m == 0 else step) * tree[2][placed(bins, tree, depth)]
    return before


def drawn(row: np.ndarray, m: int, seed: int, share: float) -> np.ndarray:
    """Rows that round ``m`` sees: a mixed hash of row and round below the share."""
    z = row.astype(np.uint64) + np.uint64((m * 0x9E3779B97F4A7C15 + seed) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * 2**63) * 2 - 1 if share < 1 else 2**64 - 1)


def sums(bins: np.ndarray, node: np.ndarray, r: np.ndarray, level: int) -> np.ndarray:
    """Count, sum and sum of squares of ``r`` per (node of the level, feature, bin)."""
    at = node - (2 ** level - 1)
    use, nf = at >= 0, bins.shape[1]
    place = ((at[use][:, None] * nf + np.arange(nf)) * BINS + bins[use]).ravel()
    size, r = 2 ** level * nf * BINS, r[use]
    return np.stack([np.bincount(place, w, size) for w in (None, np.repeat(r, nf), np.repeat(r * r, nf))]).reshape(3, 2 ** level, nf, BINS)


def _variance(s: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(s[0] > 0, (s[2] - s[1] * s[1] / s[0]) / s[0], 0.0)


def best_splits(h: np.ndarray, n_cuts: np.ndarray, spread: list, allowed: list, leaf: int) -> list:
    """Per node (feature, cut, left value, right value, left spread, right spread), or its own value if no split gains."""
    out = []
    for i in range(h.shape[1]):
        c = np.cumsum(h[:, i], -1)
        whole, left = c[..., -1:], c[..., :-1]
        right = whole - left
        ok = (left[0] >= leaf) & (right[0] >= leaf) & (np.arange(BINS - 1) < n_cuts[:, None]) & allowed[i][:, None]
        own = spread[i]
        if own is None:
            j = int(np.argmax(allowed[i] & (n_cuts > 0)))
            own = float(_variance(left[:, j, 0] + right[:, j, 0]))
        share = left[0] / np.maximum(whole[0], 1)
        gain = np.where(ok, own - share * _variance(left) - right[0] / np.maximum(whole[0], 1) * _variance(right), -np.inf)
        j, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[j, b] > 0:
            x, y = left[:, j, b], right[:, j, b]
            out.append((int(j), int(b), x[1] / x[0], y[1] / y[0], float(_variance(x)), float(_variance(y))))
        else:
            out.append(whole[1, 0, 0] / whole[0, 0, 0] if whole[0, 0, 0] else None)
    return out


def features_seen(k: int, m: int, level: int, nf: int, subset: int, seed: int) -> list:
    """Features that each node of a level may split on, drawn by (fold, round, node)."""
    low = 2 ** level - 1
    return [np.isin(np.arange(nf), np.random.default_rng([seed, k, m, low + i]).permutation(nf)[:subset]) if subset < nf else np.ones(nf, bool)
            for i in range(2 ** level)]


def seedling(depth: int) -> tuple:
    """A tree without splits, the spread of its nodes and the nodes that it has so far."""
    nodes = 2 ** (depth + 1) - 1
    return (np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)), [None] * nodes, {0}


def settled(tree: tuple, spread: list, going: set, best: list, level: int) -> bool:
    """Puts the best splits of a level into the tree; false if it has no rows at all."""
    feature, cut, value = tree
    for at, b in enumerate(best, 2 ** level - 1):
        if at not in going:
            continue
        if isinstance(b, tuple):
            feature[at], cut[at] = b[:2]
            for child, v, s in ((2 * at + 1, b[2], b[4]), (2 * at + 2, b[3], b[5])):
                value[child], spread[child] = v, s
                going.add(child)
        elif at == 0:
            if b is None:
                return False
            value[0] = b
    return True


def boosted_folds(rows: DataFrame, features: list[str], target: str, period: str, keys: list[str], folds: list[str], medians: dict,
                  rounds: int = 150, depth: int = 3, leaf: int = 4, step: float = 0.05, share_rows: float = 1.0,
                  share_features: float = 1.0, seed: int = 42) -> DataFrame:
    """(keys, fold, real, pred) of the rows of every fold, by trees of all other rows. ``rows``: a materialised table
    in as many partitions as it asks for; ``medians``: fold -> feature -> number that stands for a missing value.

    A table of one partition and up to ``BLOCK_ROWS`` rows has one block a fold, and a single job grows the trees of all
    folds, a task a fold. A larger one is summed over its blocks, a job a level."""
    spark, nf = rows.sparkSession, len(features)
    rows = rows.where(F.col(period).isNotNull() & F.col(target).isNotNull()).withColumn("_row", F.xxhash64(*keys, target, *features))
    n = rows.count()
    cuts = fold_cuts(rows, n, features, period, folds, medians)
    n_cuts = np.array([[len(c) for c in own] for own in cuts])
    fill = np.array([[medians.get(k, {}).get(f, np.nan) for f in features] for k in folds], np.float64)
    number = {k: i for i, k in enumerate(folds)}
    shared = spark.sparkContext.broadcast((cuts, fill))
    data = rows.select("_row", period, F.col(target).cast("double"), F.array(*(F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features)),
                       F.struct(*keys)).rdd
    one_block = data.getNumPartitions() <= 1 and n <= BLOCK_ROWS
    groups = max(len(folds), 1) if one_block else GROUPS

    def columns(part: Iterator) -> tuple:
        part = list(part)
        own = np.array([number.get(r[1], -1) for r in part], np.int64)
        return part, own, np.array([r[2] for r in part], np.float64), np.array([r[3] for r in part], np.float64).reshape(len(part), nf)

    def blocks(p: int, part: Iterator) -> Iterator:
        part, own, y, x = columns(part)
        row = np.array([r[0] for r in part], np.int64)
        for k in range(len(folds)):
            train = own != k
            if train.any():
                yield p * groups + k % groups, (k, binned(x[train], k, *shared.value), y[train], row[train], np.zeros(int(train.sum())))

    parts = max(data.getNumPartitions(), 1) * groups
    state = data.mapPartitionsWithIndex(blocks).partitionBy(parts, lambda i: i).values()
    subset = int(np.ceil(share_features * nf))

    def counted(block: tuple, tree: tuple, m: int, level: int) -> np.ndarray:
        _, bins, y, row, before = block
        r = y if m == 0 else 2.0 * (y - before)
        use = drawn(row, m, seed, share_rows)
        return sums(bins[use], placed(bins[use], tree, level), r[use], level)

    def split(k: int, h: np.ndarray, spread: list, m: int, level: int) -> list:
        return best_splits(h, n_cuts[k], spread[2 ** level - 1:2 ** (level + 1) - 1], features_seen(k, m, level, nf, subset, seed), leaf)

    def boosted(block: tuple) -> tuple:
        """All rounds of a fold that is one block."""
        k, bins, y, row, before = block
        trees = []
        for m in range(rounds):
            tree, spread, going = seedling(depth)
            for level in range(depth):
                h = counted((k, bins, y, row, before), tree, m, level)
                if not settled(tree, spread, going, split(k, h, spread, m, level), level):
                    return k, None
            before = advanced(bins, before, [tree], depth, step, m)
            trees.append(tree)
        return k, trees

    def boosted_by_level(state: RDD) -> dict:
        """A round of all folds by a job a level; the stored state of a block is advanced every ``KEPT`` rounds."""
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        grown, first = {k: [] for k in range(len(folds))}, 0
        for m in range(rounds):
            young = [seedling(depth) for _ in folds]
            old = {k: t[first:] for k, t in grown.items()}
            for level in range(depth):
                def count(block: tuple, m=m, level=level, trees=[t for t, _, _ in young], old=old, first=first) -> tuple:
                    k, bins, y, row, before = block
                    before = advanced(bins, before, old[k], depth, step, first)
                    return k, counted((k, bins, y, row, before), trees[k], m, level)

                def best(item: tuple, m=m, level=level, spread=[s for _, s, _ in young]) -> tuple:
                    return item[0], split(*item, spread[item[0]], m, level)

                for k, b in state.map(count).reduceByKey(np.add, parts).map(best).collect():
                    if not settled(*young[k], b, level):
                        return {k: None}
            for k, (tree, _, _) in enumerate(young):
                grown[k].append(tree)
            if m + 1 - first >= KEPT and m + 1 < rounds:
                later = state.map(lambda s, old={k: t[first:] for k, t in grown.items()}, first=first: (*s[:4], advanced(s[1], s[4], old[s[0]], depth, step, first)))
                later = later.persist(StorageLevel.MEMORY_AND_DISK)
                later.checkpoint()
                later.count()
                state.unpersist()
                state, first = later, m + 1
        state.unpersist()
        return grown

    trees_of = dict(state.map(boosted).collect()) if one_block else boosted_by_level(state)  # folds x rounds x nodes numbers
    for k, trees in trees_of.items():
        if trees is None:
            raise ValueError(f"no training rows outside {folds[k]}")
    final = spark.sparkContext.broadcast(trees_of)

    def predicted(part: Iterator) -> Iterator[tuple]:
        part, own, y, x = columns(part)
        for k in sorted(set(own[own >= 0].tolist())):
            mine = np.flatnonzero(own == k)
            p = advanced(binned(x[mine], k, *shared.value), np.zeros(len(mine)), final.value.get(k, []), depth, step, 0)
            for i, v in zip(mine.tolist(), p.tolist()):
                yield (*part[i][4], folds[k], float(y[i]), v)

    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys) + ", fold string, real double, pred double"
    return spark.createDataFrame(data.mapPartitions(predicted), schema)
