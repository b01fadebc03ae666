"""Hashed linear classifiers: presence features of texts as index arrays, and a
sparse logistic fit on a bounded sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textarrays import span_hash

_U = np.uint64


def to_index(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U(64 - bits)).astype(np.int64)


def distinct(doc: np.ndarray, index: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each (document, feature) once, in order."""
    key = np.unique((doc << bits) | index)
    return key >> bits, key & ((1 << bits) - 1)


def presence_sum(doc: np.ndarray, index: np.ndarray, weight: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Per document the sum of the weights of its different features; features of weight 0 drop out first."""
    used = weight[index] != 0
    doc, index = distinct(doc[used], index[used], bits)
    return np.bincount(doc, weight[index], n)


def collect_features(rows: DataFrame, features, columns: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """A bounded sample's other columns and its (row, feature) pairs. ``features``
    maps a text column to an Arrow list column of feature numbers."""
    udf = F.arrow_udf(T.ArrayType(T.IntegerType()))(features)
    table = rows.select(*columns, udf("text").alias("index")).toArrow()
    index = table.column("index").combine_chunks()
    size = np.diff(index.offsets.to_numpy())
    return ({c: table.column(c).to_numpy() for c in columns}, np.repeat(np.arange(len(size)), size), index.flatten().to_numpy())


class Sparse:
    """0/1 (or signed) matrix as coordinate arrays."""

    def __init__(self, row: np.ndarray, col: np.ndarray, shape: tuple[int, int], value: np.ndarray | None = None):
        self.row, self.col, self.shape, self.value = row, col, shape, value

    def dot(self, w: np.ndarray) -> np.ndarray:
        x = w[self.col]
        return np.bincount(self.row, x if self.value is None else x * self.value, self.shape[0])

    def transposed_dot(self, r: np.ndarray) -> np.ndarray:
        x = r[self.row]
        return np.bincount(self.col, x if self.value is None else x * self.value, self.shape[1])

    def columns(self, chosen: np.ndarray) -> Sparse:
        number = np.full(self.shape[1], -1)
        number[chosen] = np.arange(len(chosen))
        on = number[self.col] >= 0
        return Sparse(self.row[on], number[self.col[on]], (self.shape[0], len(chosen)), None if self.value is None else self.value[on])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: Sparse, y: np.ndarray, weight: np.ndarray, l1: float, l2: float = 0.0, pairs: Sparse | None = None,
                 pair_penalty: float = 0.0, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise weighted log loss (soft labels in [0, 1])
    + l1 |w| + l2/2 |w|^2 + pair_penalty * mean((pairs w)^2), by accelerated
    proximal gradient on the features that can be active; those left out are
    checked at the end and taken in if they violate the optimality condition."""
    weight = weight / weight.sum()
    mean = float(np.clip((weight * y).sum(), 1e-6, 1 - 1e-6))
    bias, w = float(np.log(mean / (1 - mean))), np.zeros(x.shape[1])
    active = np.flatnonzero(np.abs(x.transposed_dot(weight * (mean - y))) > l1)
    for _ in range(10):
        if not len(active):
            break
        sub, sub_pairs = x.columns(active), pairs.columns(active) if pairs is not None else None
        bias, w[active] = _accelerated(sub, y, weight, l1, l2, sub_pairs, pair_penalty, bias, w[active], rounds)
        slope = np.abs(x.transposed_dot(weight * (sigmoid(x.dot(w) + bias) - y)))
        slope[active] = 0
        more = np.flatnonzero(slope > 1.05 * l1)
        if not len(more):
            break
        active = np.union1d(active, more)
    return bias, w


def _accelerated(x, y, weight, l1, l2, pairs, pair_penalty, bias, w, rounds) -> tuple[float, np.ndarray]:
    per_pair = 2 * pair_penalty / max(pairs.shape[0], 1) if pairs is not None and len(pairs.row) else 0.0

    def curvature(v):  # of the loss, at most
        out = x.transposed_dot(0.25 * weight * (x.dot(v[1:]) + v[0])) + l2 * v[1:]
        if per_pair:
            out = out + per_pair * pairs.transposed_dot(pairs.dot(v[1:]))
        return np.append((0.25 * weight * (x.dot(v[1:]) + v[0])).sum(), out)

    v = np.ones(x.shape[1] + 1)
    for _ in range(20):
        v = curvature(v / np.linalg.norm(v))
    step = 1 / (1.1 * np.linalg.norm(v) + 1e-12)
    now = ahead = np.append(bias, w)
    t = 1.0
    for _ in range(rounds):
        r = weight * (sigmoid(x.dot(ahead[1:]) + ahead[0]) - y)
        slope = x.transposed_dot(r) + l2 * ahead[1:]
        if per_pair:
            slope = slope + per_pair * pairs.transposed_dot(pairs.dot(ahead[1:]))
        new = ahead - step * np.append(r.sum(), slope)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * l1, 0)
        if (new - now) @ (ahead - new) > 0:  # momentum points uphill: begin again
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - now)
        moved = np.abs(new - now).max()
        now, t = new, t_new
        if moved < 1e-6:
            break
    return float(now[0]), now[1:]
