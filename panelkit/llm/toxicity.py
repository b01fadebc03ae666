"""Toxicity: a counterfactual-regularised hashed linear classifier.

Features of a text are its lower-case words (runs of letters) and their first
four and five bytes, hashed to ``2**BITS`` numbers, each counted once. A sparse
logistic model is fitted on a bounded sample of labelled texts. For every
sampled text that names an identity group a counterfactual twin is made in which
each such term is swapped for the next of its family; the squared change of the
score between twins is penalised, so that terms which merely name a group gain no weight.

The sample: at most ``PER_CLASS`` labelled rows per label (expected), drawn by
a hash of the id; the classes are weighted back to their shares.

Defined results: a null or empty text has the score of the bias alone. With no
labelled row, or one label only, the score is that label's smoothed share for
every text. Labels given more than once count as toxic if one is. Repeated rows
are scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_of, crc_fold, small, stage
from .linear import Sparse, collect_features, distinct, fit_logistic, presence_sum, sigmoid, to_index
from .textarrays import chunks, span_hash

BITS = 20
PREFIXES = (4, 5)
PER_CLASS = 8000
L1 = 2e-4
PAIR_PENALTY = 10.0
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3

#: Families of terms that name groups of people; terms of a family are swapped for each other.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["frauen", "männer"], ["femmes", "hommes"], ["mujeres", "hombres"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"], ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslime", "christen", "juden"], ["musulmans", "chrétiens", "juifs"], ["musulmanes", "cristianos", "judíos"],
    ["black", "white", "asian", "latino", "african", "european"], ["gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"],
    ["immigrants", "refugees", "foreigners", "natives"], ["ausländer", "flüchtlinge", "einwanderer"],
    ["immigrés", "réfugiés", "étrangers"], ["inmigrantes", "refugiados", "extranjeros"], ["disabled", "blind", "deaf"], ["old", "young"],
]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes; start, end and document of every run of letters."""
    lower = _LOWER[data]
    inside = _LETTER[lower]
    begin, end = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = at[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begin[edges] |= inside[edges]
        end[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(begin)
    return lower, starts, np.flatnonzero(end) + 1, np.searchsorted(at, starts, "right") - 1


def features(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Document and feature number of every word and word beginning."""
    lower, starts, ends, doc = words_of(data, at)
    docs, index = [doc], [to_index(span_hash(lower, starts, ends), bits)]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        docs.append(doc[long])
        index.append(to_index(span_hash(lower, starts[long], starts[long] + k), bits))
    return np.concatenate(docs), np.concatenate(index)


def swapped(text: str, families: list[list[str]]) -> str | None:
    """The text with every identity term swapped for the next of its family; None if it has none."""
    partner = {t: family[(i + 1) % len(family)] for family in families for i, t in enumerate(family)}
    lower = text.translate({c: c + 32 for c in range(0x41, 0x5B)})
    data = np.frombuffer(lower.encode(), np.uint8)
    raw = data.tobytes()
    _, starts, ends, _ = words_of(data, np.array([0, len(data)]))
    parts, low = [], 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        other = partner.get(raw[a:b].decode())
        if other:
            parts += [raw[low:a], other.encode()]
            low = b
    return (b"".join([*parts, raw[low:]])).decode() if parts else None


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, label, share): drawn rows and the share of their class that was drawn."""
    labels = labels.where("label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    labels = labels.where(crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    # the classes are counted, and the rows drawn, before any text is joined
    sizes = small(stage(labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "classes"), 100)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    drawn = labels.join(sizes, "label").withColumn("share", F.least(F.lit(1.0), per_class / F.col("n"))).where(draw < F.col("share"))
    drawn = small(stage(drawn.select("doc_id", "label", "share"), "drawn"), 4 * per_class)
    return docs.join(drawn, "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("label").cast("double"), "share")


class Model:
    def __init__(self, bias: float, weight: np.ndarray, bits: int = BITS):
        self.bias, self.bits = bias, bits
        self.index = np.flatnonzero(weight)
        self.value = weight[self.index].astype(np.float32)

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.index] = self.value
        return out


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, l1: float = L1, pair_penalty: float = PAIR_PENALTY,
          families: list[list[str]] = IDENTITY_TERMS, bits: int = BITS) -> Model:
    """``docs`` has (doc_id, text), ``labels`` (doc_id, label)."""
    def lists(text: pa.Array) -> pa.Array:
        """Feature numbers of each text; for one with identity terms also its twin's, as -1 - number, behind them."""
        out = []
        for low, high, data, at in chunks(text):
            doc, index = distinct(*features(data, at, bits), bits)
            ends = np.searchsorted(doc, np.arange(high - low + 1))
            for i in range(high - low):
                own = index[ends[i]:ends[i + 1]]
                twin = swapped(text[low + i].as_py() or "", families) if pair_penalty else None
                if twin is not None:
                    raw = np.frombuffer(twin.encode(), np.uint8)
                    _, other = distinct(*features(raw, np.array([0, len(raw)]), bits), bits)
                    own = np.concatenate([own, -1 - other])
                out.append(own.astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    rows = labelled_sample(docs, labels, per_class)
    columns, row, index = collect_features(rows, lists, ["label", "share"])
    label, weight = columns["label"], 1 / np.maximum(columns["share"], 1e-12)
    if not len(label) or label.min() == label.max():
        share = (label.sum() + 1) / (len(label) + 2)
        return Model(float(np.log(share / (1 - share))), np.zeros(1 << bits), bits)
    twin = index < 0
    # features of fewer than three sampled texts say nothing and are left out
    often = np.bincount(index[~twin], minlength=1 << bits) >= 3
    chosen = np.flatnonzero(often)
    x = Sparse(row[~twin], index[~twin], (len(label), 1 << bits)).columns(chosen)
    paired = np.unique(row[twin])
    number = np.full(len(label), -1)
    number[paired] = np.arange(len(paired))
    of_pair = ~twin & (number[row] >= 0)
    pairs = Sparse(np.concatenate([number[row[of_pair]], number[row[twin]]]), np.concatenate([index[of_pair], -1 - index[twin]]), (max(len(paired), 1), 1 << bits),
                   np.concatenate([np.ones(of_pair.sum()), -np.ones(twin.sum())])).columns(chosen)
    bias, w = fit_logistic(x, label, weight, l1, pairs=pairs, pair_penalty=pair_penalty)
    out = np.zeros(1 << bits)
    out[chosen] = w
    return Model(bias, out, bits)


def score_udf(spark, model: Model):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        model = shared.value
        weight = model.dense()
        out = [sigmoid(presence_sum(*features(data, at, model.bits), weight, high - low, model.bits) + model.bias) for low, high, data, at in chunks(text)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             threshold: float = THRESHOLD, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, learnt from labelled rows that are not held out."""
    texts = docs.select(column_of(docs, id_col).alias("doc_id"), column_of(docs, text_col).cast("string").alias("text"))
    model = train(texts, labels.select(column_of(labels, id_col).alias("doc_id"), column_of(labels, label_col).alias("label")), **params)
    scored = texts.select("doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), score_udf(docs.sparkSession, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
