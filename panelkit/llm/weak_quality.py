"""Quality without labels: overlapping heuristic labellers, their accuracies by
expectation-maximisation, and a hashed linear scorer of their posterior labels.

Each labeller looks at one count of a text and votes good, bad or nothing. All
documents are counted by vote pattern (at most 3 ** labellers rows, whatever
the corpus), and EM on the pattern counts estimates the share of good documents
and, per labeller and class, how often it votes which way. The posterior of a
pattern is the label of its documents. A logistic model over hashed features of
the texts (words, and how large a share of the text each word shape has)
learns the posteriors from a bounded sample: about ``SAMPLE`` documents drawn by a
hash of the id, posteriors as soft labels.

Defined results: null and empty texts are scored and voted on like any text
without words. With an empty table the result is empty. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_of, small, stage
from .linear import Sparse, collect_features, distinct, fit_logistic, presence_sum, sigmoid, to_index
from .quality_rules import base_counts
from .textarrays import LEAD, SPACE, chunks, count_where, span_hash, word_bounds

BITS = 20
SAMPLE = 8000
L1 = 3e-4
GOOD = 0.5

#: Common function words of the languages expected.
STOP_WORDS = """the of and to in a is that for it as was with be by on not he his are this or had from at which but have an they you
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei
de la le les et des en un une du que dans est pour qui sur pas par plus au avec il sont se ce sa ou
el los las y del se por con no su para es al lo como más o pero sus este entre""".split()

#: Letter classes of a word's shape: other characters stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x30:0x3A] = ord("0")
_CLASS[0x80:] = ord("a")
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_STOP = np.zeros(256, np.uint64)


def _stop_hashes() -> np.ndarray:
    raw = [w.encode() for w in dict.fromkeys(STOP_WORDS)]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(span_hash(data, np.append(0, ends[:-1]), ends))


#: (labeller, vote bad where, vote good where) over the counts of a document.
LABELLERS = [
    ("length", "n_words < 10", "n_words >= 30"),
    ("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.01 * n_words"),
    ("repeated_words", "n_repeat_words > 0.2 * n_words", "n_repeat_words <= 0.05 * n_words AND n_words > 0"),
    ("repeated_lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0 AND n_lines >= 2"),
    ("capitals", "n_upper > 0.5 * n_letters", "n_upper <= 0.15 * n_letters AND n_letters > 0"),
    ("word_length", "word_chars > 14 * n_words OR word_chars < 2.5 * n_words OR n_words = 0", "word_chars BETWEEN 3 * n_words AND 10 * n_words AND n_words > 0"),
    ("stop_words", "n_stop < 0.03 * n_words OR n_words = 0", "n_stop >= 0.1 * n_words AND n_words > 0"),
    ("letters", "n_letters < 0.7 * word_bytes OR n_words = 0", "n_letters >= 0.9 * word_bytes AND n_words > 0"),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_stop", "word_bytes"]
COUNT_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])


def counts_udf():
    stop = _stop_hashes()

    @F.arrow_udf(COUNT_TYPE)
    def counts(text: pa.Array) -> pa.Array:
        found = []
        for _, _, data, at in chunks(text):
            n = len(at) - 1
            words, chars, symbols, lines, repeats = base_counts(data, at)
            starts, ends, doc = word_bounds(data, at)
            # a word without the marks at its end
            hashes = span_hash(_LOWER[data], starts, ends - (~_ALPHA[data[ends - 1]] & (ends - starts > 1)))
            is_stop = stop[np.minimum(np.searchsorted(stop, hashes), len(stop) - 1)] == hashes
            found.append([words, chars, symbols, lines, repeats, count_where(data == 10, at) + (np.diff(at) > 0), count_where(_UPPER[data], at),
                          count_where(_ALPHA[data], at), np.bincount(doc[is_stop], minlength=n), count_where(~SPACE[data], at)])
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * len(COUNTS)
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=COUNTS)

    return counts


def votes():
    """One character per labeller: 0 bad, 1 good, - nothing."""
    return F.concat(*(F.expr(f"CASE WHEN {bad} THEN '0' WHEN {good} THEN '1' ELSE '-' END") for _, bad, good in LABELLERS))


def estimate(patterns: list[str], n: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray, np.ndarray]:
    """EM: share of good documents, P(vote | class) as [labeller, class, vote], and the
    posterior of each pattern. It begins at the share of good votes, and every labeller is
    held to be right more often than not (one that tells nothing stays near even)."""
    vote = np.array([["-01".index(c) for c in p] for p in patterns])
    good, bad = (vote == 2).sum(1), (vote == 1).sum(1)
    q = (good + 1) / (good + 2 * bad + 2)
    shape = (vote.shape[1], 2, 3)
    for _ in range(rounds):
        share = float(np.clip((n * q).sum() / n.sum(), 1e-4, 1 - 1e-4))
        p = np.full(shape, 1.0)
        for c, weight in enumerate((n * (1 - q), n * q)):
            for j in range(shape[0]):
                p[j, c] += np.bincount(vote[:, j], weight, 3)
        p /= p.sum(2, keepdims=True)
        flipped = (p[:, 1, 2] * p[:, 0, 1] < p[:, 1, 1] * p[:, 0, 2])[:, None, None]
        p = np.where(flipped, p.mean(1, keepdims=True), p)
        odds = np.log(share / (1 - share)) + sum(np.log(p[j, 1, vote[:, j]] / p[j, 0, vote[:, j]]) for j in range(shape[0]))
        new = sigmoid(odds)
        if np.abs(new - q).max() < 1e-7:
            break
        q = new
    return share, p, new


def features(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for every word shape the size (power of two) of its share of the text's words."""
    starts, ends, doc = word_bounds(data, at)
    n = np.bincount(doc, minlength=len(at) - 1)
    word = to_index(span_hash(_LOWER[data], starts, ends), bits)
    kind = _CLASS[data]
    keep = np.ones(len(data), bool)  # a run of one class counts as one character
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    sums = np.append(0, np.cumsum(keep))
    shape = span_hash(kind[keep], sums[starts], sums[ends])
    order = np.lexsort((shape, doc))
    d, s = doc[order], shape[order]
    first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (s[1:] != s[:-1]))) if len(d) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(d)))
    size = np.floor(np.log2(times / n[d[first]] * 1024)).astype(np.int64)
    shared = to_index(s[first] * np.uint64(0x9E3779B97F4A7C15) + (size + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), bits)
    return np.concatenate([doc, d[first]]), np.concatenate([word, shared])


class Model:
    def __init__(self, bias: float, weight: np.ndarray, bits: int):
        self.bias, self.bits, self.index = bias, bits, np.flatnonzero(weight)
        self.value = weight[self.index].astype(np.float32)

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.index] = self.value
        return out


def train(rows: DataFrame, l1: float = L1, bits: int = BITS) -> Model:
    """``rows``: a bounded sample with (text, posterior)."""
    def lists(text: pa.Array) -> pa.Array:
        out = []
        for low, high, data, at in chunks(text):
            doc, index = distinct(*features(data, at, bits), bits)
            ends = np.searchsorted(doc, np.arange(high - low + 1)).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(index.astype(np.int32))))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    columns, row, index = collect_features(rows, lists, ["posterior"])
    y = columns["posterior"]
    if not len(y):
        return Model(0.0, np.zeros(1 << bits), bits)
    chosen = np.flatnonzero(np.bincount(index, minlength=1 << bits) >= 5)
    bias, w = fit_logistic(Sparse(row, index, (len(y), 1 << bits)).columns(chosen), y, np.ones(len(y)), l1)
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


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = GOOD) -> DataFrame:
    """(doc_id, votes, posterior, score, predicted, kept) of every row."""
    texts = docs.select(column_of(docs, id_col).alias("doc_id"), column_of(docs, text_col).cast("string").alias("text"))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.length("text")), F.lit(1 << 30)).alias("draw")
    counted = texts.select("doc_id", draw, counts_udf()("text").alias("c")).select("doc_id", "draw", "c.*")
    voted = stage(counted.select("doc_id", "draw", votes().alias("votes")), "votes")

    tally = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    spark = docs.sparkSession
    patterns, n = [r["votes"] for r in tally], np.array([r["n"] for r in tally], float)
    posterior = estimate(patterns, n)[2] if patterns else np.zeros(0)
    # at most 3 ** labellers rows
    known = F.broadcast(spark.createDataFrame(list(zip(patterns, map(float, posterior))), "votes string, posterior double"))

    drawn = voted.where(F.col("draw") < int((1 << 30) * min(1.0, sample / max(n.sum(), 1)))).join(known, "votes").select("doc_id", "posterior").groupBy("doc_id").agg(F.min("posterior").alias("posterior"))
    drawn = small(stage(drawn, "drawn"), 2 * sample)
    model = train(texts.join(drawn, "doc_id").select("text", "posterior"))
    scored = texts.select("doc_id", draw, counts_udf()("text").alias("c"), score_udf(spark, model)("text").alias("score"))
    scored = scored.select("doc_id", "score", "c.*").withColumn("votes", votes()).join(known, "votes", "left")
    good = F.col("score") >= threshold
    return scored.select("doc_id", "votes", "posterior", "score", good.cast("int").alias("predicted"), good.alias("kept"))
