"""Quality rules: word counts, repetition, and n-gram perplexity bands.

A modified Kneser-Ney model of byte n-grams (``ORDER`` bytes, one vocabulary
per value of the language column) is counted by Spark over all texts, every
(language, n-gram) by itself. Lower orders use continuation counts. Counts,
contexts and probabilities of all orders are Spark tables, joined order by
order, so nothing of the model is held in one place; the result is one
probability for every n-gram that occurs. Texts are scored against it in passes
of about ``PASS_KEYS`` n-grams, each broadcast in the order of the keys' hash:
the number of passes grows with the different n-grams, memory does not.

No document is scored by a model that holds it: a hash of the text puts it into
one of two folds (copies into the same), each fold has a model of its own, and
the texts of one are scored by the other's. The discounts, three numbers an
order, come from both.

A document's score is its mean negative log probability (nats per byte).
Quartiles per language over all documents that pass the base rules give the
band ``[q1 - reach * iqr, q3 + reach * iqr]``; scores outside are rejected.

Defined results: a null or empty text has no words and fails the base rules.
A null language counts as the language "". Repeated rows are judged one by
one, alike. An empty table gives an empty result. Texts too short for one
n-gram have a null score and are judged by the base rules alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, column_of, packed, small, stage
from .textarrays import LEAD, SPACE, buffers, chunks, count_where, mix, span_hash, word_bounds

ORDER = 5
#: n-grams of the model that are broadcast at once, and that a counting task gathers before it lets go of them.
PASS_KEYS, HELD_KEYS = 6_000_000, 1 << 21
#: Bits of a key for the language, above the bytes.
LANG_BITS = 22
REACH = 4.0
#: Least spread, as a share of the median score: near-uniform corpora keep a wide band.
SPREAD_FLOOR = 0.06
MIN_WORDS, REPEAT_WORDS, REPEAT_PCT = 10, 5, 20
_U = np.uint64
_SPREAD = _U(0x9E3779B97F4A7C15)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, nll double"
_STATS_TYPE = pa.struct([(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams")]
                        + [("nll", pa.float64())])


# ---------------------------------------------------------------- base rules

def base_counts(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words per document."""
    n = len(at) - 1
    starts, ends, doc = word_bounds(data, at)
    words = np.bincount(doc, minlength=n)
    inside = ~SPACE[data]
    chars = count_where(inside & LEAD[data], at)
    symbols = count_where(_SYMBOL[data], at)
    return [words, chars, symbols, _duplicate_lines(data, at, inside), _repeated_words(data, starts, ends, doc, n)]


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """Which keys equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def _duplicate_lines(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    cuts = np.flatnonzero(data == 10)
    starts = np.union1d(at[:-1][at[:-1] < at[1:]], cuts + 1)
    starts = starts[starts < len(data)]
    doc = np.searchsorted(at, starts, "right") - 1
    cut = np.append(cuts, len(data))
    ends = np.minimum(cut[np.searchsorted(cut, starts)], at[doc + 1])
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=sums[1:])
    worded = sums[ends] > sums[starts]
    starts, ends, doc = starts[worded], ends[worded], doc[worded]
    again = _seen_before(span_hash(data, starts, ends) ^ mix(doc.astype(_U)))
    return np.bincount(doc[again], minlength=n)


def _repeated_words(data, starts, ends, doc, n: int) -> np.ndarray:
    size = REPEAT_WORDS
    if len(starts) < size:
        return np.zeros(n, np.int64)
    word = span_hash(data, starts, ends)
    first = np.arange(len(word) - size + 1)
    first = first[doc[first] == doc[first + size - 1]]
    keys = span_hash(word, first, first + size) ^ mix(doc[first].astype(_U))
    again = _seen_before(keys)
    twice = again | _seen_before(keys[::-1])[::-1]
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, first[twice], 1)
    np.add.at(edge, first[twice] + size, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)


# ------------------------------------------------------------- n-gram model

def ngram_keys(data: np.ndarray, at: np.ndarray, lang: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Key (the language's code, then the bytes) and document of every n-gram that lies in one document."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    whole = np.ones(len(data), bool)
    for back in range(1, order):
        spot = at[1:] - back
        whole[spot[spot >= 0]] = False
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]
    key = lang.astype(_U)[doc]
    for i in range(order):
        key = (key << _U(8)) | data[i:i + n]
    whole = whole[:n]
    return key[whole], doc[whole]


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and the sums of their counts."""
    known, back = np.unique(np.concatenate(keys), return_inverse=True)
    return known, np.bincount(back, np.concatenate(counts), len(known)).astype(np.int64)


def count_ngrams(rows: DataFrame, held: int = HELD_KEYS) -> DataFrame:
    """(key, n) of every n-gram in (text, code) rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0

        def out(known, n):
            for low in range(0, len(known), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(known[low:low + (1 << 16)].astype(np.int64)), pa.array(n[low:low + (1 << 16)])], ["key", "n"])

        for batch in batches:
            code = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high, data, at in chunks(batch.column(0)):
                known, n = np.unique(ngram_keys(data, at, code[low:high])[0], return_counts=True)
                keys, counts, size = keys + [known], counts + [n], size + len(known)
                if size > 2 * held:
                    known, n = merged(keys, counts)
                    if len(known) > held:  # summed with what follows by Spark
                        yield from out(known, n)
                        known, n = known[:0], n[:0]
                    keys, counts, size = [known], [n], len(known)
        if size:
            yield from out(*merged(keys, counts))

    return rows.select("text", "code").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def language_code(lang: Column) -> Column:
    return F.crc32(F.coalesce(lang.cast("string"), F.lit("")).cast("binary")).bitwiseAND(F.lit((1 << LANG_BITS) - 1))


def model_code(lang: Column, text: Column) -> Column:
    """The language's code and, above it, the text's fold."""
    fold = F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(1))
    return F.shiftleft(fold, LANG_BITS).bitwiseOR(language_code(lang))


class Table:
    """Values by key: the keys in the order of their hash, and where each of ``2**bits`` ranges of it begins."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int):
        hashed = keys * _SPREAD  # an odd factor: different keys stay different
        order = np.argsort(hashed)
        self.bits, self.hashed, self.values = bits, hashed[order], values[order].astype(np.float32)
        self.start = np.append(0, np.cumsum(np.bincount(self._range(hashed), minlength=1 << bits))).astype(np.int32)

    def _range(self, hashed: np.ndarray) -> np.ndarray:
        return (hashed >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, other: float) -> np.ndarray:
        hashed, out = keys * _SPREAD, np.full(len(keys), other)
        own = self._range(hashed)
        spot, end = self.start[own], self.start[own + 1]
        left = np.flatnonzero(spot < end)
        spot, end = spot[left], end[left]
        while len(left):
            hit = self.hashed[spot] == hashed[left]
            out[left[hit]] = self.values[spot[hit]]
            spot = spot + 1
            on = ~hit & (spot < end)
            left, spot, end = left[on], spot[on], end[on]
        return out


@dataclass
class Model:
    """The model in memory. ``top``: log probabilities of the top order. For each lower order:
    sorted keys and log probabilities; for each order: sorted contexts and log back-off weights."""

    top: Table
    lower: list[tuple[np.ndarray, np.ndarray]]
    backoff: list[tuple[np.ndarray, np.ndarray]]

    def logp(self, keys: np.ndarray) -> np.ndarray:
        out = self.top.find(keys, np.nan)
        missed = np.flatnonzero(np.isnan(out))
        if len(missed):
            unique, back = np.unique(keys[missed], return_inverse=True)
            out[missed] = self._backed_off(unique, ORDER)[back]
        return out

    def _backed_off(self, keys: np.ndarray, order: int) -> np.ndarray:
        weight = _find(*self.backoff[order], keys >> _U(8), 0.0)
        if order == 1:
            return weight - np.log(256.0)
        short = _suffix(keys, order)
        known, values = self.lower[order - 1]
        out = _find(known, values, short, np.nan)
        missed = np.isnan(out)
        if missed.any():
            out[missed] = self._backed_off(short[missed], order - 1)
        return weight + out


def _find(known: np.ndarray, values: np.ndarray, keys: np.ndarray, other: float) -> np.ndarray:
    if not len(known):
        return np.full(len(keys), other)
    spot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[spot] == keys, values[spot], other)


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    """Keys of one order less, without the first byte."""
    body = _U(8 * order)
    return ((keys >> body) << _U(8 * (order - 1))) | (keys & ((_U(1) << _U(8 * (order - 1))) - _U(1)))


def fit(keys: np.ndarray, counts: np.ndarray, bits: int = 16) -> Model:
    """Modified Kneser-Ney in memory, for counts that fit there: interpolated log probabilities of every order from the top order's counts."""
    order_keys, order_counts = {}, {}
    sort = np.argsort(keys)
    order_keys[ORDER], order_counts[ORDER] = keys[sort].astype(_U), counts[sort].astype(np.float64)
    for order in range(ORDER, 1, -1):
        short, n = np.unique(_suffix(order_keys[order], order), return_counts=True)
        order_keys[order - 1], order_counts[order - 1] = short, n.astype(np.float64)
    logp: dict[int, np.ndarray] = {}
    backoff: list = [None] * (ORDER + 1)
    for order in range(1, ORDER + 1):
        known, n = order_keys[order], order_counts[order]
        cut = _discounts([float((n == k).sum()) for k in (1, 2, 3, 4)])[np.minimum(n, 3).astype(int)]
        context, back = np.unique(known >> _U(8), return_inverse=True)
        total = np.bincount(back, n, len(context))
        weight = np.bincount(back, cut, len(context)) / np.maximum(total, 1e-300)
        if order == 1:
            shorter = np.full(len(known), 1 / 256)
        else:
            shorter = np.exp(_find(order_keys[order - 1], logp[order - 1], _suffix(known, order), 0.0))
        logp[order] = np.log(np.maximum((n - cut) / total[back] + weight[back] * shorter, 1e-300))
        backoff[order] = (context, np.log(np.maximum(weight, 1e-300)))
    lower = [(order_keys[o], logp[o].astype(np.float32)) if 0 < o < ORDER else None for o in range(ORDER + 1)]
    return Model(Table(order_keys[ORDER], logp[ORDER], bits), lower, backoff)


def _discounts(once: list[float]) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) from how many counts are 1, 2, 3 and 4; halves of the count where those are too few."""
    n = [0, *once]
    out = np.array([0.0, 0.5, 0.75, 1.0])
    if all(n[1:]):
        y = n[1] / (n[1] + 2 * n[2])
        fitted = np.array([0.0] + [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)])
        out = np.where((fitted > 0) & (fitted <= [1, 1, 2, 3]), fitted, out)
    return out


def probabilities(counts: DataFrame, held_out: bool = True) -> DataFrame:
    """(key, logp) of every key of the written ``counts``: what ``fit`` finds, by joins; if ``held_out``, from the other fold."""
    orders = {ORDER: counts}
    for order in range(ORDER, 1, -1):
        short = orders[order].select(_suffix_of(F.col("key"), order).alias("key"))
        orders[order - 1] = stage(short.groupBy("key").agg(F.count(F.lit(1)).alias("n")), f"order{order - 1}")
    for order in range(1, ORDER + 1):
        few = {r["n"]: float(r["count"]) for r in orders[order].where("n < 5").groupBy("n").count().collect()}
        d = _discounts([few.get(k, 0.0) for k in (1, 2, 3, 4)]).tolist()
        model = orders[order].withColumn("cut", F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3]))
        if held_out:  # the model's keys become those of the fold that asks
            model = model.withColumn("key", F.col("key").bitwiseXOR(F.lit(1 << (8 * order + LANG_BITS))))
        contexts = model.groupBy(_context(F.col("key")).alias("context")).agg(F.sum("n").alias("total"), F.sum("cut").alias("cuts"))
        asked = orders[order].select("key", _context(F.col("key")).alias("context"))
        found = asked.join(model.select("key", (F.col("n") - F.col("cut")).alias("own")), "key", "left").join(contexts, "context", "left")
        if order == 1:
            found = found.withColumn("shorter", F.lit(1 / 256))
        else:
            found = found.withColumn("suffix", _suffix_of(F.col("key"), order)).join(below, "suffix")  # noqa: F821
        p = F.coalesce(F.col("own") / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("cuts") / F.col("total"), F.lit(1.0)) * F.col("shorter")
        found = stage(found.select("key", F.greatest(p, F.lit(1e-300)).alias("p")), f"probabilities{order}")
        below = found.select(F.col("key").alias("suffix"), F.col("p").alias("shorter"))
    return found.select("key", F.log("p").cast("float").alias("logp"))


def _context(key: Column) -> Column:
    return F.shiftright(key, 8)


def _suffix_of(key: Column, order: int) -> Column:
    body = 8 * (order - 1)
    return F.shiftleft(F.shiftright(key, body + 8), body).bitwiseOR(key.bitwiseAND(F.lit((1 << body) - 1)))


# ------------------------------------------------------------------ verdicts

def part_of(model: DataFrame, part: int, parts: int):
    """The keys of one pass, broadcast."""
    found = model.where(F.col("key") % parts == part).toArrow()
    keys = found.column("key").to_numpy().astype(np.int64).view(_U)
    return model.sparkSession.sparkContext.broadcast(Table(keys, found.column("logp").to_numpy(), min(24, max(1, len(keys).bit_length()))))


def _negative_logp(table: Table, part: int, parts: int, keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum per document over the keys of one pass."""
    if parts > 1:
        own = keys % _U(parts) == _U(part)
        keys, doc = keys[own], doc[own]
    return -np.bincount(doc, table.find(keys, 0.0), n)


def measure(table, parts: int = 1):
    """UDF (text, code) -> base counts, number of n-grams and negative log probability of those of the first pass."""
    @F.arrow_udf(STATS_DDL)
    def measured(text: pa.Array, lang: pa.Array) -> pa.Array:
        code = lang.to_numpy(zero_copy_only=False)
        found = []
        for low, high, data, at in chunks(text):
            keys, doc = ngram_keys(data, at, code[low:high])
            found.append([*base_counts(data, at), np.bincount(doc, minlength=high - low), _negative_logp(table.value, 0, parts, keys, doc, high - low)])
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0)] * 7
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns[:6]] + [pa.array(columns[6])], fields=list(_STATS_TYPE))

    # so that a filter on the result does not evaluate it again
    return measured.asNondeterministic()


def measure_part(table, part: int, parts: int):
    """UDF (text, code) -> negative log probability of the n-grams of one pass."""
    @F.arrow_udf("double")
    def measured(text: pa.Array, lang: pa.Array) -> pa.Array:
        code = lang.to_numpy(zero_copy_only=False)
        found = [np.zeros(0)]
        for low, high, data, at in chunks(text):
            found.append(_negative_logp(table.value, part, parts, *ngram_keys(data, at, code[low:high]), high - low))
        return pa.array(np.concatenate(found))

    return measured


STATS_DDL = f"struct<{STATS.replace(' long', ': bigint').replace(' double', ': double')}>"


def judge(rows: DataFrame, text: Column, lang: Column, keep: list[Column], reach: float = REACH, written: bool = True, pass_keys: int = PASS_KEYS) -> DataFrame:
    """``keep`` columns plus the counts, ``nll``, ``base_failed`` and ``kept`` of every row.
    The scores are needed twice (for the bands, then to judge): they are ``written`` with
    the ``keep`` columns, or, where those hold whole texts, found twice instead."""
    text = text.cast("string")
    code = model_code(lang, text)
    coded = rows.select(text.alias("text"), code.alias("code"))
    model = probabilities(stage(count_ngrams(coded), "ngrams"))
    parts = -(-model.count() // pass_keys) or 1
    parts += parts > 1 and parts % 2 == 0  # odd, so that a key's part depends on all its bytes
    # what later passes find belongs to the text, whose rows are met again by its hash
    name = F.md5(F.concat(code.cast("string"), F.lit(" "), F.coalesce(text, F.lit(""))).cast("binary"))
    later = []
    for part in range(1, parts):
        found = measure_part(part_of(model, part, parts), part, parts)(F.col("text"), F.col("code"))
        found = coded.select(F.md5(F.concat(F.col("code").cast("string"), F.lit(" "), F.coalesce("text", F.lit(""))).cast("binary")).alias("name"), found.alias("more"))
        later.append(stage(found.groupBy("name").agg(F.max("more").alias("more")), "pass"))
    scored = rows.select(*keep, F.coalesce(lang.cast("string"), F.lit("")).alias("band_lang"), *([name.alias("name")] if later else []),
                         measure(part_of(model, 0, parts), parts)(text, code).alias("m"))
    names = [c.split(" ")[0] for c in STATS.split(", ")]
    scored = scored.select("*", *(F.col(f"m.{c}").alias(c) for c in names)).drop("m")
    if later:
        more = later[0]
        for found in later[1:]:
            more = more.unionByName(found)
        scored = scored.join(more.groupBy("name").agg(F.sum("more").alias("more")), "name").withColumn("nll", F.col("nll") + F.col("more")).drop("name", "more")
    scored = scored.withColumn("nll", F.when(F.col("n_grams") > 0, F.col("nll") / F.col("n_grams"))).drop("n_grams")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PCT * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    if written:
        scored = stage(scored, "quality")
    bands = small(stage(language_bands(scored, reach), "bands"))
    judged = scored.join(bands, "band_lang", "left")
    inside = F.col("nll").isNull() | F.col("low").isNull() | F.col("nll").between(F.col("low"), F.col("high"))
    return judged.withColumn("kept", ~F.col("base_failed") & inside).drop("band_lang", "low", "high")


def language_bands(scored: DataFrame, reach: float) -> DataFrame:
    """Per language: the lowest and highest accepted score."""
    quartiles = F.percentile_approx("nll", [0.25, 0.5, 0.75], 10000)
    spread = F.greatest(F.col("q")[2] - F.col("q")[0], SPREAD_FLOOR * F.col("q")[1])
    return (scored.where(~F.col("base_failed") & F.col("nll").isNotNull())
            .groupBy("band_lang").agg(quartiles.alias("q"))
            .select("band_lang", (F.col("q")[0] - reach * spread).alias("low"), (F.col("q")[2] + reach * spread).alias("high")))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", reach: float = REACH) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    rows = packed(docs, text=column_of(docs, text_col), lang=column_of(docs, lang_col))
    judged = judge(rows, F.col("text"), F.col("lang"), [F.col(ROW)], reach, written=False)
    return judged.where("kept").select(f"{ROW}.*")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", reach: float = REACH) -> DataFrame:
    """Counts, score and verdict of every row."""
    rows = docs.select(column_of(docs, id_col).alias("doc_id"), column_of(docs, text_col).alias("text"), column_of(docs, lang_col).alias("lang"))
    return judge(rows, F.col("text"), F.col("lang"), [F.col("doc_id")], reach).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("nll").alias("nats_per_byte"))
