"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language is made into a suffix automaton.
A text is parsed against each: from the current place, the longest match that
occurs anywhere in the sample is one phrase, then the next begins. A text in the
sample's language falls into fewer, longer phrases; with c phrases against a
sample of n symbols the cost is c * log2(n). The language of least cost wins.

Because a phrase always begins at the automaton's root, parsing needs no suffix
links: the automaton is completed to a table (state, symbol) -> (next state,
phrases ended), and all texts of a run go through it in step, as numpy vectors,
in segments of ``SEGMENT`` symbols (a phrase ends where a segment ends).

Symbols are UTF-8 bytes, A-Z in lower case, with every run of other ASCII
characters than letters as one separator.

The sample: per language up to ``sample`` symbols of labelled texts drawn by a
hash of the id and text, those of at most ``SHORT`` characters first, and of a
longer text ``WINDOWS`` stretches over its whole length. The first ``LEAST``
texts of a language in the order of the hash are always drawn, so every label
with a text has a sample. Totals for the drawing cover all labelled rows.

Defined results: a null text, or one without letters, is ``und`` with score 0;
so is every text if nothing is labelled. Equal costs go to the first language
in order. Repeated rows are scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import column_of, crc_fold, small, stage
from .textarrays import chunks

SAMPLE = 1 << 15
SHORT = 4096
#: Stretches taken from a longer text (``SHORT`` characters together), and texts of a language that are drawn in any case.
WINDOWS, LEAST = 8, 64
SEGMENT = 1024
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_BYTE = np.arange(256, dtype=np.int32)
_BYTE[0x41:0x5B] += 32
_BYTE[:128][~_LETTER[:128]] = 0


def symbols(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters and bytes beyond ASCII, runs of others as one 0; offsets of the texts."""
    value = _BYTE[data]
    keep = value != 0
    if len(keep):
        keep[1:] |= value[:-1] != 0
        keep[0] = True
    sums = np.append(0, np.cumsum(keep))
    return value[keep], sums[at]


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of every state; state 0 is the root and every path from it spells a substring."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in step[p]:
            step[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = step[p][symbol]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(symbol) == q:
                    step[p][symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


@dataclass
class Parser:
    """``table[state * width + symbol] = next state * 4 + phrases ended``, all languages in one."""

    languages: list[str]
    table: np.ndarray
    width: int
    code: np.ndarray   # byte -> symbol
    roots: np.ndarray  # per language
    cost: np.ndarray   # of one phrase, per language

    def phrases(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of phrases per text and language."""
        texts, kinds = len(at) - 1, len(self.languages)
        size = np.diff(at)
        pieces = (size + SEGMENT - 1) // SEGMENT
        text = np.repeat(np.arange(texts), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = at[text] + nth * SEGMENT
        length = np.minimum(size[text] - nth * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        text, start, length = text[order], start[order], length[order]
        symbol = self.code[value]
        state = np.repeat(self.roots[None, :], len(text), 0)
        ended = np.zeros((len(text), kinds), np.int32)
        active = len(text)
        for i in range(int(length[0]) if len(length) else 0):
            active = int(np.searchsorted(-length[:active], -i, "left"))
            got = self.table[state[:active] * self.width + symbol[start[:active] + i][:, None]]
            ended[:active] += got & 3
            state[:active] = got >> 2
        ended += state != self.roots
        out = np.zeros((texts, kinds), np.int64)
        np.add.at(out, text, ended)
        return out


def build_parser(samples: dict[str, np.ndarray]) -> Parser:
    languages = sorted(samples)
    seen = np.unique(np.concatenate([samples[x] for x in languages])) if languages else np.zeros(0, np.int32)
    width = len(seen) + 1  # the last symbol: any other
    code = np.full(256, len(seen), np.int32)
    code[seen] = np.arange(len(seen))
    tables, roots, low = [], [], 0
    for language in languages:
        step = suffix_automaton(code[samples[language]].tolist())
        # nearest states first: parses stay near the root, so their rows stay in cache
        number, queue = {0: 0}, [0]
        for state in queue:
            for symbol, to in step[state].items():
                if to not in number:
                    number[to] = len(queue)
                    queue.append(to)
        n = len(queue)
        to = np.full((n, width), -1, np.int32)
        for state in queue:
            row = to[number[state]]
            for symbol, target in step[state].items():
                row[symbol] = number[target]
        root = to[0]
        again = np.where(root >= 0, (root + low) * 4 + 1, low * 4 + 2)  # from the root, after a phrase
        full = np.where(to >= 0, (to + low) * 4, again[None, :])
        full[0] = np.where(root >= 0, (root + low) * 4, low * 4 + 1)
        tables.append(full.astype(np.int32).reshape(-1))
        roots.append(low)
        low += n
    cost = np.array([np.log2(max(len(samples[x]), 2)) for x in languages])
    return Parser(languages, np.concatenate(tables) if tables else np.zeros(0, np.int32), width, code, np.array(roots, np.int32), cost)


def draw_samples(rows: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Symbols per language from (doc_id, text, lang) rows; at most about twice ``sample``
    characters and ``LEAST`` short and ``LEAST`` cut texts of a language reach the driver."""
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").withColumn("long", F.length("text") > SHORT)
    sizes = rows.groupBy("lang", "long").agg(F.sum(F.length("text")).alias("chars"))
    totals = sizes.groupBy("lang").agg(*(F.coalesce(F.sum(F.when(F.col("long") == v, F.col("chars"))), F.lit(0)).alias(n) for n, v in (("short_chars", False), ("long_chars", True))))
    totals = small(stage(totals, "langs"))
    share = F.when(F.col("long"), 0.0).when(F.col("short_chars") > 0, 2.0 * sample / F.col("short_chars")).otherwise(0.0)
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), F.lit(1 << 30)) / float(1 << 30)
    size = SHORT // WINDOWS
    stretches = F.when(F.col("long"), F.expr(f"transform(sequence(0, {WINDOWS - 1}), i -> substring(text, CAST(i * CAST(length(text) - {size} AS BIGINT) DIV {WINDOWS - 1} AS INT) + 1, {size}))"))
    cut = rows.withColumn("draw", draw).select("lang", "long", "draw", F.coalesce(stretches, F.array("text")).alias("texts"))
    # long texts only where the short ones do not fill the sample
    cut = cut.join(totals, "lang").where(~F.col("long") | (F.col("short_chars") < sample)).withColumn("drawn", F.col("draw") < share)
    first = Window.partitionBy("lang", "long").orderBy("draw", "texts")
    least = cut.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= LEAST).where("NOT drawn")
    wanted = ["lang", "long", "draw", "texts"]
    found: dict[str, list[np.ndarray]] = {}
    have: dict[str, int] = {}
    for r in sorted(cut.where("drawn").select(wanted).unionByName(least.select(wanted)).collect(), key=lambda r: (r["lang"], r["long"], r["draw"], r["texts"])):
        for text in r["texts"]:
            if have.get(r["lang"], 0) < sample:
                data = np.frombuffer(text.encode(), np.uint8)
                value = np.append(0, symbols(data, np.array([0, len(data)]))[0])
                found.setdefault(r["lang"], []).append(value)
                have[r["lang"]] = have.get(r["lang"], 0) + len(value)
    return {k: np.concatenate(v)[:sample].astype(np.int32) for k, v in found.items()}


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict_udf(spark, parser: Parser):
    """UDF text -> language and score: the runner-up's share of the two least costs."""
    shared = spark.sparkContext.broadcast(parser)

    @F.arrow_udf(PREDICTED)
    def predict(text: pa.Array) -> pa.Array:
        parser = shared.value
        names, scores = [], []
        for low, high, data, at in chunks(text, (1 << 21) - (1 << 12)):
            value, ends = symbols(data, at)
            lettered = _has_letters(text, low, data, at)
            if not parser.languages:
                best, score = np.zeros(high - low, np.int64), np.zeros(high - low)
                lettered[:] = False
            else:
                cost = parser.phrases(value, ends) * parser.cost
                best = cost.argmin(1)
                two = np.sort(cost, 1)[:, :2]
                score = two[:, 1] / np.maximum(two.sum(1), 1e-300) if two.shape[1] == 2 else np.ones(len(two))
            names += [parser.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
            scores.append(np.where(lettered, score, 0.0))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["lang_pred", "score"])

    return predict


def _has_letters(text: pa.Array, low: int, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(_LETTER[data]))
    out = sums[at[1:]] > sums[at[:-1]]
    for i in np.flatnonzero(~out & (np.diff(at) > 0)).tolist():
        out[i] = any(c.isalpha() for c in text[low + i].as_py())
    return out


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> Parser:
    rows = docs.select(column_of(docs, id_col).alias("doc_id"), column_of(docs, text_col).cast("string").alias("text"), column_of(docs, lang_col).cast("string").alias("lang"))
    return build_parser(draw_samples(rows.where(crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT), sample))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learnt from the rows that are not held out."""
    predict = predict_udf(docs.sparkSession, train(docs, id_col, text_col, lang_col, sample))
    doc_id = column_of(docs, id_col)
    out = docs.select(doc_id.alias("doc_id"), (crc_fold(doc_id, FOLDS) == HELD_OUT).alias("held_out"), predict(column_of(docs, text_col).cast("string")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
