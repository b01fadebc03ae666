"""Passages that repeat: a sparse suffix array over words.

Only suffixes at content-selected positions are kept: a position is selected
if the hash of its ``GRAM`` words is the least of some ``window`` consecutive
ones (a minimiser). Any run of ``least_words`` words holds ``window`` whole
grams, so two texts that share such a run select the same position within its
first ``window`` words, and share at least ``least_words - window + 1`` words
from there on. The kept suffixes are brought in order of that many words (as a
64-bit hash); one whose neighbour in the order is equal is an anchor.

From every anchor the match is extended to both sides: each run of
``least_words`` words that starts at most ``window - 1`` words to the left is
compared with its equals elsewhere. Runs found in two places are repeats;
overlapping ones join to maximal passages. The place in the document with the
smallest id (in it, the first) stays. Both comparisons are aggregations with
partial sums and joins that split hot keys, so a passage in a third of all
documents meets in no single task.

Equal whole texts of ``least_words`` words or more are one passage from end to
end; of them only that with the smallest id takes part in the extension.

Defined results: null, empty and short texts have no passages. Repeats within a
text count. Rows that agree in id and text are one document. Null ids sort
last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ROW, column_of, packed, stage
from .textarrays import chunks, mix, span_hash, word_bounds

LEAST_WORDS = 50
GRAM = 5
WINDOW = 36
_U = np.uint64


def _run_hash(word: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    return span_hash(word, first, first + size)


def _stretch(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (least or greatest) of every ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def selected(word: np.ndarray, doc: np.ndarray, least_words: int, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Selected word positions and the hash of the words from there that a shared run must hold."""
    reach = least_words - window + 1
    grams = len(word) - gram + 1
    if grams < window:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    rank = _run_hash(word, np.arange(grams), gram)
    least = _stretch(rank, window, np.minimum)
    # a stretch must lie in one text; a position is selected if it has the least
    # value of a stretch around it, that is if the greatest of those leasts is its own
    least = np.where(doc[:len(least)] == doc[window + gram - 2:], least, _U(0))
    edge = np.zeros(window - 1, _U)
    spot = np.flatnonzero(_stretch(np.concatenate([edge, least, edge]), window, np.maximum) == rank)
    spot = spot[spot + reach <= len(word)]
    spot = spot[doc[spot] == doc[spot + reach - 1]]
    return spot, _run_hash(word, spot, reach)


def _parts(arrays: list[pa.Array], names: list[str], size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(arrays, names)
    for low in range(0, len(whole), size):
        yield whole.slice(low, size)


def _salted(key: np.ndarray, owner: np.ndarray, pos: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their kind in their text (``owner``): 0 once, 1 the first of several, 2 a later one,
    whose key is made its own: it is a repeat whatever other texts hold, and a text full of one run is no hot key."""
    order = np.lexsort((key, owner))
    again = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    kind = np.zeros(len(key), np.int8)
    kind[order[:-1][again]] = 1
    kind[order[1:][again]] = 2
    return np.where(kind == 2, mix(key ^ mix(salt.astype(_U)) ^ mix(pos.astype(_U) + _U(1))), key), kind


def kept_suffixes(texts: DataFrame, least_words: int, gram: int, window: int) -> DataFrame:
    """(doc, pos, key, kind): every selected suffix of every text, and for every text
    of ``least_words`` words or more a row with its number of words as ``pos`` and no
    key. ``kind`` and salt as in ``candidate_runs``."""
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, at in chunks(batch.column(1)):
                starts, ends, doc = word_bounds(data, at)
                base = np.searchsorted(doc, np.arange(high - low + 1))
                spot, key = selected(span_hash(data, starts, ends), doc, least_words, gram, window)
                length = np.diff(base)
                long = np.flatnonzero(length >= least_words)
                place = spot - base[doc[spot]]
                key, kind = _salted(key, doc[spot], place, doc[spot])
                owner = batch.column(0).take(pa.array(np.concatenate([doc[spot], long]) + low))
                pos = np.concatenate([place, length[long]]).astype(np.int32)
                keys = pa.concat_arrays([pa.array(key.view(np.int64)), pa.nulls(len(long), pa.int64())])
                yield from _parts([owner, pa.array(pos), keys, pa.array(np.append(kind, np.zeros(len(long), np.int8)))], ["doc", "pos", "key", "kind"])

    schema = T.StructType([texts.schema["doc"], T.StructField("pos", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("kind", T.ByteType())])
    return texts.select("doc", "text").mapInArrow(select, schema)


def candidate_runs(texts: DataFrame, least_words: int, window: int) -> DataFrame:
    """(h, no, pos, kind): every run of ``least_words`` words that starts at most
    ``window - 1`` words before an anchor. ``kind``: 0 once in its text, 1 the
    first of several there, 2 a later one (with salted ``h``).
    ``texts`` has (no, text, spots)."""
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, spots = batch.column(0).to_numpy(), batch.column(2)
            for low, high, data, at in chunks(batch.column(1)):
                starts, ends, doc = word_bounds(data, at)
                word = span_hash(data, starts, ends)
                base = np.searchsorted(doc, np.arange(high - low + 1))
                mine = spots.slice(low, high - low)
                spot = mine.flatten().to_numpy(zero_copy_only=False) + np.repeat(base[:-1], np.diff(mine.offsets.to_numpy()))
                edge = np.zeros(len(word) + 1, np.int64)
                np.add.at(edge, np.maximum(spot - window + 1, base[doc[spot]]), 1)
                np.add.at(edge, spot + 1, -1)
                first = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                first = first[first + least_words <= len(word)]
                first = first[doc[first] == doc[first + least_words - 1]]
                h, owner = _run_hash(word, first, least_words), doc[first]
                pos, no = first - base[owner], number[owner + low]
                h, kind = _salted(h, owner, pos, no)
                yield from _parts([pa.array(h.view(np.int64)), pa.array(no), pa.array(pos.astype(np.int32)), pa.array(kind)], ["h", "no", "pos", "kind"])

    return texts.select("no", "text", "spots").mapInArrow(extend, "h long, no long, pos int, kind tinyint")


SPANS = "array<struct<start: int, end: int>>"


def _joined(starts: np.ndarray, least_words: int) -> list[dict]:
    """Maximal spans covered by runs of ``least_words`` words from the given starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > least_words)
    return [{"start": int(a), "end": int(b) + least_words}
            for a, b in zip(starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)])]


def _spans_udf(least_words: int):
    """Starts of repeated runs (twice the start, plus one where the run stays) -> repeated and removed spans."""
    @F.arrow_udf(f"struct<repeated: {SPANS}, removed: {SPANS}>")
    def spans(runs: pa.Array) -> pa.Array:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        found = [np.sort(np.array(x.values)) for x in runs]
        return pa.StructArray.from_arrays(
            [pa.array([_joined(x >> 1, least_words) for x in found], span),
             pa.array([_joined(x[x & 1 == 0] >> 1, least_words) for x in found], span)], names=["repeated", "removed"])

    return spans


def _identity(doc_id: Column, text: Column) -> Column:
    """Struct that orders documents: null ids last, then by id, then by text hash."""
    return F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.xxhash64(text).alias("tie"))


def find_passages(texts: DataFrame, least_words: int = LEAST_WORDS, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``texts`` has (doc, text), ``doc`` from ``_identity``. Returns (doc, n_words,
    repeated, removed): a row per document with a repeated passage, spans as word
    numbers [start, end); ``removed`` are the repeats that another place stands for."""
    if gram > least_words - window + 1:
        raise ValueError("least_words - window + 1 must be at least gram")
    kept = stage(kept_suffixes(texts, least_words, gram, window), "suffixes")

    # equal whole texts
    whole = kept.where("key IS NULL").select("doc", F.col("pos").alias("n_words")).distinct()
    whole = stage(whole.withColumn("tie", F.col("doc.tie")), "texts")
    groups = whole.groupBy("tie", "n_words").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("copies"))
    copies = whole.join(groups.where("copies > 1"), ["tie", "n_words"])
    spare = copies.where("doc <> first").select("doc")

    # anchors of the texts that stay, numbered in the documents' order
    suffixes = kept.where("key IS NOT NULL")
    shared = suffixes.where("kind < 2").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("kind").alias("kinds"))
    shared = shared.where("n > 1 OR kinds = 1").select("key", "n")
    anchors = suffixes.join(shared, "key", "left").where("n IS NOT NULL OR kind = 2").groupBy("doc").agg(F.collect_set("pos").alias("spots"))
    anchors = anchors.join(spare, "doc", "left_anti").orderBy("doc").withColumn("no", F.monotonically_increasing_id())
    anchors = stage(anchors, "anchors")

    runs = candidate_runs(anchors.join(texts, "doc"), least_words, window)
    places = runs.where("kind < 2").groupBy("h").agg(F.min("no").alias("least"), F.max("no").alias("most"), F.max("kind").alias("kinds"))
    places = places.where("least < most OR kinds = 1").select("h", "least")
    stays = F.when((F.col("no") == F.col("least")) & (F.col("kind") < 2), 1).otherwise(0)
    found = runs.join(places, "h", "left").where("least IS NOT NULL OR kind = 2").groupBy("no").agg(F.collect_set(2 * F.col("pos") + stays).alias("runs"))
    found = found.select("no", _spans_udf(least_words)("runs").alias("s")).join(anchors.select("no", "doc"), "no")
    found = found.join(whole.select("doc", "n_words"), "doc").select("doc", "n_words", "s.repeated", "s.removed")

    end_to_end = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end"))).cast(SPANS)
    nothing = F.array().cast(SPANS)
    copies = copies.select("doc", "n_words", end_to_end.alias("repeated"),
                           F.when(F.col("doc") == F.col("first"), nothing).otherwise(end_to_end).alias("removed"))
    a, b = copies.alias("a"), found.alias("b")
    pick = lambda name, *order: F.coalesce(*(F.col(f"{x}.{name}") for x in order)).alias(name)
    return a.join(b, F.col("a.doc") == F.col("b.doc"), "full").select(
        pick("doc", "a", "b"), pick("n_words", "a", "b"), pick("repeated", "a", "b"), pick("removed", "b", "a"))


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(doc_id, n_words, n_repeated, n_removed, repeated, removed) of every document with a repeated passage."""
    text = column_of(docs, text_col).cast("string")
    texts = docs.select(_identity(column_of(docs, id_col), text).alias("doc"), text.alias("text"))
    covered = lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["end"] - x["start"])
    return find_passages(texts, **params).select(
        F.col("doc.id").alias("doc_id"), "n_words", covered("repeated").alias("n_repeated"),
        covered("removed").alias("n_removed"), "repeated", "removed")


@F.arrow_udf(T.StringType())
def _without(text: pa.Array, removed: pa.Array) -> pa.Array:
    """The text without the words of the removed spans (and the space after each)."""
    out = []
    for value, spans in zip(text, removed):
        if not spans.is_valid:
            out.append(None)
            continue
        raw = (value.as_py() or "").encode()
        data = np.frombuffer(raw, np.uint8)
        starts, _, _ = word_bounds(data, np.array([0, len(data)]))
        starts = np.append(starts, len(data))
        parts, low = [], 0
        for span in spans.as_py():
            parts.append(raw[low:starts[span["start"]]])
            low = starts[span["end"]]
        out.append(b"".join([*parts, raw[low:]]).decode())
    return pa.array(out, pa.string())


def trim_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **params) -> DataFrame:
    """``docs`` with repeated passages cut out of the texts but at their first
    place, and ``length_col`` (if there is one) brought up to date. A row of which
    no word is left goes; rows without passages are unchanged."""
    text = column_of(docs, text_col).cast("string")
    doc = _identity(column_of(docs, id_col), text)
    rows = packed(docs, doc=doc)
    cuts = find_passages(docs.select(doc.alias("doc"), text.alias("text")), **params).where(F.size("removed") > 0).select("doc", "n_words", "removed")
    rows = rows.join(cuts, "doc", "left")
    gone = F.aggregate("removed", F.lit(0), lambda n, x: n + x["end"] - x["start"]) >= F.col("n_words")
    rows = rows.where(F.col("removed").isNull() | ~gone)
    # only texts with a cut are sent through Python
    old = F.col(ROW).getField(text_col)
    new = _without(F.when(F.col("removed").isNotNull(), old.cast("string")), F.col("removed"))
    rows = rows.withColumn("cut", new)
    out = []
    for f in docs.schema.fields:
        c = F.col(ROW).getField(f.name)
        if f.name == text_col:
            c = F.when(F.col("removed").isNull(), c).otherwise(F.col("cut"))
        elif f.name == length_col:
            c = F.when(F.col("removed").isNull(), c).otherwise(F.length("cut").cast(f.dataType))
        out.append(c.alias(f.name))
    return rows.select(*out)
