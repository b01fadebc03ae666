"""Exact dedup by content-defined chunk recipes.

A text (A-Z lower-cased, as UTF-8 bytes) is cut into chunks where its own bytes
say so: after ``LEAST`` bytes at the first window of four bytes that lie in four
fixed classes (one window in 256 on even bytes), at ``MOST`` bytes at the latest.
The cut is one regular expression over the bytes, so it works for every script
and for texts without a space, and an insertion moves only the cuts near it.

A chunk's identifier is a tuple of 64-bit hashes. It is verified, not trusted:
the different chunks of the corpus meet once (``distinct``, combined before the
shuffle, so a chunk moves once per task however often it stands there), and if
one identifier names two contents, all identifiers get one hash more and are
verified again. A text's recipe is the ordered list of its identifiers; texts
are equal exactly when their recipes are. Everything after the verification
moves recipes (16 bytes for some 700 of text) and never a text again; no row is
larger than a chunk or a recipe. All of it is DataFrame functions.

Defined results: a null text counts as empty, and empty texts are equal to each
other (their recipe is empty). Of equal texts the row with the largest id stays;
null ids are smaller than all others; of rows equal in text and id exactly one
stays, the last in the order of reading. An empty table gives an empty result.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_of, stage

LEAST, MOST = 512, 8192
#: 64-bit hashes in an identifier before any verification has failed.
HASHES = 2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _byte_class(k: int) -> str:
    """A quarter of all bytes, another quarter for every ``k``."""
    return "[" + "".join(f"\\x{b:02x}" for b in range(256) if (b * 167 + 89 * k) % 256 < 64) + "]"


def chunk_pattern(least: int = LEAST, most: int = MOST) -> str:
    """Shortest run of ``least`` to ``most`` bytes that ends in a cut window; else ``most`` bytes or the rest."""
    window = "".join(map(_byte_class, range(4)))
    return f"(?s).{{{least - 4},{most - 4}}}?{window}|.{{1,{most}}}"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z lower-cased and nothing else (``lower`` does just that on ASCII)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a normalised text in order, one character per byte."""
    return F.regexp_extract_all(F.decode(F.encode(text, "utf-8"), "iso-8859-1"), F.lit(chunk_pattern(least, most)), F.lit(0))


def chunk_id(chunk: Column, hashes: int, bits: int) -> Column:
    """``hashes`` hashes of ``bits`` bits each."""
    return F.struct(*(F.shiftrightunsigned(F.xxhash64(F.lit(k), chunk), 64 - bits).alias(f"h{k}") for k in range(hashes)))


def clashes(docs: DataFrame, text_col: str = "text", hashes: int = HASHES, bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(id): the identifiers that name two or more different chunks."""
    pieces = docs.select(F.explode(chunks(normalised(column_of(docs, text_col)), least, most)).alias("chunk"))
    different = pieces.select(chunk_id(F.col("chunk"), hashes, bits).alias("id"), "chunk").distinct()
    return different.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64, least: int = LEAST, most: int = MOST) -> DataFrame:
    """Per row (row_no, doc_id, text_sha256, recipe), written; the identifiers are verified over all of ``docs``."""
    hashes = HASHES
    while clashes(docs, text_col, hashes, bits, least, most).limit(1).count():
        hashes += 1
    text = normalised(column_of(docs, text_col))
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), column_of(docs, id_col).alias("doc_id"), text.alias("t"))
    return stage(rows.select("row_no", "doc_id", F.sha2("t", 256).alias("text_sha256"),
                             F.transform(chunks(F.col("t"), least, most), lambda c: chunk_id(c, hashes, bits)).alias("recipe")), "recipes")


def groups(written: DataFrame) -> DataFrame:
    """Per row of ``recipes``: row_no, doc_id, keep_id, group_size, kept, text_sha256."""
    shared = written.groupBy("recipe").agg(F.max(F.struct("doc_id", "row_no")).alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(shared, "shared")  # so that the join deals the rows anew, and a large group of copies is split
    rows = written.join(shared, "recipe", "left")
    alone = F.col("n").isNull()
    return rows.select("row_no", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
                       F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                       (alone | (F.col("last.row_no") == F.col("row_no"))).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return groups(recipes(docs, id_col, text_col, **params)).drop("row_no")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged. The rows are written once, so that each has a lasting number."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row_no"), F.struct("*").alias("row")), "rows")
    text = normalised(F.col("row").getField(text_col))
    texts = rows.select(F.struct("row_no", F.col("row").getField(id_col).alias("doc_id")).alias("doc_id"), text.alias("text"))
    # the id of a row is (its own id, its number): the larger id stays, then the later row
    texts = texts.select(F.struct("doc_id.doc_id", "doc_id.row_no").alias("doc_id"), "text")
    gone = exact_duplicates(texts, **params).where("NOT kept").select("doc_id.row_no")
    return rows.join(gone, "row_no", "left_anti").select("row.*")
