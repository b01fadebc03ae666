"""Training-text pipeline: rejected documents go, one document of each group of
near-duplicates stays, repeated passages are cut, the sources are brought into
the order of their mix, and the texts become token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet and read again. All but the last return
the columns of ``docs``, any clashing or extra ones unchanged. The mix is the
order of the rows by (``slot``, ``source``, ``start_char``, ``mix_key``), rows
without a slot last: files need not be read in the order in which they were
written, so the last stage carries that place, and any stretch of slots has
every source in its target share.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import bpe, mixing, passages, quality_rules, simhash
from panelkit.llm.common import ROW, documents, ready, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: the documents that they do not reject."""
    ready(spark)
    return quality_rules.quality_rules(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component the document with the smallest id."""
    ready(spark)
    return simhash.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: texts without passages of 50 words or more that stand elsewhere."""
    ready(spark)
    return passages.trim_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: all documents, in the order of the mix."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE, in the order of the mix: (doc_id, source, n_tokens, ids, restored, slot, start_char, mix_key);
    ``restored``: the decoded ids are the text. Rows that agree in id, source and text have the place of the first of them."""
    ready(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    row = F.col(ROW)
    ids = decoded.select(row["doc_id"].alias("doc_id"), row["source"].alias("source"), F.size("ids").cast("long").alias("n_tokens"), "ids",
                         (F.col("decoded") == F.coalesce(row["text"], F.lit("")).cast("binary")).alias("restored"),
                         mixing.order_key(row["doc_id"], row["text"].cast("string")).alias("mix_key"))
    places = mixing.schedule(docs).groupBy("key", F.col("source").alias("s")).agg(F.min(F.struct("slot", "start_char")).alias("place"))
    placed = ids.join(places, (F.col("mix_key") == F.col("key")) & F.col("source").cast("string").eqNullSafe(F.col("s")))
    return (placed.select("doc_id", "source", "n_tokens", "ids", "restored", "place.slot", "place.start_char", "mix_key")
            .orderBy(F.col("slot").asc_nulls_last(), "source", "start_char", "mix_key"))


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("suffix_array_dedup", cut_passages),
    ("mixing_sources", mix_sources),
    ("byte_level_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs


#: SQL has no XXH64 with a seed and no Kneser-Ney model; tests hold run() against a brute-force version.
ORACLE_SQL = None
