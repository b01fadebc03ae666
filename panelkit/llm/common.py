"""Session and frame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Field that holds a caller's whole row while an operator works beside it, so
#: that columns of any name (clashing ones too) pass through untouched.
ROW = "row"
#: Bytes of one Arrow batch between Spark and a Python worker.
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path, where
    they share it (elsewhere it is shipped with ``--py-files``), and bound the
    Arrow batches by bytes, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder in the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage
    is cut, a lost executor re-reads files, and later readers prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df``, a written table, with a broadcast hint if it has ``most`` rows or
    fewer by count; else as it is, for a shuffled join that splits hot keys."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """One ``row`` struct per input row, next to the operator's own columns."""
    return docs.select(F.struct("*").alias(ROW), *(c.alias(k) for k, c in columns.items()))


def column_of(docs: DataFrame, name: str) -> Column:
    """The column ``name``, whatever characters or dots its name has."""
    return docs["`" + name.replace("`", "``") + "`"]


def crc_fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
