"""Parquet table access with NaN normalisation.

Spark has NULL and NaN; the panel model has one missing value.  Every reader
here turns NaN into NULL so that ``avg``/``max``/``last(ignorenulls)`` behave
like the missing-value semantics the operators assume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelkit.session import sf_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column (plan-time column choice)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders`` reads one parquet table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._derived: dict[str, DataFrame] = {}

    def derived(self, name: str, build) -> DataFrame:
        """A small aggregate of the facts (panel grain), materialised once
        for this accessor so every plan that needs it reads the same result
        instead of re-scanning the facts with a differently pruned plan."""
        if name not in self._derived:
            from panelkit.session import materialize
            self._derived[name] = materialize(build())
        return self._derived[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = nan_to_null(self.spark.read.parquet(sf_path(self.sf_dir, name)))
        return self._cache[name]
