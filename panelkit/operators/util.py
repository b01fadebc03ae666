"""Small shared helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def fitted(df: DataFrame, **aggs: Column) -> dict:
    """Run one aggregation and return its values as plain numbers.

    For a handful of statistics an operator needs as constants (fences,
    ranges, means): one small job whose result is bounded by the number of
    statistics, instead of a scalar subquery that every reference would plan
    again."""
    row = df.agg(*[c.alias(n) for n, c in aggs.items()]).first()
    return {n: row[n] for n in aggs}
