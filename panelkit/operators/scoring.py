"""Batch scoring with a linear model given as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.bands import risk_band
from panelkit.operators.quantiles import exact_quantiles


def column_medians(df: DataFrame, cols: list[str]) -> dict[str, Column]:
    """Fit step of median imputation: the exact median of each column, one
    distributed aggregation; the fitted parameters (one number per column)
    come back as literals, like any fitted model's coefficients."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("_x")).select("_x.*")
    med = {r["feature"]: r["median"] for r in
           exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect()}
    return {c: F.lit(med.get(c)).cast("double") for c in cols}


def column_means(df: DataFrame, cols: list[str], filled: dict[str, Column] | None = None) -> dict[str, Column]:
    """Mean of each (optionally imputed) column, fitted in one aggregation
    and returned as literals."""
    exprs = [(filled[c] if filled else F.col(c)).alias(c) for c in cols]
    row = df.select(*exprs).agg(*[F.avg(c).alias(c) for c in cols]).first()
    return {c: F.lit(row[c]).cast("double") for c in cols}


def linear_score(df: DataFrame, weights: dict[str, float], intercept: float,
                 fill: dict[str, Column] | None = None) -> Column:
    """ŷ = b + Σ w_j · x_j, missing x_j replaced by ``fill[j]`` (medians,
    or 0 when ``fill`` maps to literals)."""
    total = F.lit(float(intercept))
    for c, w in weights.items():
        x = F.col(c).cast("double")
        if fill is not None:
            x = F.coalesce(x, fill[c])
        total = total + F.lit(float(w)) * x
    return total


def score_panel(df: DataFrame, keys: list[str], target: str, weights: dict[str, float], intercept: float,
                low: float, high: float, impute: str = "median") -> DataFrame:
    """Prediction clipped at 0 (F11), residual from the unclipped value,
    actual and predicted bands (F5, predicted band from the unclipped value)."""
    cols = list(weights)
    fill = column_medians(df, cols) if impute == "median" else {c: F.lit(0.0) for c in cols}
    raw = linear_score(df, weights, intercept, fill)
    y = F.col(target)
    return df.select(*keys, y.alias(target), raw.alias("_raw")).select(
        *keys, target, F.greatest(F.col("_raw"), F.lit(0.0)).alias("prediccion"),
        (y - F.col("_raw")).alias("residuo"), risk_band(y, low, high).alias("riesgo_real"),
        risk_band(F.col("_raw"), low, high).alias("riesgo_predicho"))
