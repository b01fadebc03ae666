"""Hyper-parameter search (M8) and the final model with its importances.

A search draws parameter maps from a grid without replacement, by a seed, and
scores each by the RMSE over inner folds that a hash of the row key deals, so
the same rows fall into the same folds wherever they are stored.  Fits run as
concurrent Spark jobs over rows that are written once.  In the nested form every
outer fold (a period) searches on its own training rows, imputed with their own
medians, and predicts its period with the model refitted on them.
"""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.evaluate import FOLD, boosting, gathered, fold_gram_by_period, fold_medians, null_columns, periods_of, _standardised
from panelkit.operators.quantiles import exact_quantiles
from panelkit.session import materialize

# The search spaces of plain boosting (five axes) and of boosting on shares of rows and features (six axes).
GRIDS = {
    "GradientBoosting": {
        "stepSize": [0.01, 0.03, 0.05, 0.08],
        "maxIter": [100, 200, 300],
        "maxDepth": [3, 4, 5],
        "minInstancesPerNode": [3, 4, 6],
        "subsamplingRate": [0.8, 0.9, 1.0],
    },
    "BoostingMuestreado": {
        "stepSize": [0.01, 0.03, 0.05, 0.08],
        "maxIter": [100, 200, 300],
        "maxDepth": [3, 4, 5],
        "minInstancesPerNode": [2, 3, 4],
        "subsamplingRate": [0.8, 0.9, 1.0],
        "featureSubsetStrategy": ["0.7", "0.8", "all"],
    },
}
#: Draws and inner folds of a search, and the seed of both.
DRAWS, INNER, SEED = 30, 5, 42


def draw(grid: dict, n: int = DRAWS, seed: int = SEED) -> list[dict]:
    """``n`` different parameter maps of the grid (all, if it has fewer)."""
    combos = list(itertools.product(*grid.values()))
    return [dict(zip(grid, c)) for c in random.Random(seed).sample(combos, min(n, len(combos)))]


def dealt(df: DataFrame, keys: list[str], folds: int = INNER, seed: int = SEED) -> DataFrame:
    """``df`` with its inner fold."""
    return df.withColumn("_inner", F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int"))


def search(data: DataFrame, estimator, grid: dict, keys: list[str], target: str, draws: int = DRAWS, folds: int = INNER,
           seed: int = SEED, parallelism: int = 8) -> tuple:
    """Best fitted model, its parameters and a list of (parameters, rmse) of all draws.
    ``data``, a materialised table, has the estimator's feature column; ties go to the earlier draw."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator
    picked = draw(grid, draws, seed)
    maps = [{estimator.getParam(a): v for a, v in m.items()} for m in picked]
    score = RegressionEvaluator(labelCol=target, predictionCol=estimator.getPredictionCol(), metricName="rmse")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=score, numFolds=folds, foldCol="_inner", parallelism=parallelism)
    fitted = cv.fit(dealt(gathered(data), keys, folds, seed))
    best = int(np.argmin(fitted.avgMetrics))
    return fitted.bestModel, picked[best], list(zip(picked, map(float, fitted.avgMetrics)))


def _assembled(df: DataFrame, features: list[str], medians: dict) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    filled = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(medians.get(f)).cast("double")) for f in features})
    return VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep").transform(filled)


def lopo_tuned(df: DataFrame, features: list[str], target: str, period: str, keys: list[str], make=boosting,
               grid: dict = GRIDS["GradientBoosting"], draws: int = DRAWS, inner: int = INNER, seed: int = SEED,
               folds: list[str] | None = None, at_once: int = 4) -> tuple[DataFrame, DataFrame]:
    """M8 inside M9: (keys, fold, real, predicho) and a row per (fold, draw) with its
    parameters as JSON, its inner RMSE and whether it was chosen.  ``at_once`` outer folds search together."""
    import json
    spark = df.sparkSession
    folds = folds or periods_of(df, period)
    holes = null_columns(df, features)
    medians: dict = {}
    for r in (fold_medians(df, holes, period, folds).collect() if holes else []):  # folds x features numbers
        medians.setdefault(r[FOLD], {})[r["feature"]] = r["median"]
    kept = list(dict.fromkeys([*keys, period]))
    rows = materialize(df.select(*kept, target, *features).where(F.col(target).isNotNull()))

    def one(k: str):
        train = materialize(_assembled(rows.where(F.col(period) != k), features, medians.get(k, {})).select(*kept, target, "_features"))
        model, chosen, tried = search(train, make(featuresCol="_features", labelCol=target, predictionCol="_pred"), grid, keys, target, draws, inner, seed)
        test = _assembled(rows.where(F.col(period) == k), features, medians.get(k, {}))
        return model.transform(test).withColumn(FOLD, F.lit(k)), [(k, json.dumps(m), s, m == chosen) for m, s in tried]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        parts = list(pool.map(one, folds))
    out = reduce(DataFrame.unionByName, [p for p, _ in parts])
    trials = spark.createDataFrame([t for _, ts in parts for t in ts], f"{FOLD} string, parametros string, rmse double, elegido boolean")
    return out.select(*keys, FOLD, F.col(target).alias("real"), F.greatest(F.col("_pred"), F.lit(0.0)).alias("predicho")), trials


def _medians(df: DataFrame, features: list[str]) -> dict:
    long = df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features))).alias("x")).select("x.*")
    return {r["feature"]: r["m"] for r in exact_quantiles(long, ["feature"], "value", {"m": 0.5}).collect()}  # one number per feature


def linear_importances(df: DataFrame, features: list[str], target: str, kind: str = "ridge", alpha: float | None = None) -> dict[str, float]:
    """M12 for linear models: absolute weights over standardised features, fitted on all rows imputed with their medians."""
    from panelkit.operators.evaluate import lasso_from_gram, ridge_from_gram
    spark = df.sparkSession
    med = _medians(df, features)
    table = spark.createDataFrame([("final", f, float(m)) for f, m in med.items()], f"{FOLD} string, feature string, median double")
    stats = fold_gram_by_period(df.withColumn("_all", F.lit("rows")), features, target, "_all", ["final"], table)["final"]
    fit = ridge_from_gram(stats, 1.0 if alpha is None else alpha) if kind == "ridge" else lasso_from_gram(stats, 0.1 if alpha is None else alpha)
    return dict(zip(features, np.abs(fit[1] * _standardised(stats)[2]).tolist()))


def final_tuned(df: DataFrame, features: list[str], target: str, keys: list[str], make=boosting, grid: dict = GRIDS["GradientBoosting"],
                draws: int = DRAWS, inner: int = INNER, seed: int = SEED):
    """Search and refit on all rows; the model, its parameters, the trials and its importances."""
    data = materialize(_assembled(df.where(F.col(target).isNotNull()), features, _medians(df, features)).select(*keys, target, "_features"))
    model, chosen, tried = search(data, make(featuresCol="_features", labelCol=target, predictionCol="_pred"), grid, keys, target, draws, inner, seed)
    return model, chosen, tried, dict(zip(features, model.featureImportances.toArray().tolist()))


def importance_table(spark, per_model: dict[str, dict[str, float]]) -> DataFrame:
    """(modelo, feature, importancia, puesto): one table over linear and tree models, largest first (ties by name)."""
    rows = []
    for model, imp in per_model.items():
        ranked = sorted(imp.items(), key=lambda kv: (-kv[1], kv[0]))
        rows += [(model, f, float(v), i + 1) for i, (f, v) in enumerate(ranked)]
    return spark.createDataFrame(rows, "modelo string, feature string, importancia double, puesto int")
