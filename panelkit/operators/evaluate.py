"""Leave-one-period-out model evaluation.

Layout of the work:

* Fold statistics — exact medians, mean/population std, and for linear models
  the full Gram matrix — come from counts and moments per period: a fold is
  all periods without its own, so no row is repeated per fold.
* Linear models (ridge, lasso) are solved on the driver from the per-fold
  Gram matrices: F×F numbers per fold, independent of the row count.
* Tree models are Spark ML estimators fitted per fold on the imputed rows,
  which are checkpointed once; folds run as concurrent jobs.
* Predictions are applied as a join of test rows to a long model table
  (fold, feature, coefficient), so no per-fold expression is compiled.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.bands import risk_band
from panelkit.operators.quantiles import medians_without
from panelkit.operators.util import fitted
from panelkit.session import materialize

FOLD = "fold"


def periods_of(df: DataFrame, period: str) -> list[str]:
    """Sorted distinct periods (bounded by the calendar)."""
    return sorted(r[0] for r in df.select(period).distinct().collect() if r[0] is not None)


def lopo_split(df: DataFrame, period: str) -> DataFrame:
    """M9: one fold per period: test = that period, train = the rest."""
    n = df.groupBy(period).agg(F.count(F.lit(1)).alias("n_test"))
    total = df.select(F.count(F.lit(1))).scalar()
    return n.select(F.col(period).alias(FOLD), (total - F.col("n_test")).alias("n_train"), "n_test")


def _long(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    return df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
    ])).alias("_x")).select(*keys, "_x.*")


def fold_medians(df: DataFrame, features: list[str], period: str, folds: list[str]) -> DataFrame:
    """M1: exact median of every feature over each fold's training rows,
    (fold, feature, median).  An all-null training column has no row.  A fold's
    counts are all periods' less its own, so rows are not repeated per fold."""
    long = _long(df, [period], features).where(F.col(period).isNotNull())
    return medians_without(long.withColumnRenamed(period, FOLD), ["feature"], "value", FOLD, folds)


def null_columns(df: DataFrame, features: list[str]) -> list[str]:
    """Features with at least one null (one counting job).  Only these
    need fold medians: imputing a complete column is a no-op."""
    row = df.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in features]).first()
    return [f for f in features if row[f]]


def fold_scaler(df: DataFrame, features: list[str], period: str, folds: list[str],
                medians: DataFrame) -> DataFrame:
    """M2: mean and population std of the imputed training features per
    fold; a constant column gets scale 1.

    Counts, means and centred squares per (period, feature) in one pass over the
    rows; a fold puts together those of the other periods, and its median once
    for every missing value.  Nothing is subtracted, so no digits cancel."""
    long = _long(df, [period], features).where(F.col(period).isNotNull())
    per = materialize(long.groupBy(F.col(period).alias("_p"), "feature").agg(
        F.count("value").alias("_n"), F.avg("value").alias("_mean"), (F.var_pop("value") * F.count("value")).alias("_m2"),
        F.count_if(F.col("value").isNull()).alias("_gaps")))
    others = per.withColumn(FOLD, F.explode(F.filter(F.array(*map(F.lit, folds)), lambda k: k != F.col("_p"))))
    gaps = others.groupBy(FOLD, "feature").agg(F.sum("_gaps").alias("_n")).join(medians, [FOLD, "feature"])
    pieces = others.where("_n > 0").select(FOLD, "feature", "_n", "_mean", "_m2").union(
        gaps.where("_n > 0").select(FOLD, "feature", "_n", F.col("median").alias("_mean"), F.lit(0.0).alias("_m2")))
    g = pieces.groupBy(FOLD, "feature").agg(
        F.collect_list(F.struct("_n", "_mean", "_m2")).alias("_l"),  # one entry per period
        F.sum("_n").alias("_all"), (F.sum(F.col("_n") * F.col("_mean")) / F.sum("_n")).alias("media"))
    m2 = F.aggregate("_l", F.lit(0.0), lambda a, x: a + x["_m2"] + x["_n"] * (x["_mean"] - F.col("media")) * (x["_mean"] - F.col("media")))
    sd = F.sqrt(m2 / F.col("_all"))
    return g.select(FOLD, "feature", "media", F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd).alias("escala"))


def fold_gram_by_period(df: DataFrame, features: list[str], target: str, period: str, folds: list[str],
                        medians: DataFrame | None) -> dict:
    """Per-fold sufficient statistics of the imputed training rows: n, Σx, Σxxᵀ,
    Σxy, Σy, Σy², without exploding rows to folds.

    One aggregation per period collects masked sums of values less a reference
    (the column's mean over all rows, kept as ``cx``, ``cy``), so that large
    values with a small spread keep their digits; a fold's training statistics
    are (all periods) − (its own period), and median imputation enters as scalar
    corrections:

      Σx̃ᵢ     = Σ_{xᵢ set} xᵢ + mᵢ·#(xᵢ null)
      Σx̃ᵢx̃ⱼ   = Σ_{both set} xᵢxⱼ + mⱼ·Σ_{xᵢ set, xⱼ null} xᵢ + mᵢ·Σ_{xᵢ null, xⱼ set} xⱼ + mᵢmⱼ·#(both null)
      Σx̃ᵢy    = Σ_{xᵢ set} xᵢy + mᵢ·Σ_{xᵢ null} y

    Null-correction sums are only built for columns that have nulls (one
    small counting job decides).  Work is one pass over the rows, whatever
    the number of folds; the driver receives periods × O(F²) numbers."""
    d = df.select(period, target, *features).where(F.col(target).isNotNull())
    nf = len(features)
    cnt = d.agg(F.avg(target), *[F.count_if(F.col(f).isNull()) for f in features], *[F.avg(F.col(f).cast("double")) for f in features]).first()
    nullable = [i for i in range(nf) if cnt[1 + i]]
    cy, cx = cnt[0] or 0.0, np.array([cnt[1 + nf + i] or 0.0 for i in range(nf)])
    x = [F.col(f).cast("double") - float(cx[i]) for i, f in enumerate(features)]
    y = F.col(target).cast("double") - float(cy)
    miss = {i: x[i].isNull() for i in nullable}
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x[i]).alias(f"s{i}") for i in range(nf)]
    aggs += [F.count(x[i]).alias(f"c{i}") for i in range(nf)]
    aggs += [F.sum(x[i] * y).alias(f"d{i}") for i in range(nf)]
    aggs += [F.sum(x[i] * x[j]).alias(f"a{i}_{j}") for i in range(nf) for j in range(i, nf)]
    aggs += [F.sum(F.when(miss[i], y)).alias(f"e{i}") for i in nullable]
    aggs += [F.sum(F.when(miss[j], x[i])).alias(f"b{i}_{j}") for j in nullable for i in range(nf) if i != j]
    aggs += [F.count_if(miss[i] & miss[j]).alias(f"z{i}_{j}") for i in nullable for j in nullable if i <= j]
    per = {r[period]: r.asDict() for r in d.groupBy(period).agg(*aggs).collect()}
    total = {k: sum((r[k] or 0) for r in per.values()) for k in next(iter(per.values())) if k != period}
    med = {}
    for r in (medians.collect() if medians is not None else []):
        med.setdefault(r[FOLD], {})[r["feature"]] = r["median"]
    out = {}
    for k in folds:
        own = per.get(k, {})
        g = {key: total[key] - (own.get(key) or 0) for key in total}
        n = g["n"]
        m = np.array([med.get(k, {}).get(f, cx[i]) - cx[i] if i in nullable else 0.0 for i, f in enumerate(features)])
        sx = np.array([g[f"s{i}"] + m[i] * (n - g[f"c{i}"]) for i in range(nf)])
        sxy = np.array([g[f"d{i}"] + (m[i] * g[f"e{i}"] if i in nullable else 0.0) for i in range(nf)])
        sxx = np.zeros((nf, nf))
        for i in range(nf):
            for j in range(i, nf):
                v = g[f"a{i}_{j}"]
                if j in nullable and i != j:
                    v += m[j] * g[f"b{i}_{j}"]
                if i in nullable and i != j:
                    v += m[i] * g[f"b{j}_{i}"]
                if i in nullable and j in nullable:
                    v += m[i] * m[j] * g[f"z{i}_{j}"]
                sxx[i, j] = sxx[j, i] = v
        out[k] = {"n": n, "sy": g["sy"], "syy": g["syy"], "sx": sx, "sxy": sxy, "sxx": sxx, "cx": cx, "cy": cy}
    return out


def _standardised(st: dict):
    n = st["n"]
    mu = st["sx"] / n
    ybar = st["sy"] / n
    cov = st["sxx"] - n * np.outer(mu, mu)          # centred Σxxᵀ
    var = np.clip(np.diag(cov) / n, 0, None)
    sd = np.sqrt(var)
    sd[sd == 0] = 1.0
    g = cov / np.outer(sd, sd)                       # Gram of scaled, centred X
    c = (st["sxy"] - n * mu * ybar) / sd             # X_sᵀ (y - ȳ)
    return n, mu + st["cx"], sd, ybar + st["cy"], g, c


def ridge_from_gram(st: dict, alpha: float = 1.0):
    """M3: closed-form ridge on standardised features (intercept free):
    (G + αI) w = c.  Returns raw-scale (intercept, beta)."""
    n, mu, sd, ybar, g, c = _standardised(st)
    w = np.linalg.solve(g + alpha * np.eye(len(c)), c)
    beta = w / sd
    return ybar - float(beta @ mu), beta


def lasso_from_gram(st: dict, alpha: float = 0.1, max_iter: int = 10000, tol: float = 1e-10):
    """M4: coordinate descent on the covariance form of
    (1/2n)||y - Xw||² + α||w||₁ over standardised features."""
    n, mu, sd, ybar, g, c = _standardised(st)
    w = np.zeros(len(c))
    lam = n * alpha
    for _ in range(max_iter):
        delta = 0.0
        for j in range(len(c)):
            if g[j, j] <= 0:
                continue
            rho = c[j] - g[j] @ w + g[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - lam, 0.0) / g[j, j]
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta < tol:
            break
    beta = w / sd
    return ybar - float(beta @ mu), beta


def linear_model_table(spark, fits: dict, features: list[str]) -> DataFrame:
    """Long model table (fold, feature, beta) plus one '__intercept__' row
    per fold — folds × (features + 1) rows."""
    rows = []
    for fold, (b0, beta) in fits.items():
        rows.append((fold, "__intercept__", float(b0)))
        rows += [(fold, f, float(v)) for f, v in zip(features, beta)]
    return spark.createDataFrame(rows, f"{FOLD} string, feature string, beta double")


def apply_linear(df: DataFrame, keys: list[str], features: list[str], model: DataFrame,
                 medians: DataFrame | None, fold_col: str) -> DataFrame:
    """ŷ = b + Σ β_j · coalesce(x_j, median_j): test rows unpivoted and joined
    to the (broadcast, bounded) model table on (fold, feature)."""
    long = _long(df.select(*keys, F.col(fold_col).alias(FOLD), *features), keys + [FOLD], features)
    if medians is not None:
        long = long.join(F.broadcast(medians.select(FOLD, "feature", "median")), [FOLD, "feature"], "left")
        long = long.withColumn("value", F.coalesce("value", "median"))
    m = F.broadcast(model)
    terms = long.join(m, [FOLD, "feature"]).groupBy(*keys, FOLD).agg(F.sum(F.col("beta") * F.col("value")).alias("_s"))
    b0 = m.where(F.col("feature") == "__intercept__").select(FOLD, F.col("beta").alias("_b0"))
    return terms.join(b0, FOLD).select(*keys, FOLD, (F.col("_b0") + F.col("_s")).alias("prediccion_raw"))


def lopo_linear(df: DataFrame, features: list[str], target: str, period: str, keys: list[str],
                kind: str = "ridge", alpha: float | None = None, folds: list[str] | None = None) -> DataFrame:
    """M3/M4 + M9: out-of-fold predictions (keys, fold, real, predicho)."""
    folds = folds or periods_of(df, period)
    holes = null_columns(df, features)
    # folds x (features with nulls) rows, read twice
    med = materialize(fold_medians(df, holes, period, folds)) if holes else None
    stats = fold_gram_by_period(df, features, target, period, folds, med)
    if kind == "ridge":
        fits = {k: ridge_from_gram(s, 1.0 if alpha is None else alpha) for k, s in stats.items()}
    else:
        fits = {k: lasso_from_gram(s, 0.1 if alpha is None else alpha) for k, s in stats.items()}
    model = linear_model_table(df.sparkSession, fits, features)
    test = df.select(*keys, F.col(period).alias("_fold"), target, *features)
    pred = apply_linear(test, keys, features, model, med, "_fold")
    real = test.select(*keys, F.col(target).alias("real"))
    return (pred.join(real, keys).where(F.col("real").isNotNull())
                .select(*keys, FOLD, "real", F.greatest(F.col("prediccion_raw"), F.lit(0.0)).alias("predicho")))


#: Rows of one partition while trees are fitted: every level of every tree is a job over all partitions.
FIT_ROWS = 50_000


def gathered(rows: DataFrame) -> DataFrame:
    """``rows``, a materialised table, in as many partitions as its size asks for."""
    return rows.coalesce(-(-rows.count() // FIT_ROWS) or 1)


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: float | None) -> str:
    """A double, digit for digit, as SQL text."""
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{float(value)!r}' AS DOUBLE)"


def lopo_spark_ml(df: DataFrame, features: list[str], target: str, period: str, keys: list[str], make_estimator,
                  folds: list[str] | None = None, parallelism: int = 8) -> DataFrame:
    """M5-M7 + M11: a Spark ML regressor per fold; folds are fitted as
    concurrent jobs.  Returns (keys, fold, real, predicho).

    The rows are checkpointed once; fold k trains on ``period != k`` and
    tests on ``period == k``, both imputed with fold k's medians (fitted
    parameters: one number per feature), so no per-fold copy of the data is
    built."""
    from functools import reduce

    from pyspark.ml.feature import VectorAssembler

    folds = folds or periods_of(df, period)
    med = {}
    holes = null_columns(df, features)
    for r in (fold_medians(df, holes, period, folds).collect() if holes else []):  # folds x features numbers
        med.setdefault(r[FOLD], {})[r["feature"]] = r["median"]
    kept = list(dict.fromkeys([*keys, period]))
    base = gathered(materialize(df.select(*kept, target, *features).where(F.col(target).isNotNull())))
    va = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")

    def prepared(rows: DataFrame, k: str) -> DataFrame:
        m = med.get(k, {})
        # as SQL text: a driver call per feature and fold, made by all threads in turn, takes longer than the fits' jobs
        filled = rows.selectExpr(*map(quoted, [*kept, target]), *[f"coalesce(CAST({quoted(f)} AS DOUBLE), {literal(m.get(f))}) AS {quoted(f)}" for f in features])
        return va.transform(filled)

    def run(k):
        est = make_estimator(featuresCol="_features", labelCol=target, predictionCol="_pred")
        model = est.fit(prepared(base.where(F.col(period) != k), k))
        return model.transform(prepared(base.where(F.col(period) == k), k)).withColumn(FOLD, F.lit(k))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        parts = list(pool.map(run, folds))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(*keys, FOLD, F.col(target).alias("real"), F.greatest(F.col("_pred"), F.lit(0.0)).alias("predicho"))


def lopo_boosted(df: DataFrame, features: list[str], target: str, period: str, keys: list[str], folds: list[str] | None = None, **params) -> DataFrame:
    """M6/M7 + M11: boosting of all folds together, a job per level of a round.  Returns (keys, fold, real, predicho)."""
    from panelkit.operators.boosting import boosted_folds
    folds = folds or periods_of(df, period)
    med = {}
    holes = null_columns(df, features)
    for r in (fold_medians(df, holes, period, folds).collect() if holes else []):  # folds x features numbers
        med.setdefault(r[FOLD], {})[r["feature"]] = r["median"]
    kept = list(dict.fromkeys([*keys, period]))
    base = gathered(materialize(df.select(*kept, target, *[f for f in features if f not in kept]).where(F.col(target).isNotNull())))
    out = boosted_folds(base, features, target, period, keys, folds, med, **params)
    return out.select(*keys, FOLD, "real", F.greatest(F.col("pred"), F.lit(0.0)).alias("predicho"))


def forest(**kw):
    from pyspark.ml.regression import RandomForestRegressor
    kw.setdefault("featureSubsetStrategy", "all")
    return RandomForestRegressor(numTrees=200, maxDepth=5, minInstancesPerNode=4, seed=42, **kw)


def boosting(**kw):
    """M6: gradient-boosted trees, 150 rounds, depth 3, leaf >= 4, learning rate 0.05."""
    from pyspark.ml.regression import GBTRegressor
    return GBTRegressor(maxIter=150, maxDepth=3, minInstancesPerNode=4, stepSize=0.05, seed=42, **kw)


def boosting_sampled(**kw):
    """M7 re-aimed: boosting whose trees see a share of the rows and of the features."""
    return boosting(subsamplingRate=0.8, featureSubsetStrategy="0.8", **kw)


def cv_metrics(pred: DataFrame, by: list[str], real: str = "real", pred_col: str = "predicho") -> DataFrame:
    """MAE, RMSE, R² per group.  R² is 0 for a one-row test set and,
    for a constant test target, 1 when the fit is exact else 0."""
    y, p = F.col(real), F.col(pred_col)
    g = pred.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.sum((y - p) * (y - p)).alias("_sse"), F.sum(y).alias("_sy"), F.sum(y * y).alias("_syy"),
        F.stddev_pop(y).alias("_sdy"))
    sst = F.col("_sdy") * F.col("_sdy") * F.col("n")
    r2 = (F.when(F.col("n") <= 1, F.lit(0.0))
           .when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
           .otherwise(1 - F.col("_sse") / sst))
    return g.select(*by, "n", "mae", "rmse", r2.alias("r2"))


def cv_summary(metrics: DataFrame, model_col: str = "modelo") -> DataFrame:
    """A21 + T5: unweighted mean of per-period metrics per model, and the
    best model (argmin mean RMSE) flagged."""
    s = metrics.groupBy(model_col).agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"),
                                       F.avg("r2").alias("r2"), F.count(F.lit(1)).alias("n_folds"))
    best = s.select(F.min_by(model_col, F.struct("rmse", model_col))).scalar()
    return s.withColumn("mejor", F.col(model_col) == best)


def with_bands(df: DataFrame, real: str, pred: str, low: float, high: float) -> DataFrame:
    return df.withColumns({"riesgo_real": risk_band(F.col(real), low, high),
                           "riesgo_pred": risk_band(F.col(pred), low, high)})


def risk_accuracy(df: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy overall ('todas') and per true class, with support."""
    hit = (F.col("riesgo_real") == F.col("riesgo_pred")).cast("double")
    per = df.groupBy(*by, "riesgo_real").agg(F.avg(hit).alias("precision"), F.count(F.lit(1)).alias("soporte"))
    allc = df.groupBy(*by).agg(F.avg(hit).alias("precision"), F.count(F.lit(1)).alias("soporte")) \
             .withColumn("riesgo_real", F.lit("todas"))
    return per.unionByName(allc)


# ----------------------------------------------------------- checkable baselines
def _per_period(df: DataFrame, period: str, aggs) -> tuple[DataFrame, dict]:
    per = df.groupBy(period).agg(*aggs)
    names = [c for c in per.columns if c != period]
    tot = fitted(per, **{c: F.sum(c) for c in names})  # a few numbers, not a per-reference subquery
    return per, tot


def lopo_persistence(df: DataFrame, target: str, lag: str, period: str, keys: list[str]) -> DataFrame:
    """Lag-1 persistence: ŷ = previous value, or the fold's training mean of
    the target when there is no previous value.  The training mean is
    (total − period) sums, no row is re-read per fold."""
    d = df.where(F.col(target).isNotNull())
    per, tot = _per_period(d, period, [F.count(F.lit(1)).alias("n"), F.sum(target).alias("sy")])
    fm = per.select(F.col(period).alias(FOLD), ((tot["sy"] - F.col("sy")) / (tot["n"] - F.col("n"))).alias("_mean"))
    out = d.join(F.broadcast(fm), d[period] == fm[FOLD])
    p = F.coalesce(F.col(lag), F.col("_mean"))
    return out.select(*keys, FOLD, F.col(target).alias("real"), F.greatest(p, F.lit(0.0)).alias("predicho"))


def lopo_ols1(df: DataFrame, target: str, x: str, period: str, keys: list[str]) -> DataFrame:
    """One-feature least squares, leave one period out; rows need both values.

    Counts, means and centred co-moments per period (a handful of numbers each)
    come to the driver, and a fold puts those of the other periods together."""
    d = df.where(F.col(target).isNotNull() & F.col(x).isNotNull() & F.col(period).isNotNull())
    y, xv = F.col(target).cast("double"), F.col(x).cast("double")
    per = d.groupBy(F.col(period).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.avg(xv).alias("mx"), F.avg(y).alias("my"),
                                                  F.var_pop(xv).alias("vx"), F.covar_pop(xv, y).alias("vxy")).collect()
    fits = []
    for own in per:
        rest = [r for r in per if r.p != own.p]
        n = sum(r.n for r in rest)
        if not n:
            continue
        mx, my = (sum(r.n * r[m] for r in rest) / n for m in ("mx", "my"))
        sxx = sum(r.n * (r.vx + (r.mx - mx) ** 2) for r in rest)
        sxy = sum(r.n * (r.vxy + (r.mx - mx) * (r.my - my)) for r in rest)
        b = sxy / sxx if sxx > 0 else None
        fits.append((own.p, None if b is None else float(my - b * mx), None if b is None else float(b)))
    fm = df.sparkSession.createDataFrame(fits, f"{FOLD} string, _a double, _b double")
    out = d.join(F.broadcast(fm), d[period] == fm[FOLD])  # a row per period
    p = F.col("_a") + F.col("_b") * xv
    return out.select(*keys, FOLD, F.col(target).alias("real"), F.greatest(p, F.lit(0.0)).alias("predicho"))
