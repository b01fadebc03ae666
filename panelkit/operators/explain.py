"""Prediction explanations (H1-H7).

* Linear models: exact contributions φ_j = w_j (x_j − mean_j), base =
  f(mean); Σφ + base = f(x) holds row by row.
* Any Spark ML model: sampled permutation Shapley.  Every (row, repetition)
  walks one random feature order from the background (feature means) to the
  row; the F+1 intermediate vectors are scored by the model's own
  ``transform`` (JVM-side), and consecutive differences are the marginal
  contributions.  Work = rows × reps × (F+1) model evaluations, spread over
  the cluster; each (row, rep) window holds F+1 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.scoring import column_means, column_medians
from panelkit.operators.util import fitted


def explain_linear(df: DataFrame, keys: list[str], weights: dict[str, float], intercept: float,
                   impute: str = "median") -> DataFrame:
    """H1 (linear, exact): long table (keys, feature, valor, phi, base)."""
    cols = list(weights)
    fill = column_medians(df, cols) if impute == "median" else {c: F.lit(0.0) for c in cols}
    filled = {c: F.coalesce(F.col(c).cast("double"), fill[c]) for c in cols}
    means = column_means(df, cols, filled)
    base = F.lit(float(intercept))
    for c, w in weights.items():
        base = base + F.lit(float(w)) * means[c]
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), filled[c].alias("valor"),
                 (F.lit(float(w)) * (filled[c] - means[c])).alias("phi")) for c, w in weights.items()
    ])).alias("_e")
    return df.select(*keys, rows).select(*keys, "_e.*").withColumn("base", base)


def explain_global(phi: DataFrame, top: int | None = None) -> DataFrame:
    """H2: mean |φ| per feature, ranked (top-n when asked)."""
    g = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importancia"))
    g = g.orderBy(F.desc("importancia"), "feature")
    return g.limit(top) if top else g


def explain_row(phi: DataFrame, keys: list[str], top: int = 5) -> DataFrame:
    """H3: per row, the ``top`` contributions by |φ| with the running path
    base -> prediction (window per row: F rows)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(F.abs("phi")), "feature")
    r = phi.withColumn("puesto", F.row_number().over(w)).where(F.col("puesto") <= top)
    run = Window.partitionBy(*keys).orderBy("puesto").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return r.withColumn("acumulado", F.col("base") + F.sum("phi").over(run))


# The lines of an explanation.
TEXT_LINES = {"prediction": "Prediccion: %.2f%%", "base": "Valor base (promedio): %.2f%%",
              "top": "Top %d factores que influyen en esta prediccion:", "factor": "  %d. %s: %s la prediccion en %.2f pp"}


def explain_text(phi: DataFrame, keys: list[str], top: int = 5) -> DataFrame:
    """Per row the prediction (base plus all contributions), the base
    value and the ``top`` contributions by size, as lines of text."""
    # all contributions of a row: as many as features
    rows = phi.groupBy(*keys).agg(
        F.max("base").alias("_base"), F.sum("phi").alias("_sum"),
        F.sort_array(F.collect_list(F.struct((-F.abs("phi")).alias("size"), "feature", "phi"))).alias("_l"))

    def line(x, i):
        direction = F.when(x["phi"] > 0, F.lit("aumenta")).otherwise(F.lit("disminuye"))
        return F.format_string(TEXT_LINES["factor"], i + 1, x["feature"], direction, F.abs(x["phi"]))

    text = F.concat(F.array(F.format_string(TEXT_LINES["prediction"], F.col("_base") + F.col("_sum")), F.format_string(TEXT_LINES["base"], F.col("_base")),
                            F.lit(""), F.format_string(TEXT_LINES["top"], F.lit(top))),
                    F.transform(F.slice("_l", 1, top), line))
    return rows.select(*keys, F.array_join(text, "\n").alias("explicacion"))


def importance_compare(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Full outer join of two (feature, importancia) tables, zeros
    filled, each scaled by its own maximum (scalar subqueries)."""
    j = (a.select("feature", F.col("importancia").alias(name_a))
          .join(b.select("feature", F.col("importancia").alias(name_b)), "feature", "full")
          .fillna(0.0, [name_a, name_b]))
    mx = fitted(j, a=F.max(name_a), b=F.max(name_b))
    return j.withColumns({f"{name_a}_rel": F.try_divide(F.col(name_a), F.lit(mx["a"])),
                          f"{name_b}_rel": F.try_divide(F.col(name_b), F.lit(mx["b"]))})


def permutation_shapley(df: DataFrame, keys: list[str], features: list[str], model, reps: int = 8,
                        seed: int = 42, features_col: str = "features") -> DataFrame:
    """H1 (any model, ``reps`` sampled orders a row): (keys, feature, phi) plus f(x) and f(background).

    ``df`` holds imputed numeric features; the background is their mean."""
    from pyspark.ml.functions import array_to_vector
    nf = len(features)
    means = fitted(df, **{c: F.avg(c) for c in features})
    x = F.array(*[F.col(c).cast("double") for c in features])
    bg = F.array(*[F.lit(means[c]).cast("double") for c in features])
    # spread by key before every row becomes reps x (features + 1) rows; the windows below need no further shuffle
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df.select(*keys, x.alias("_x"), bg.alias("_b")).repartition(spread, *keys)
    rep = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("_rep"))
    # random order: rank of a per-(row, rep, feature) hash; _pos[j] = place of feature j
    h = F.transform(F.sequence(F.lit(0), F.lit(nf - 1)),
                    lambda j: F.struct(F.xxhash64(F.lit(seed), F.col("_rep"), *[F.col(k) for k in keys], j).alias("h"),
                                       j.alias("j")))
    order = F.transform(F.array_sort(h), lambda s: s["j"])            # features in visiting order
    rep = rep.withColumn("_order", order)
    rep = rep.withColumn("_pos", F.transform(F.sequence(F.lit(0), F.lit(nf - 1)),
                                             lambda j: F.array_position(F.col("_order"), j) - 1))
    steps = rep.select("*", F.explode(F.sequence(F.lit(0), F.lit(nf))).alias("_t"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(nf - 1)),
                      lambda j: F.when(F.col("_pos")[j] < F.col("_t"), F.col("_x")[j]).otherwise(F.col("_b")[j]))
    steps = steps.withColumn(features_col, array_to_vector(vec))
    scored = model.transform(steps).withColumnRenamed(model.getPredictionCol(), "_f")
    walk = Window.partitionBy(*keys, "_rep")
    w = walk.orderBy("_t")
    ends = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = scored.select(*keys, "_rep", "_t", "_order", (F.col("_f") - F.lag("_f").over(w)).alias("_d"),
                      F.last("_f").over(ends).alias("f_x"), F.first("_f").over(ends).alias("f_base"))
    contrib = d.where(F.col("_t") > 0).withColumn("_j", F.col("_order")[F.col("_t") - 1])
    names = F.array(*[F.lit(c) for c in features])
    phi = contrib.groupBy(*keys, "_j").agg(F.avg("_d").alias("phi"), F.max("f_x").alias("f_x"), F.max("f_base").alias("f_base"))
    return phi.select(*keys, names[F.col("_j")].alias("feature"), "phi", "f_x", "f_base")
