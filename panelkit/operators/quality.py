"""Data-quality reports (Q1-Q3): one aggregation per table, unpivoted to
(check, passed, observed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.spec import DEFAULT_SPEC, PanelSpec


def _report(df: DataFrame, checks: list[tuple[str, F.Column, F.Column]], static=()) -> DataFrame:
    one = df.agg(*[x.alias(f"_p{i}") for i, (_, x, _) in enumerate(checks)],
                 *[o.cast("string").alias(f"_o{i}") for i, (_, _, o) in enumerate(checks)])
    rows = [F.struct(F.lit(n).alias("check"), F.col(f"_p{i}").alias("passed"), F.col(f"_o{i}").alias("observed"))
            for i, (n, _, _) in enumerate(checks)]
    rows += [F.struct(F.lit(n).alias("check"), F.lit(p).alias("passed"), F.lit(o).alias("observed")) for n, p, o in static]
    return one.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def panel_quality(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, min_entities: int = 10, min_periods: int = 5) -> DataFrame:
    """Q1: required columns (plan time), non-empty, entity/period counts,
    rate range, members present, labour force >= 0, unique key, no NaN."""
    req = [spec.entity, spec.period, spec.year, spec.target, spec.labour_force]
    missing = [c for c in req if c not in df.columns]
    n = F.count(F.lit(1))
    rate, pea = F.col(spec.target), F.col(spec.labour_force)
    key = F.struct(*[F.col(c) for c in spec.key if c in df.columns])
    members = F.array_sort(F.collect_set(spec.area))
    sexes = F.array_sort(F.collect_set(spec.sex))
    checks = [
        ("no_vacio", n > 0, n),
        ("min_entidades", F.count_distinct(spec.entity) >= min_entities, F.count_distinct(spec.entity)),
        ("min_periodos", F.count_distinct(spec.period) >= min_periods, F.count_distinct(spec.period)),
        ("tasa_en_rango", F.coalesce(F.bool_and(rate.between(0, 100)), F.lit(True)), F.count_if(~rate.between(0, 100))),
        ("pea_no_negativa", F.coalesce(F.bool_and(pea >= 0), F.lit(True)), F.min(pea)),
        ("areas_presentes", F.size(F.array_except(F.array(*[F.lit(x) for x in (spec.total, spec.urban, spec.rural)]), members)) == 0,
         F.array_join(members, ",")),
        ("sexos_presentes", F.size(F.array_except(F.array(*[F.lit(x) for x in (spec.total, spec.men, spec.women)]), sexes)) == 0,
         F.array_join(sexes, ",")),
        ("clave_unica", F.count_distinct(key) == n, n - F.count_distinct(key)),
        ("sin_nan", F.count_if(F.isnan(rate)) == 0, F.count_if(F.isnan(rate))),
    ]
    return _report(df, checks, [("columnas_requeridas", not missing, ",".join(missing) or "ok")])


def feature_quality(features: DataFrame, panel_cols: int, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Q2: more columns than the panel, lags/interactions/dummies exist,
    the post-era flag is binary."""
    cols = features.columns
    static = [("mas_columnas", len(cols) > panel_cols, str(len(cols))),
              ("tiene_lags", any(c.endswith("_lag1") for c in cols), str(sum(c.endswith("_lag1") for c in cols))),
              ("tiene_interacciones", any(c.startswith("lag_x_") for c in cols), str(sum(c.startswith("lag_x_") for c in cols))),
              ("tiene_dummies", any(c.startswith("prov_") for c in cols), str(sum(c.startswith("prov_") for c in cols)))]
    flag = F.col("post_covid") if "post_covid" in cols else F.lit(0)
    checks = [("post_covid_binaria", F.coalesce(F.bool_and(flag.isin(0, 1)), F.lit(True)),
               F.array_join(F.array_sort(F.collect_set(flag.cast("string"))), ","))]
    return _report(features, checks, static)


def prediction_quality(preds: DataFrame, summary: DataFrame, accuracy: float | None = None,
                       min_models: int = 2, max_rmse: float = 5.0, required: list[str] | None = None) -> DataFrame:
    """Q3: predictions >= 0, model count, R² > 0 and RMSE below a bound for
    the best model; with ``accuracy``, risk accuracy > 0.5; with ``required``, the columns of the predictions."""
    p = _report(preds, [("predicciones_no_negativas", F.coalesce(F.bool_and(F.col("prediccion") >= 0), F.lit(True)),
                         F.count_if(F.col("prediccion") < 0))])
    s = _report(summary, [("min_modelos", F.count(F.lit(1)) >= min_models, F.count(F.lit(1))),
                          ("r2_positivo", F.max("r2") > 0, F.format_string("%.4f", F.max("r2"))),
                          ("rmse_acotado", F.min("rmse") < max_rmse, F.format_string("%.4f", F.min("rmse")))])
    out = p.unionByName(s)
    if required is not None:
        missing = [c for c in required if c not in preds.columns]
        out = out.unionByName(out.sparkSession.createDataFrame(
            [("columnas_requeridas", not missing, ",".join(missing) or "ok")], "check string, passed boolean, observed string"))
    if accuracy is not None:
        out = out.unionByName(out.sparkSession.createDataFrame(
            [("precision_riesgo", accuracy > 0.5, str(round(accuracy, 4)))], "check string, passed boolean, observed string"))
    return out
