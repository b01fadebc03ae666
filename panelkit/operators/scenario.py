"""What-if scenario scoring in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.bands import risk_band
from panelkit.operators.scoring import column_medians, linear_score
from panelkit.spec import DEFAULT_SPEC, PanelSpec

# The adjustable variables and their (min, max) slider ranges.
SLIDERS = {
    "tasa_desempleo_lag1": (0.0, 20.0),
    "tasa_participacion": (25.0, 95.0),
    "pct_subempleo": (0.0, 45.0),
    "empleo_informal_pct": (30.0, 95.0),
    "pct_universitaria": (0.0, 50.0),
    "pct_empresa_grande": (25.0, 70.0),
    "mediana_salario": (100.0, 900.0),
    "pib_crecimiento": (-20.0, 20.0),
}


def clamp(v, lo: float, hi: float):
    """greatest(lo, least(hi, v)); a missing v ends at ``hi`` (least
    skips nulls), as Python's min/max do with NaN."""
    return F.greatest(F.lit(lo), F.least(F.lit(hi), v))


def what_if(features: DataFrame, scenarios: DataFrame, weights: dict[str, float], intercept: float,
            low: float, high: float, sliders: dict = SLIDERS, spec: PanelSpec = DEFAULT_SPEC,
            impute: str = "zero") -> DataFrame:
    """For each scenario (scenario_id, entity, area, sex, variable, value):
    take the latest-period row of that cell, set every slider variable to
    the clamped override (or the clamped base value), recompute the lag
    interactions and the lagged under-employment, fill missing features
    (0 as in the reference, or training medians), score, band, and compare
    with the actual rate.

    Scenarios are pivoted over the fixed slider list and joined to their
    base rows on the cell key — no cross product.  A scenario whose cell has
    no row in the latest period stays, without values and with ``estado``
    'sin fila base' ('ok' otherwise)."""
    keys = [c for c in (spec.entity, spec.area, spec.sex) if c in features.columns]
    latest = features.select(F.max(spec.period)).scalar()
    base = features.where(F.col(spec.period) == latest).withColumn("_found", F.lit(True))
    names = list(sliders)
    sc = (scenarios.groupBy("scenario_id", *keys).pivot("variable", names).agg(F.max("value"))
                   .select("scenario_id", *keys, *[F.col(n).alias(f"_o_{n}") for n in names]))
    j = sc.join(base, keys, "left").withColumn("_found", F.col("_found").isNotNull())
    new = {}
    for n, (lo, hi) in sliders.items():
        cur = F.col(n).cast("double") if n in features.columns else F.lit((lo + hi) / 2)
        new[n] = F.when(F.col("_found"), clamp(F.coalesce(F.col(f"_o_{n}"), cur), lo, hi))
    j = j.withColumns(new)
    lag = f"{spec.target}_lag1"
    inter = {}
    if "post_covid" in j.columns:
        inter["lag_x_post_covid"] = F.col(lag) * F.col("post_covid")
    if "sexo_mujeres" in j.columns:
        inter["lag_x_sexo_mujeres"] = F.col(lag) * F.col("sexo_mujeres")
    if "area_urbana" in j.columns:
        inter["lag_x_area_urbana"] = F.col(lag) * F.col("area_urbana")
    if "pct_subempleo_lag1" in j.columns:
        inter["pct_subempleo_lag1"] = F.col("pct_subempleo")
    j = j.withColumns(inter)
    cols = list(weights)
    fill = column_medians(features, cols) if impute == "median" else {c: F.lit(0.0) for c in cols}
    pred = F.when(F.col("_found"), linear_score(j, weights, intercept, fill))
    return j.select("scenario_id", *keys, spec.period, F.col(spec.target).alias("tasa_real"),
                    pred.alias("prediccion"), F.when(F.col("_found"), risk_band(pred, low, high)).alias("riesgo"),
                    (pred - F.col(spec.target)).alias("delta"),
                    F.when(F.col("_found"), "ok").otherwise("sin fila base").alias("estado"), *names)


def scenario_values(result: DataFrame, names: list[str]) -> DataFrame:
    """The feature values each scenario used, one row per variable."""
    return (result.select("scenario_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("variable"), F.col(n).alias("valor")) for n in names])).alias("_v"))
        .select("scenario_id", "_v.*").orderBy("scenario_id", "variable"))
