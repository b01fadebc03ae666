"""Feature operators.

Every operator is ``DataFrame -> DataFrame`` and chooses its columns at plan
time from the schema ("optional column" contract: a missing input column
skips the feature instead of failing).

All series operators share one window spec (partition by entity[, area]
[, sex], order by period), so consecutive fills/lags/deltas are planned as
one exchange and one sort.  Series are short (one row per period), so the
window partitions stay small even when one entity is hot: the key is
(entity, area, sex), unique per period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelkit.operators.util import fitted
from panelkit.spec import DEFAULT_SPEC, PanelSpec


def series_window(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC):
    return Window.partitionBy(*spec.group_cols(df.columns)).orderBy(spec.period)


def contrast_features(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """E1 (J3-J6): urban-rural gap, urban labour-force share, gender gap.

    One conditional aggregation per (entity, period) evaluated as a window
    aggregate: no self-joins, one exchange, row count unchanged.  Requires a
    unique (entity, period, area, sex) key (see quality.key_is_unique).
    """
    cols = df.columns
    if spec.area not in cols and spec.sex not in cols:
        return df
    w = Window.partitionBy(spec.entity, spec.period)
    rate, pea = F.col(spec.target), F.col(spec.labour_force)
    a = F.col(spec.area) if spec.area in cols else F.lit(spec.total)
    s = F.col(spec.sex) if spec.sex in cols else F.lit(spec.total)

    def pick(cond, v):
        return F.max(F.when(cond, v)).over(w)

    out = df
    if spec.area in cols:
        urb = pick((a == spec.urban) & (s == spec.total), rate)
        rur = pick((a == spec.rural) & (s == spec.total), rate)
        pea_urb = pick((a == spec.urban) & (s == spec.total), pea)
        pea_tot = pick((a == spec.total) & (s == spec.total), pea)
        out = out.withColumns({
            "brecha_desempleo_urb_rur": urb - rur,
            "ratio_pea_urbana": F.try_divide(pea_urb.cast("double"), F.nullif(pea_tot, F.lit(0)).cast("double")),
        })
    if spec.sex in cols:
        men = pick((a == spec.total) & (s == spec.men), rate)
        women = pick((a == spec.total) & (s == spec.women), rate)
        out = out.withColumn("brecha_desempleo_genero", women - men)
    return out


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """P10: numeric columns from the schema."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def fill_panel(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, exclude_suffixes=(),
               columns=None, forward_only: bool = False) -> DataFrame:
    """Forward fill then backward fill along each series.

    ``coalesce(x, last non-null so far, first non-null from here on)``.
    Columns with no nulls are unchanged, so filling every numeric column is
    the same as filling only those with nulls (and needs no extra job).
    """
    keys = set(spec.group_cols(df.columns)) | {spec.period}
    cols = columns if columns is not None else numeric_columns(df, exclude=keys)
    cols = [c for c in cols if not any(c.endswith(sfx) for sfx in exclude_suffixes)]
    if not cols:
        return df
    w = series_window(df, spec)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    repl = {}
    for c in cols:
        parts = [F.col(c), F.last(c, ignorenulls=True).over(back)]
        if not forward_only:
            parts.append(F.first(c, ignorenulls=True).over(ahead))
        repl[c] = F.coalesce(*parts)
    return df.withColumns(repl)


def time_features(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, year_range: tuple | None = None) -> DataFrame:
    """Year scaled to [0, 1] over the whole frame (denominator >= 1) and
    the post-era flag.  min/max come from one small aggregation, never a
    global window."""
    y = F.col(spec.year)
    if year_range is None:  # one small aggregation over the input
        lim = fitted(df, lo=F.min(spec.year), hi=F.max(spec.year))
        year_range = (lim["lo"], lim["hi"])
    lo, hi = year_range
    span = max(hi - lo, 1) if lo is not None else 1
    return df.withColumns({
        "anio_norm": (y - F.lit(lo)) / F.lit(span),
        "post_covid": (y >= spec.post_year).cast("int"),
    })


def lag_features(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, cols=None) -> DataFrame:
    """Previous row of the series (by row, not by calendar)."""
    w = series_window(df, spec)
    cols = [c for c in (cols or spec.lag_cols) if c in df.columns]
    return df.withColumns({f"{c}_lag1": F.lag(c, 1).over(w) for c in cols})


def delta_features(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC, cols=None) -> DataFrame:
    """First difference along the series."""
    w = series_window(df, spec)
    cols = [c for c in (cols or spec.delta_cols) if c in df.columns]
    return df.withColumns({f"{c}_delta": F.col(c) - F.lag(c, 1).over(w) for c in cols})


def ratio_features(df: DataFrame) -> DataFrame:
    """Structural ratios; a zero denominator gives null (never inf/NaN)."""
    have = set(df.columns)
    new = {}
    if "empleo_informal_pct" in have:
        new["empleo_formal_pct"] = 100 - F.col("empleo_informal_pct")
    if {"pct_universitaria", "pct_secundaria"} <= have:
        new["educacion_alta"] = F.col("pct_universitaria") + F.col("pct_secundaria")
    if {"pct_sector_terciario", "pct_sector_primario"} <= have:
        new["ratio_terciario_primario"] = F.try_divide(F.col("pct_sector_terciario"),
                                                       F.nullif(F.col("pct_sector_primario"), F.lit(0.0)))
    if {"pct_microempresa", "pct_empresa_grande"} <= have:
        new["ratio_micro_grande"] = F.try_divide(F.col("pct_microempresa"),
                                                 F.nullif(F.col("pct_empresa_grande"), F.lit(0.0)))
    if {"mediana_salario", "pib_per_capita"} <= have:
        new["salario_rel_pib"] = F.try_divide(F.col("mediana_salario"),
                                              F.nullif(F.col("pib_per_capita") / 12, F.lit(0.0)))
    return df.withColumns(new) if new else df


def interaction_features(df: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Lagged target x context flags."""
    lag = f"{spec.target}_lag1"
    if lag not in df.columns:
        return df
    new = {}
    if "post_covid" in df.columns:
        new["lag_x_post_covid"] = F.col(lag) * F.col("post_covid")
    if spec.sex in df.columns:
        new["lag_x_sexo_mujeres"] = F.col(lag) * (F.col(spec.sex) == spec.women).cast("int")
    if spec.area in df.columns:
        new["lag_x_area_urbana"] = F.col(lag) * (F.col(spec.area) == spec.urban).cast("int")
    return df.withColumns(new) if new else df


def categories_of(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct members of a dimension column.  One small job whose
    result is bounded by the dimension's cardinality (entities, areas, sexes)."""
    return sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)


def one_hot(df: DataFrame, specs, categories: dict | None = None) -> DataFrame:
    """Dummies for sorted categories with the first one dropped.

    ``specs`` = [(column, prefix)]; ``categories`` may pin the member lists
    (avoids the distinct job and fixes the output schema)."""
    categories = categories or {}
    new = {}
    for col, prefix in specs:
        if col not in df.columns:
            continue
        members = categories.get(col) or categories_of(df, col)
        for m in sorted(members)[1:]:
            new[f"{prefix}_{m}"] = (F.col(col) == F.lit(m)).cast("int")
    return df.withColumns(new) if new else df


def feature_table(panel: DataFrame, spec: PanelSpec = DEFAULT_SPEC, categories: dict | None = None,
                  refill_interactions: bool = True, year_range: tuple | None = None) -> DataFrame:
    """Contrast -> fill -> time -> lag -> delta -> ratio -> interaction ->
    one-hot -> second fill (excluding ``_lag1``/``_delta``).

    With ``refill_interactions`` (the default, as in the reference) the
    second fill also back-fills the ``lag_x_*`` interactions of the first
    period; set it False to keep them null where the lag is null.
    ``year_range`` (min, max year) may be passed when the caller knows it,
    which saves the pass over the input that would find it.
    """
    df = contrast_features(panel, spec)
    df = fill_panel(df, spec)
    df = time_features(df, spec, year_range)
    df = lag_features(df, spec)
    df = delta_features(df, spec)
    df = ratio_features(df)
    df = interaction_features(df, spec)
    df = one_hot(df, [(spec.entity, "prov"), (spec.area, "area"), (spec.sex, "sexo")], categories)
    excl = ["_lag1", "_delta"] + ([] if refill_interactions else ["lag_x_post_covid", "lag_x_sexo_mujeres",
                                                                  "lag_x_area_urbana"])
    return fill_panel(df, spec, exclude_suffixes=excl)
