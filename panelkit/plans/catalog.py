"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.bands import risk_band
from panelkit.operators import features as feat
from panelkit.operators import panel as pan
from panelkit.plans.common import HIGH, LOW, SPEC, enriched, enriched_table, entities, features, panel, round_doubles, source, stored
from panelkit.session import materialize
from panelkit.sources import bridge
from panelkit.operators.util import fitted
from panelkit.sources.tables import Tables

KEY = ["provincia", "periodo", "area", "sexo"]
CONTRAST = ["brecha_desempleo_urb_rur", "ratio_pea_urbana", "brecha_desempleo_genero"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# ---------------------------------------------------------------- panel core
@query
def q_build_panel(spark, sf_dir):
    return round_doubles(panel(_t(spark, sf_dir)))


@query
def q_contrast_features(spark, sf_dir):
    c = feat.contrast_features(panel(_t(spark, sf_dir)), SPEC)
    return round_doubles(c.select(*KEY, "tasa_desempleo", *CONTRAST))


def latest_ranked(df: DataFrame, low=LOW, high=HIGH) -> DataFrame:
    """P4 + T3: latest period, total/total slice, ranked by rate."""
    latest = df.select(F.max(SPEC.period)).scalar()
    return (df.where((F.col(SPEC.period) == latest) & (F.col(SPEC.area) == SPEC.total)
                     & (F.col(SPEC.sex) == SPEC.total))
              .select(SPEC.entity, SPEC.period, SPEC.target, *CONTRAST,
                      risk_band(F.col(SPEC.target), low, high).alias("riesgo"))
              .orderBy(F.desc_nulls_last(SPEC.target), SPEC.entity))


@query
def q_latest_ranked(spark, sf_dir):
    return round_doubles(latest_ranked(feat.contrast_features(panel(_t(spark, sf_dir)), SPEC)))


@query
def q_enrich_panel(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = pan.enrich_panel(panel(t), bridge.attribute_sources(t, SPEC), SPEC)
    return round_doubles(p)


@query
def q_macro_by_year(spark, sf_dir):
    return round_doubles(pan.macro_from_long(bridge.macro_long(_t(spark, sf_dir))))


@query
def q_enrich_macro(spark, sf_dir):
    t = _t(spark, sf_dir)
    m = pan.macro_from_long(bridge.macro_long(t))
    p = pan.enrich_macro(panel(t), m, SPEC)
    return round_doubles(p.select(*KEY, "anio", *[c for c in m.columns if c != "anio"]))


# ---------------------------------------------------------------- features
@query
def q_feature_table(spark, sf_dir):
    return round_doubles(features(_t(spark, sf_dir)))


@query
def q_fill_panel(spark, sf_dir):
    return round_doubles(feat.fill_panel(enriched(_t(spark, sf_dir)), SPEC))


def _feature_slice(spark, sf_dir, cols):
    f = features(_t(spark, sf_dir))
    return round_doubles(f.select(*KEY, *cols))


@query
def q_lag_features(spark, sf_dir):
    return _feature_slice(spark, sf_dir, [c + "_lag1" for c in SPEC.lag_cols])


@query
def q_delta_features(spark, sf_dir):
    return _feature_slice(spark, sf_dir, [c + "_delta" for c in SPEC.delta_cols])


@query
def q_time_features(spark, sf_dir):
    return _feature_slice(spark, sf_dir, ["anio", "anio_norm", "post_covid"])


@query
def q_ratios(spark, sf_dir):
    return _feature_slice(spark, sf_dir, ["empleo_formal_pct", "educacion_alta", "ratio_terciario_primario",
                                          "ratio_micro_grande", "salario_rel_pib"])


@query
def q_interactions(spark, sf_dir):
    return _feature_slice(spark, sf_dir, ["tasa_desempleo_lag1", "lag_x_post_covid", "lag_x_sexo_mujeres",
                                          "lag_x_area_urbana"])


@query
def q_one_hot(spark, sf_dir):
    f = features(_t(spark, sf_dir))
    dummies = [c for c in f.columns if c.startswith(("prov_", "area_", "sexo_"))]
    return f.select(*KEY, *dummies)


# ---------------------------------------------------------------- descriptive statistics
from panelkit.operators import stats as st  # noqa: E402

ERA_SPLIT = 1998  # first "post" year of the fixture (its years run 1995-2001)
CORR_COLS = ["tasa_desempleo", "tasa_participacion", "pct_subempleo", "empleo_informal_pct",
             "pct_universitaria", "pct_sin_educacion", "pct_sector_primario", "pct_sector_terciario",
             "pct_empresa_grande", "mediana_salario", "pib_crecimiento"]
DESCRIBE_COLS = ["tasa_desempleo", "tasa_participacion", "pea", "pct_subempleo", "empleo_informal_pct",
                 "mediana_salario", "pct_universitaria", "pct_sector_terciario"]


def total_slice(df: DataFrame) -> DataFrame:
    """The area=total, sex=total slice."""
    return df.where((F.col(SPEC.area) == SPEC.total) & (F.col(SPEC.sex) == SPEC.total))


def _tot(spark, sf_dir, enrich=False):
    t = _t(spark, sf_dir)
    return total_slice(enriched_table(t) if enrich else panel(t))


@query
def q_member_counts(spark, sf_dir):
    return st.member_counts(panel(_t(spark, sf_dir)), [SPEC.area, SPEC.sex])


@query
def q_panel_shape(spark, sf_dir):
    return st.panel_shape(panel(_t(spark, sf_dir)), SPEC.entity, SPEC.period)


@query
def q_coverage(spark, sf_dir):
    return round_doubles(st.coverage(enriched_table(_t(spark, sf_dir))))


@query
def q_null_profile(spark, sf_dir):
    """A4: columns with nulls, ranked, and the null cells of the whole panel."""
    return round_doubles(st.null_profile(enriched_table(_t(spark, sf_dir))))


@query
def q_null_matrix(spark, sf_dir):
    e = enriched_table(_t(spark, sf_dir))
    return st.null_matrix(e, SPEC.entity, SPEC.period, feat.numeric_columns(e))


@query
def q_period_stats(spark, sf_dir):
    return round_doubles(st.group_stats(_tot(spark, sf_dir), [SPEC.period], SPEC.target))


@query
def q_entity_ranking(spark, sf_dir):
    r = st.group_stats(_tot(spark, sf_dir), [SPEC.entity], SPEC.target, dp=2)
    return r.orderBy(F.desc("media"), SPEC.entity)


@query
def q_heatmap_matrix(spark, sf_dir):
    d = _tot(spark, sf_dir)
    periods = feat.categories_of(d, SPEC.period)  # bounded by the number of periods
    return round_doubles(st.pivot_matrix(d, SPEC.entity, SPEC.period, SPEC.target, periods))


@query
def q_median_by_group(spark, sf_dir):
    from panelkit.operators.quantiles import exact_quantiles
    m = exact_quantiles(_tot(spark, sf_dir), [SPEC.entity], SPEC.target, {"mediana": 0.5})
    return round_doubles(m).orderBy(F.desc("mediana"), SPEC.entity)


@query
def q_gap_by_period(spark, sf_dir):
    p = panel(_t(spark, sf_dir))
    g = st.conditional_gap(p, [SPEC.period], SPEC.sex, SPEC.women, SPEC.men, SPEC.target,
                           "brecha_genero", F.col(SPEC.area) == SPEC.total)
    u = st.conditional_gap(p, [SPEC.period], SPEC.area, SPEC.urban, SPEC.rural, SPEC.target,
                           "brecha_urb_rur", F.col(SPEC.sex) == SPEC.total)
    out = g.join(u, SPEC.period, "full")
    means = fitted(out, g=F.avg("brecha_genero"), u=F.avg("brecha_urb_rur"))
    out = out.withColumns({"brecha_genero_media": F.lit(means["g"]).cast("double"),
                           "brecha_urb_rur_media": F.lit(means["u"]).cast("double")})
    return round_doubles(out)


@query
def q_era_change(spark, sf_dir):
    d = _tot(spark, sf_dir).withColumn(
        "etapa", F.when(F.col(SPEC.year) < ERA_SPLIT, F.lit("Pre")).otherwise(F.lit("Post")))
    r = d.groupBy(SPEC.entity).agg(
        F.avg(F.when(F.col("etapa").contains("Pre"), F.col(SPEC.target))).alias("media_pre"),
        F.avg(F.when(F.col("etapa").contains("Post"), F.col(SPEC.target))).alias("media_post"))
    r = r.withColumn("cambio", F.col("media_post") - F.col("media_pre"))
    r = r.withColumn("cambio_medio", r.select(F.avg("cambio")).scalar())
    return round_doubles(r)


@query
def q_describe_panel(spark, sf_dir):
    return st.describe(enriched_table(_t(spark, sf_dir)), DESCRIBE_COLS, dp=2)


@query
def q_box_stats(spark, sf_dir):
    return round_doubles(st.box_stats(_tot(spark, sf_dir), [SPEC.entity], SPEC.target))


@query
def q_histogram(spark, sf_dir):
    return round_doubles(st.histogram(_tot(spark, sf_dir), SPEC.target, 25))


@query
def q_scale_limits(spark, sf_dir):
    """Shared colour/axis limits over two periods."""
    d = _tot(spark, sf_dir).where(F.col(SPEC.period).isin(*PERIOD_PAIR))
    r = d.agg(F.max(SPEC.target).alias("_m"), F.min(SPEC.target).alias("_n"))
    return round_doubles(r.select(
        F.greatest(F.lit(15.0), F.col("_m") * 1.1).alias("lim_color"),
        (F.col("_n") - 1).alias("eje_min"), (F.col("_m") + 1).alias("eje_max"),
        (F.col("_m") * 1.15).alias("lim_barras")))


PERIOD_PAIR = ("1996-08", "2000-08")


@query
def q_corr_pairwise(spark, sf_dir):
    return round_doubles(st.corr_long(_tot(spark, sf_dir, enrich=True), CORR_COLS))


@query
def q_corr_listwise(spark, sf_dir):
    cols = ["tasa_participacion", "pct_subempleo", "pct_sector_primario", "mediana_salario", SPEC.target]
    return round_doubles(st.corr_long(_tot(spark, sf_dir, enrich=True), cols, listwise=True))


@query
def q_corr_target(spark, sf_dir):
    """Variables ranked by |r| with the target, sign kept, top 4."""
    c = st.corr_long(_tot(spark, sf_dir, enrich=True), CORR_COLS)
    c = c.where((F.col("var_b") == SPEC.target) & (F.col("var_a") != SPEC.target))
    c = c.select(F.col("var_a").alias("variable"), "r", F.abs("r").alias("abs_r"),
                 F.when(F.col("r") > 0, F.lit("+")).otherwise(F.lit("-")).alias("signo"))
    return round_doubles(c.orderBy(F.desc("abs_r"), "variable").limit(4))


@query
def q_trend_line(spark, sf_dir):
    return round_doubles(st.trend_lines(_tot(spark, sf_dir, enrich=True), SPEC.target, CORR_COLS[1:]))


@query
def q_iqr_outliers(spark, sf_dir):
    o = st.iqr_outliers(_tot(spark, sf_dir), SPEC.target)
    return round_doubles(o.select(SPEC.entity, SPEC.period, SPEC.target, "lado", "limite_inf", "limite_sup",
                                  "pct_atipicos"))


@query
def q_iqr_top_outliers(spark, sf_dir):
    """The ten highest high-side outliers (a top-k report)."""
    o = st.iqr_outliers(_tot(spark, sf_dir), SPEC.target).where(F.col("lado") == "alto")
    return round_doubles(o.select(SPEC.entity, SPEC.period, SPEC.target)
                         .orderBy(F.desc(SPEC.target), SPEC.entity, SPEC.period).limit(10))


@query
def q_rank_sum_test(spark, sf_dir):
    d = _tot(spark, sf_dir)
    return round_doubles(st.rank_sum_test(d, SPEC.target, F.col(SPEC.year) < ERA_SPLIT))


@query
def q_rank_sum_pvalue(spark, sf_dir):
    """The test with its two-sided p-value."""
    r = st.rank_sum_test(_tot(spark, sf_dir), SPEC.target, F.col(SPEC.year) < ERA_SPLIT)
    return round_doubles(r.withColumn("p_valor", st.two_sided_p(F.col("z"))))


@query
def q_normality_jb(spark, sf_dir):
    return round_doubles(st.normality_jb(_tot(spark, sf_dir), SPEC.target))


@query
def q_qq_points(spark, sf_dir):
    return round_doubles(st.qq_points(_tot(spark, sf_dir), SPEC.target))


@query
def q_kde_grid(spark, sf_dir):
    return round_doubles(st.kde_grid(_tot(spark, sf_dir), SPEC.target, 50))


@query
def q_frame_ranking(spark, sf_dir):
    """Per-period ranking (animation frames); partitioned by period."""
    from pyspark.sql import Window
    d = _tot(spark, sf_dir).where(F.col(SPEC.target).isNotNull())
    w = Window.partitionBy(SPEC.period).orderBy(F.desc(SPEC.target), SPEC.entity)
    return round_doubles(d.select(SPEC.period, SPEC.entity, SPEC.target, F.row_number().over(w).alias("puesto")))


def slice_panel(df: DataFrame, area=None, sex=None, entities=None) -> DataFrame:
    """Slice by area, sex and entity list, each only if the column exists;
    an empty entity list means no entity filter."""
    if area is not None and SPEC.area in df.columns:
        df = df.where(F.col(SPEC.area) == area)
    if sex is not None and SPEC.sex in df.columns:
        df = df.where(F.col(SPEC.sex) == sex)
    if entities:
        df = df.where(F.col(SPEC.entity).isin(*entities))
    return df


@query
def q_slice(spark, sf_dir):
    """P1 + T11: series of two entities, urban area, ordered by period."""
    s = slice_panel(panel(_t(spark, sf_dir)), SPEC.urban, SPEC.total, ["NATION_1", "NATION_2"])
    return round_doubles(s.select(SPEC.entity, SPEC.period, SPEC.target).orderBy(SPEC.entity, SPEC.period))


@query
def q_period_compare(spark, sf_dir):
    """Z3 + P3: two periods side by side per entity with shared limits."""
    p1, p2 = PERIOD_PAIR
    d = _tot(spark, sf_dir).where(F.col(SPEC.period).isin(p1, p2))
    r = d.groupBy(SPEC.entity).agg(F.max(F.when(F.col(SPEC.period) == p1, F.col(SPEC.target))).alias("tasa_p1"),
                                   F.max(F.when(F.col(SPEC.period) == p2, F.col(SPEC.target))).alias("tasa_p2"))
    r = r.withColumn("cambio", F.col("tasa_p2") - F.col("tasa_p1"))
    lim = d.select(F.greatest(F.lit(15.0), F.max(SPEC.target) * 1.1)).scalar()
    return round_doubles(r.withColumn("lim_max", lim))


# ---------------------------------------------------------------- consolidation and sources
MEASURES = ["poblacion_15_mas", "pea", "ocupados", "desocupados", "tasa_desempleo", "tasa_participacion"]


@query
def q_vintage_latest(spark, sf_dir):
    """U1 + W5: consolidate publication vintages, latest wins per key."""
    v = source(_t(spark, sf_dir), "vintages", lambda: bridge.vintages(_t(spark, sf_dir), SPEC))
    own = bridge.publication_seq(F.col(SPEC.period))
    # preliminary rows (published with their own period) and revisions (one
    # publication later, with a note column the first frame lacks)
    frames = [v.where(F.col("pub_seq") == own), v.where(F.col("pub_seq") != own).withColumn("nota", F.lit("revisado"))]
    return round_doubles(pan.vintage_latest(frames, SPEC).select(*KEY, "anio", *MEASURES))


# ---------------------------------------------------------------- text functions and report grids
from panelkit.functions import text as tx  # noqa: E402
from panelkit.operators import grid as gr  # noqa: E402



def _patterns(t: Tables):
    return bridge.entity_patterns(list(entities(t)))


def _total_only(t: Tables) -> list[str]:
    return [n for n, k in entities(t).items() if k >= bridge.COMARCA_FROM_KEY]


def label_variants(t: Tables) -> DataFrame:
    """Decorated entity labels and caption rows, six variants per nation."""
    n = t.nation.select("n_nationkey", "n_name")
    k, name = F.col("n_nationkey"), F.col("n_name")
    variants = F.array(
        bridge.decorate(name, k),
        F.concat(F.lit("  "), name, F.lit(" ...... "), F.lit("x")),
        F.concat(F.lit("Total "), name),
        F.concat(k.cast("string"), F.lit(" "), name),
        F.concat(F.lit("Urbana")),
        F.concat(F.lit("República de "), name, F.lit(" y sus provincias y comarcas indígenas del país")),
    )
    return n.select("n_nationkey", F.posexplode(variants).alias("variante", "etiqueta"))


@query
def q_clean_label(spark, sf_dir):
    v = label_variants(_t(spark, sf_dir))
    return v.select("n_nationkey", "variante", "etiqueta", tx.clean_label(F.col("etiqueta")).alias("limpia"))


@query
def q_canonical_entity(spark, sf_dir):
    t = _t(spark, sf_dir)
    v = label_variants(t)
    return v.select("n_nationkey", "variante", tx.canonical_entity(F.col("etiqueta"), _patterns(t)).alias("entidad"))


@query
def q_entity_rows(spark, sf_dir):
    v = label_variants(_t(spark, sf_dir))
    return v.select("n_nationkey", "variante", tx.is_entity_row(F.col("etiqueta")).alias("valida"))


def numeric_texts(t: Tables) -> DataFrame:
    """Cell texts in the shapes reports use: thousands separators, '..',
    '-', blanks, underscores, a Java-only suffix, words."""
    o = t.orders.select("o_orderkey", "o_totalprice")
    k, v = F.col("o_orderkey") % 8, F.col("o_totalprice")
    txt = (F.when(k == 0, F.format_number(v, 2))
            .when(k == 1, F.lit(".."))
            .when(k == 2, F.lit("-"))
            .when(k == 3, F.concat(v.cast("string"), F.lit("d")))
            .when(k == 4, F.concat(F.lit(" \t"), v.cast("string"), F.lit(" ")))
            .when(k == 5, F.regexp_replace(v.cast("string"), r"\.", "_"))
            .when(k == 6, F.lit("n/d"))
            .otherwise(F.concat(v.cast("string"), F.lit("e-2"))))
    return o.select("o_orderkey", txt.alias("texto"))


@query
def q_safe_double(spark, sf_dir):
    n = numeric_texts(_t(spark, sf_dir))
    return round_doubles(n.select("o_orderkey", "texto", tx.safe_double(F.col("texto")).alias("valor")))


@query
def q_parse_period_label(spark, sf_dir):
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    y = F.year("o_orderdate").cast("string")
    k = F.col("o_orderkey") % 5
    lab = (F.when(k == 0, F.concat(y, F.lit(" (octubre)"))).when(k == 1, F.concat(y, F.lit(" (Abril)")))
            .when(k == 2, F.concat(y, F.lit(" (R)"))).when(k == 3, F.concat(F.lit("Año "), y))
            .otherwise(F.lit("Nota: cifras preliminares")))
    d = o.select(lab.alias("etiqueta")).distinct()
    year, period = tx.period_from_label(F.col("etiqueta"))
    return d.select("etiqueta", year.alias("anio"), period.alias("periodo")).where(F.col("anio").isNotNull())


def _grid(t):
    return source(t, "core_grid", lambda: bridge.core_grid(t, SPEC))


def _registry(t):
    return source(t, "registry", lambda: bridge.grid_registry(t, SPEC))


def _core(t):
    return gr.core_blocks(_grid(t), _registry(t), _patterns(t), _total_only(t))


@query
def q_grid_build(spark, sf_dir):
    """The report grid (long table) — cells per file."""
    g = _grid(_t(spark, sf_dir))
    return g.groupBy("file_id").agg(F.count(F.lit(1)).alias("celdas"), F.max("row").alias("ultima_fila"))


@query
def q_grid_anchors(spark, sf_dir):
    t = _t(spark, sf_dir)
    g = gr.drop_page_breaks(_grid(t))
    reg = _registry(t).select("file_id", "layout").distinct()
    cands = gr.entity_candidates(g, _patterns(t)).join(reg, "file_id")
    skip = gr.block_skip(F.col("layout"), F.col("entity").isin(*_total_only(t)))
    return gr.greedy_anchors(cands, skip).withColumnRenamed("entity", "provincia")


CORE_OUT = ["poblacion_15_mas", "pea", "ocupados", "desocupados", "tasa_desempleo", "tasa_participacion"]


@query
def q_grid_core(spark, sf_dir):
    c = _core(_t(spark, sf_dir))
    return round_doubles(c.select("file_id", "provincia", "periodo", "anio", "area", "sexo", *CORE_OUT))


@query
def q_grid_panel(spark, sf_dir):
    """Grid -> per-file records -> keep-last across publications."""
    c = _core(_t(spark, sf_dir)).withColumn("row", F.lit(0))
    return round_doubles(pan.keep_last(c.drop("file_id"), KEY).drop("pub_seq", "row"))


# ---------------------------------------------------------------- report tables with a row or a block per entity
from panelkit.operators import report_rows as rr  # noqa: E402
from panelkit.sources import report_fixtures as rf  # noqa: E402


def _report_registry(t):
    return source(t, "report_registry", lambda: rf.report_registry(t, SPEC))


def _row_report(t, name: str) -> DataFrame:
    """G3, G5-G8 on the grids of one table, the newest publication's record per entity-period."""
    reg = _report_registry(t)
    grid = source(t, f"grid_{name}", lambda: rf.row_grid(t, name, reg, SPEC))
    records = rr.row_table(grid, rf.registry_of(reg, name.removeprefix("cuadro")), _patterns(t), rr.ROW_TABLES[name])
    return pan.keep_last(records.drop("file_id", "anio"), [SPEC.entity, SPEC.period], ("pub_seq", "row")).drop("pub_seq", "row")


@query
def q_activity_rates(spark, sf_dir):
    """Activity rates total/urban/rural per entity-period, from the report grids."""
    return round_doubles(_row_report(_t(spark, sf_dir), "cuadro6"))


@query
def q_composition_shares(spark, sf_dir):
    """Guarded shares per entity-period, from the report grids."""
    t, key = _t(spark, sf_dir), [SPEC.entity, SPEC.period]
    out = _row_report(t, "cuadro16")
    for name in ("cuadro19", "cuadro22"):
        out = out.join(_row_report(t, name), key, "full")
    return round_doubles(out)


@query
def q_median_wage(spark, sf_dir):
    """Median wage per entity-period, from the report grids."""
    return round_doubles(_row_report(_t(spark, sf_dir), "cuadro25"))


@query
def q_age_structure(spark, sf_dir):
    """Shares of the young and the old in the labour force, from age blocks of several rows."""
    t = _t(spark, sf_dir)
    reg = _report_registry(t)
    grid = source(t, "grid_cuadro4", lambda: rf.age_grid(t, reg, SPEC))
    records = rr.age_table(grid, rf.registry_of(reg, "4"), _patterns(t))
    return round_doubles(pan.keep_last(records.drop("file_id", "anio"), [SPEC.entity, SPEC.period], ("pub_seq", "row")).drop("pub_seq", "row"))


# ---------------------------------------------------------------- model evaluation
from panelkit.operators import evaluate as ev  # noqa: E402
from panelkit.operators import tuning as tn  # noqa: E402
from panelkit.spec import SELECTED_FEATURES  # noqa: E402


def model_features(df: DataFrame) -> list[str]:
    """P5: the selected features that exist in this feature table."""
    return pan.existing(df, SELECTED_FEATURES)


def _ft(spark, sf_dir):
    return features(_t(spark, sf_dir))


@query
def q_lopo_split(spark, sf_dir):
    return ev.lopo_split(_ft(spark, sf_dir), SPEC.period)


@query
def q_fold_impute(spark, sf_dir):
    f = _ft(spark, sf_dir)
    return round_doubles(ev.fold_medians(f, model_features(f), SPEC.period, ev.periods_of(f, SPEC.period)))


@query
def q_fold_scale(spark, sf_dir):
    f = _ft(spark, sf_dir)
    feats, folds = model_features(f), ev.periods_of(f, SPEC.period)
    med = ev.fold_medians(f, feats, SPEC.period, folds)
    return round_doubles(ev.fold_scaler(f, feats, SPEC.period, folds, med))


def baseline_predictions(f: DataFrame) -> DataFrame:
    lag = f"{SPEC.target}_lag1"
    a = ev.lopo_persistence(f, SPEC.target, lag, SPEC.period, KEY).withColumn("modelo", F.lit("Persistencia"))
    b = ev.lopo_ols1(f, SPEC.target, lag, SPEC.period, KEY).withColumn("modelo", F.lit("MCO1"))
    return a.unionByName(b)


@query
def q_lopo_persistence(spark, sf_dir):
    p = ev.lopo_persistence(_ft(spark, sf_dir), SPEC.target, f"{SPEC.target}_lag1", SPEC.period, KEY)
    return round_doubles(ev.cv_metrics(p, [ev.FOLD]).withColumnRenamed(ev.FOLD, "periodo"))


@query
def q_lopo_ols1(spark, sf_dir):
    p = ev.lopo_ols1(_ft(spark, sf_dir), SPEC.target, f"{SPEC.target}_lag1", SPEC.period, KEY)
    return round_doubles(ev.cv_metrics(p, [ev.FOLD]).withColumnRenamed(ev.FOLD, "periodo"))


@query
def q_cv_predictions(spark, sf_dir):
    """Out-of-fold predictions with the full row key."""
    return round_doubles(baseline_predictions(_ft(spark, sf_dir)).drop(ev.FOLD))


def _cv_metrics(spark, sf_dir):
    """Fold metrics of the two baselines (periods x 2 rows), written once for their several readers."""
    def build():
        p = baseline_predictions(_ft(spark, sf_dir))
        return ev.cv_metrics(p, ["modelo", ev.FOLD]).withColumnRenamed(ev.FOLD, "periodo")
    return stored(_t(spark, sf_dir), "cv_metrics", build)


@query
def q_cv_metrics(spark, sf_dir):
    return round_doubles(_cv_metrics(spark, sf_dir))


@query
def q_cv_summary(spark, sf_dir):
    """Mean metrics per model, best flagged, best's folds."""
    m = _cv_metrics(spark, sf_dir)
    s = ev.cv_summary(m)
    best = s.where("mejor").select("modelo")
    detail = m.join(best, "modelo").select("modelo", "periodo", F.col("rmse").alias("rmse_periodo"))
    return round_doubles(s.join(detail, "modelo", "left").drop("n_folds"))


@query
def q_risk_accuracy(spark, sf_dir):
    p = ev.with_bands(baseline_predictions(_ft(spark, sf_dir)), "real", "predicho", LOW, HIGH)
    return round_doubles(ev.risk_accuracy(p, ["modelo"]))


def metric_matrix(m: DataFrame, models: list[str]) -> DataFrame:
    return m.groupBy("periodo").pivot("modelo", models).agg(
        F.round(F.max("rmse"), 4).alias("rmse"), F.round(F.max("mae"), 4).alias("mae"), F.round(F.max("r2"), 4).alias("r2"))


@query
def q_cv_matrix(spark, sf_dir):
    """Period x model matrix of RMSE, MAE and R² (4 dp)."""
    return metric_matrix(_cv_metrics(spark, sf_dir), ["MCO1", "Persistencia"])


def metric_table(m: DataFrame) -> DataFrame:
    """T9 + U6: model summary as a map model -> metrics, exploded back to
    rows, ranked by R² with the best value of each metric flagged."""
    s = ev.cv_summary(m)
    nested = s.agg(F.map_from_entries(F.collect_list(F.struct("modelo", F.struct("mae", "rmse", "r2")))).alias("m"))
    rows = materialize(nested.select(F.explode("m").alias("modelo", "v")).select("modelo", "v.*"))  # a row per model, read twice
    best = fitted(rows, mae=F.min("mae"), rmse=F.min("rmse"), r2=F.max("r2"))
    flags = {"mejor_mae": F.col("mae") == best["mae"], "mejor_rmse": F.col("rmse") == best["rmse"],
             "mejor_r2": F.col("r2") == best["r2"]}
    return round_doubles(rows.withColumns(flags).orderBy(F.desc("r2")))


@query
def q_model_table(spark, sf_dir):
    return metric_table(_cv_metrics(spark, sf_dir))


def _fold_predictions(spark, sf_dir, name, fn):
    """Out-of-fold predictions of a model, fitted once per session and read from shared storage."""
    f = _ft(spark, sf_dir)
    return stored(_t(spark, sf_dir), f"folds_{name}", lambda: fn(f, model_features(f)))


def _lopo_model(spark, sf_dir, name, fn):
    p = _fold_predictions(spark, sf_dir, name, fn)
    return round_doubles(ev.cv_metrics(p, [ev.FOLD]).withColumnRenamed(ev.FOLD, "periodo")
                         .withColumn("modelo", F.lit(name)))


def _linear(kind: str, alpha: float):
    return lambda f, x: ev.lopo_linear(f, x, SPEC.target, SPEC.period, KEY, kind, alpha)


def _tree(make):
    return lambda f, x: ev.lopo_spark_ml(f, x, SPEC.target, SPEC.period, KEY, make)


def _boosted(**params):
    return lambda f, x: ev.lopo_boosted(f, x, SPEC.target, SPEC.period, KEY, **params)


# M3-M7: every fitted model -> its out-of-fold predictions with the row key.
MODELS = {
    "Ridge": _linear("ridge", 1.0),
    "Lasso": _linear("lasso", 0.1),
    "RandomForest": _tree(ev.forest),
    "GradientBoosting": _boosted(),
    "BoostingMuestreado": _boosted(share_rows=0.8, share_features=0.8),
}


@query
def q_lopo_ridge(spark, sf_dir):
    return _lopo_model(spark, sf_dir, "Ridge", MODELS["Ridge"])


@query
def q_lopo_lasso(spark, sf_dir):
    return _lopo_model(spark, sf_dir, "Lasso", MODELS["Lasso"])


@query
def q_lopo_forest(spark, sf_dir):
    return _lopo_model(spark, sf_dir, "RandomForest", MODELS["RandomForest"])


@query
def q_lopo_gbt(spark, sf_dir):
    return _lopo_model(spark, sf_dir, "GradientBoosting", MODELS["GradientBoosting"])


@query
def q_lopo_gbt_sampled(spark, sf_dir):
    return _lopo_model(spark, sf_dir, "BoostingMuestreado", MODELS["BoostingMuestreado"])


def all_predictions(spark, sf_dir) -> DataFrame:
    """M11 over baselines and fitted models: (key, fold, real, predicho, modelo). The models are fitted as concurrent jobs."""
    f = _ft(spark, sf_dir)  # written before the fits that read it
    with ThreadPoolExecutor(max_workers=len(MODELS)) as pool:
        fitted_models = list(pool.map(lambda m: _fold_predictions(spark, sf_dir, *m), MODELS.items()))
    out = baseline_predictions(f).select(*KEY, ev.FOLD, "real", "predicho", "modelo")
    for name, p in zip(MODELS, fitted_models):
        out = out.unionByName(p.withColumn("modelo", F.lit(name)))
    return out


def _contest(spark, sf_dir) -> DataFrame:
    """Out-of-fold predictions of all models with both bands, written once."""
    return stored(_t(spark, sf_dir), "contest", lambda: ev.with_bands(all_predictions(spark, sf_dir), "real", "predicho", LOW, HIGH))


def _contest_metrics(spark, sf_dir) -> DataFrame:
    return stored(_t(spark, sf_dir), "contest_metrics",
                  lambda: ev.cv_metrics(_contest(spark, sf_dir), ["modelo", ev.FOLD]).withColumnRenamed(ev.FOLD, "periodo"))


def _contest_accuracy(spark, sf_dir) -> DataFrame:
    hit = (F.col("riesgo_real") == F.col("riesgo_pred")).cast("double")
    return _contest(spark, sf_dir).groupBy("modelo").agg(F.avg(hit).alias("precision_riesgo"))


@query
def q_model_contest(spark, sf_dir):
    """A21 + T5 + T9 + A19 over all models: mean fold metrics, risk accuracy
    and the best model (lowest RMSE)."""
    return round_doubles(ev.cv_summary(_contest_metrics(spark, sf_dir)).join(_contest_accuracy(spark, sf_dir), "modelo"))


@query
def q_contest_matrix(spark, sf_dir):
    """A9 over all models: period x model matrix of RMSE, MAE and R² (4 dp)."""
    return metric_matrix(_contest_metrics(spark, sf_dir), ["Persistencia", "MCO1", *MODELS])


@query
def q_contest_table(spark, sf_dir):
    """T9 + U6 over all models, ranked by R² with the best value of each metric flagged."""
    return metric_table(_contest_metrics(spark, sf_dir))


@query
def q_contest_best(spark, sf_dir):
    """T5 + T12: the folds of the best of all models."""
    m = _contest_metrics(spark, sf_dir)
    best = ev.cv_summary(m).where("mejor").select("modelo", F.col("rmse").alias("rmse_medio"))
    return round_doubles(m.join(best, "modelo").orderBy("periodo"))


# Features of the small linear model whose solution the SQL twins repeat in closed form.
FEW_FEATURES = ["tasa_desempleo_lag1", "tasa_participacion", "pct_subempleo"]


@query
def q_lopo_ridge_few(spark, sf_dir):
    """M1-M3 + M10 on three features: ridge with fold medians and scaling, metrics per period."""
    p = ev.lopo_linear(_ft(spark, sf_dir), FEW_FEATURES, SPEC.target, SPEC.period, KEY, "ridge", 1.0)
    return round_doubles(ev.cv_metrics(p, [ev.FOLD]).withColumnRenamed(ev.FOLD, "periodo"))


@query
def q_linear_importance(spark, sf_dir):
    """M12, linear part: absolute standardised weights of the final ridge on three features."""
    imp = tn.linear_importances(_ft(spark, sf_dir), FEW_FEATURES, SPEC.target)
    return round_doubles(tn.importance_table(spark, {"Ridge": imp}))


# Draws, inner folds and boosting rounds of the registered searches (the operators' own: 30, 5, and 100 to 300 rounds).
QUERY_DRAWS, QUERY_INNER, QUERY_ROUNDS = 2, 2, [2, 4, 8]


@query
def q_lopo_tuned(spark, sf_dir):
    """M8 in M9: the drawn parameters of every fold's own search, all rows, pinned by the seed."""
    f = _ft(spark, sf_dir)
    _, trials = tn.lopo_tuned(f, model_features(f), SPEC.target, SPEC.period, KEY, grid=tn.GRIDS["GradientBoosting"] | {"maxIter": QUERY_ROUNDS}, draws=QUERY_DRAWS, inner=QUERY_INNER)
    return round_doubles(trials)


@query
def q_model_importances(spark, sf_dir):
    """M12 + T2: importances of the final linear models and of boosting tuned over the six-axis grid, 15 largest each."""
    f = _ft(spark, sf_dir)
    feats = model_features(f)
    _, _, _, trees = tn.final_tuned(f, feats, SPEC.target, KEY, ev.boosting_sampled, tn.GRIDS["BoostingMuestreado"] | {"maxIter": QUERY_ROUNDS}, QUERY_DRAWS, QUERY_INNER)
    per_model = {k: tn.linear_importances(f, feats, SPEC.target, k.lower()) for k in ("Ridge", "Lasso")}
    return round_doubles(tn.importance_table(spark, per_model | {"BoostingMuestreado": trees}).where("puesto <= 15"))


# ---------------------------------------------------------------- scoring, risk, explanation, scenarios
from panelkit.functions.bands import risk_band_nullsafe  # noqa: E402
from panelkit.operators import explain as xp  # noqa: E402
from panelkit.operators import scenario as scn  # noqa: E402
from panelkit.operators import scoring as sco  # noqa: E402
from panelkit.plans.common import EXPLAIN_ROW, FIXTURE_SLIDERS, INTERCEPT, SCENARIOS, WEIGHTS  # noqa: E402


def _scored(spark, sf_dir):
    return sco.score_panel(_ft(spark, sf_dir), KEY + ["anio"], SPEC.target, WEIGHTS, INTERCEPT, LOW, HIGH)


@query
def q_score_panel(spark, sf_dir):
    return round_doubles(_scored(spark, sf_dir))


@query
def q_latest_predicted(spark, sf_dir):
    """P4 + T3: latest period, total/total, ranked by prediction."""
    s = _scored(spark, sf_dir)
    latest = s.select(F.max(SPEC.period)).scalar()
    return round_doubles(total_slice(s).where(F.col(SPEC.period) == latest)
                         .orderBy(F.desc("prediccion"), SPEC.entity))


@query
def q_risk_band(spark, sf_dir):
    """F5 and F6 side by side on the panel rate."""
    p = panel(_t(spark, sf_dir))
    return p.select(*KEY, risk_band(F.col(SPEC.target), LOW, HIGH).alias("riesgo"),
                    risk_band_nullsafe(F.col(SPEC.target), LOW, HIGH).alias("riesgo_mapa"))


@query
def q_risk_kpis(spark, sf_dir):
    """Rows per actual risk class in the latest total/total slice."""
    s = total_slice(_scored(spark, sf_dir))
    latest = s.select(F.max(SPEC.period)).scalar()
    return s.where(F.col(SPEC.period) == latest).groupBy("riesgo_real").agg(F.count(F.lit(1)).alias("n"))


@query
def q_risk_table(spark, sf_dir):
    """T4: entity detail of one period, ranked by the actual rate."""
    s = total_slice(_scored(spark, sf_dir)).where(F.col(SPEC.period) == PERIOD_PAIR[1])
    return round_doubles(s.select(SPEC.entity, SPEC.target, "prediccion", "riesgo_real", "riesgo_predicho")
                         .orderBy(F.desc(SPEC.target), SPEC.entity))


@query
def q_residual_stats(spark, sf_dir):
    """Mean residual (and spread) per period."""
    s = _scored(spark, sf_dir)
    return round_doubles(s.groupBy(SPEC.period).agg(F.avg("residuo").alias("residuo_medio"),
                                                    F.avg(F.abs("residuo")).alias("residuo_abs_medio"),
                                                    F.count("residuo").alias("n")))


@query
def q_real_vs_pred(spark, sf_dir):
    """X9 + T10 + Z4: one period's actual vs predicted pairs, ascending by
    rate, with the shared 45° line limits."""
    s = total_slice(_scored(spark, sf_dir)).where(F.col(SPEC.period) == PERIOD_PAIR[1])
    lim = fitted(s, lo=F.least(F.min(SPEC.target), F.min("prediccion")),
                 hi=F.greatest(F.max(SPEC.target), F.max("prediccion")))
    return round_doubles(s.select(SPEC.entity, SPEC.target, "prediccion", "riesgo_real", "riesgo_predicho",
                                  F.lit(lim["lo"]).cast("double").alias("lim_inf"),
                                  F.lit(lim["hi"]).cast("double").alias("lim_sup"))
                         .orderBy(SPEC.target, SPEC.entity))


def _phi(spark, sf_dir):
    return xp.explain_linear(_ft(spark, sf_dir), KEY, WEIGHTS, INTERCEPT)


@query
def q_explain_linear(spark, sf_dir):
    return round_doubles(_phi(spark, sf_dir))


@query
def q_explain_global(spark, sf_dir):
    return round_doubles(xp.explain_global(_phi(spark, sf_dir), top=5))


def _one_row(df):
    e, p, a, s = EXPLAIN_ROW
    return df.where((F.col(SPEC.entity) == e) & (F.col(SPEC.period) == p) & (F.col(SPEC.area) == a)
                    & (F.col(SPEC.sex) == s))


@query
def q_explain_row(spark, sf_dir):
    return round_doubles(xp.explain_row(_one_row(_phi(spark, sf_dir)), KEY, top=5))


@query
def q_explain_text(spark, sf_dir):
    return xp.explain_text(total_slice(_phi(spark, sf_dir)), KEY, top=3)


@query
def q_explain_dependence(spark, sf_dir):
    """H5/H6: (value, φ, colour value) points for the top-3 features."""
    phi = _phi(spark, sf_dir)
    top = xp.explain_global(phi, top=3).select("feature")
    pts = phi.join(F.broadcast(top), "feature")  # top-3 list: 3 rows
    colour = _ft(spark, sf_dir).select(*KEY, F.col("tasa_participacion").alias("color"))
    return round_doubles(pts.join(colour, KEY).select(*KEY, "feature", "valor", "phi", "color"))


@query
def q_importance_compare(spark, sf_dir):
    """Model importance |w| vs φ importance of every feature, scaled."""
    model = spark.createDataFrame([(k, abs(v)) for k, v in WEIGHTS.items()], "feature string, importancia double")
    phi_imp = xp.explain_global(_phi(spark, sf_dir))
    return round_doubles(xp.importance_compare(model, phi_imp, "modelo", "shap"))


def _final_gbt(f, feats):
    from pyspark.ml.feature import VectorAssembler
    med = sco.column_medians(f, feats)
    filled = f.select(*KEY, SPEC.target, *[F.coalesce(F.col(c).cast("double"), med[c]).alias(c) for c in feats])
    data = VectorAssembler(inputCols=feats, outputCol="features").transform(filled)
    model = ev.boosting(featuresCol="features", labelCol=SPEC.target).fit(data.where(F.col(SPEC.target).isNotNull()))
    return model, filled


@query
def q_top_importance(spark, sf_dir):
    """M12 + T2: final boosted model on all rows; tree importances, top 15."""
    f = _ft(spark, sf_dir)
    feats = model_features(f)
    model, _ = _final_gbt(f, feats)
    imp = model.featureImportances.toArray().tolist()  # one value per feature
    t = spark.createDataFrame(list(zip(feats, imp)), "feature string, importancia double")
    return t.orderBy(F.desc("importancia"), "feature").limit(15)


def sample_fixed(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Deterministic sample of n rows (smallest md5 of seed and key; a null
    key part counts as empty)."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in KEY]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), *KEY).limit(n)


@query
def q_sample_fixed(spark, sf_dir):
    return round_doubles(sample_fixed(_ft(spark, sf_dir).select(*KEY, SPEC.target), 500))


@query
def q_explain_sampled(spark, sf_dir):
    """H1 for a tree model: permutation Shapley of every row, 8 sampled
    orders each, scored by the boosted model itself."""
    f = _ft(spark, sf_dir)
    feats = model_features(f)
    model, filled = _final_gbt(f, feats)
    return round_doubles(xp.permutation_shapley(filled, KEY, feats, model, reps=8))


@query
def q_what_if(spark, sf_dir):
    sc = spark.createDataFrame(SCENARIOS, "scenario_id int, provincia string, area string, sexo string, "
                                          "variable string, value double")
    r = scn.what_if(_ft(spark, sf_dir), sc, WEIGHTS, INTERCEPT, LOW, HIGH, FIXTURE_SLIDERS, SPEC)
    return round_doubles(r)


@query
def q_scenario_values(spark, sf_dir):
    r = q_what_if(spark, sf_dir)
    return scn.scenario_values(r, list(FIXTURE_SLIDERS))


@query
def q_row_profile(spark, sf_dir):
    """P11 + P12: one cell's non-null measures as rows, with its option label."""
    e, p, a, s = EXPLAIN_ROW
    r = enriched_table(_t(spark, sf_dir))
    r = r.where((F.col(SPEC.entity) == e) & (F.col(SPEC.period) == p) & (F.col(SPEC.area) == a) & (F.col(SPEC.sex) == s))
    cols = feat.numeric_columns(r)
    long = r.select(F.concat_ws(" - ", SPEC.entity, SPEC.period).alias("opcion"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("valor")) for c in cols])).alias("_v"))
    return round_doubles(long.select("opcion", "_v.*").where(F.col("valor").isNotNull()))


# ---------------------------------------------------------------- regional layer
from panelkit.operators import regions as rg  # noqa: E402

# Region names of the fixture layer: "Nation k" (one in five keeps the raw
# name, nation 24 has a long name) and the name map back to entities.
REGION_MAP = {(f"Nation {k}" if k != 24 else "Nation 24 Comarca Indigena"): f"NATION_{k}"
              for k in range(25) if k % 5 != 0}


def region_name(t: Tables) -> F.Column:
    k = F.col("n_nationkey")
    return (F.when(k % 5 == 0, F.col("n_name")).when(k == 24, F.lit("Nation 24 Comarca Indigena"))
             .otherwise(F.concat(F.lit("Nation "), k.cast("string"))))


def region_vertices(t: Tables) -> DataFrame:
    """The layer as GeoJSON lines, read back into the vertex table."""
    n = t.nation.select("n_nationkey", "n_name")
    v = rg.regular_polygons(n, "n_nationkey", region_name(t))
    return rg.read_features(rg.to_features(v))


@query
def q_region_vertices(spark, sf_dir):
    return round_doubles(region_vertices(_t(spark, sf_dir)))


@query
def q_polygon_measures(spark, sf_dir):
    return round_doubles(rg.polygon_measures(region_vertices(_t(spark, sf_dir))))


@query
def q_multipart_measures(spark, sf_dir):
    """S8 + Z5 + Z6 on a region per customer, with holes and several parts, through GeoJSON and back."""
    t = _t(spark, sf_dir)
    name = F.concat(F.lit("Zona "), F.col("c_custkey").cast("string"))
    v = rg.holes_and_islands(rg.regular_polygons(t.customer.select("c_custkey"), "c_custkey", name))
    m = rg.polygon_measures(rg.read_features(rg.to_features(v)))
    return round_doubles(m.select("region", "level", "vertices", "area_grados2", "centro_x", "centro_y"))


@query
def q_layer_profile(spark, sf_dir):
    return round_doubles(rg.layer_profile(rg.polygon_measures(region_vertices(_t(spark, sf_dir))), ["level"]))


@query
def q_geo_enrich(spark, sf_dir):
    t = _t(spark, sf_dir)
    to_entity, _ = rg.name_map(REGION_MAP)
    regions = region_vertices(t).select("region").distinct()
    d = total_slice(panel(t))
    periods = feat.categories_of(d, SPEC.period)  # bounded by the calendar
    return round_doubles(rg.geo_enrich(regions, d, to_entity, SPEC.entity, SPEC.period, SPEC.target, periods, LOW, HIGH))


@query
def q_geo_export(spark, sf_dir):
    t = _t(spark, sf_dir)
    to_entity, _ = rg.name_map(REGION_MAP)
    s = total_slice(_scored(spark, sf_dir))
    latest = s.select(F.max(SPEC.period)).scalar()
    preds = s.where(F.col(SPEC.period) == latest)
    return rg.geo_export(region_vertices(t), preds, to_entity, SPEC.entity, SPEC.period, SPEC.target, "prediccion", LOW, HIGH)


@query
def q_geo_real_vs_pred(spark, sf_dir):
    """Z4 on the region layer: one period's actual and predicted values and bands."""
    t = _t(spark, sf_dir)
    to_entity, _ = rg.name_map(REGION_MAP)
    s = total_slice(_scored(spark, sf_dir))
    return round_doubles(rg.geo_real_vs_pred(region_vertices(t), s, to_entity, SPEC.entity, SPEC.period, PERIOD_PAIR[1], SPEC.target, "prediccion", LOW, HIGH))


# ---------------------------------------------------------------- sources and sinks
from panelkit.sources import files as fl  # noqa: E402
from panelkit.sources import indicators as ind  # noqa: E402
from panelkit.sources import links as lk  # noqa: E402


@query
def q_harvest_links(spark, sf_dir):
    """S7 on the page table; the fixture pages hold no spreadsheet links, so
    the pattern is '/de' (links whose path starts with 'de')."""
    return lk.harvest_links(_t(spark, sf_dir).pages, "/de")


def _records(t):
    return ind.indicator_records(source(t, "payloads", lambda: bridge.indicator_payloads(t)))


@query
def q_indicator_records(spark, sf_dir):
    return round_doubles(_records(_t(spark, sf_dir)))


@query
def q_indicator_wide(spark, sf_dir):
    return round_doubles(ind.indicator_wide(_records(_t(spark, sf_dir))))


@query
def q_indicator_coverage(spark, sf_dir):
    return ind.indicator_coverage(_records(_t(spark, sf_dir)))


@query
def q_indicators_per_year(spark, sf_dir):
    return ind.indicators_per_year(_records(_t(spark, sf_dir)))


@query
def q_indicator_files(spark, sf_dir):
    """K7 + S3: the long and the wide indicator file written as CSV with a byte-order mark and read back."""
    records = _records(_t(spark, sf_dir))
    base = _scratch(spark, "indicators")
    ind.write_csv(records, base + "/largo")
    ind.write_csv(ind.indicator_wide(records), base + "/ancho")
    long = ind.read_long_csv(spark, base + "/largo").groupBy("codigo").agg(
        F.count(F.lit(1)).alias("registros"), F.count("valor").alias("con_valor"), F.max("pais").alias("pais"), F.round(F.sum("valor"), 4).alias("suma_larga"))
    wide = ind.wide_to_long(ind.read_wide_csv(spark, base + "/ancho"), "codigo").groupBy("codigo").agg(
        F.max("indicador").alias("indicador"), F.count("valor").alias("celdas"), F.round(F.sum("valor"), 4).alias("suma_ancha"))
    return long.join(wide, "codigo", "left")


@query
def q_indicator_file_wide(spark, sf_dir):
    """U4 read back from its CSV file: years are whatever columns the header has."""
    path = _scratch(spark, "indicators-wide")
    ind.write_csv(ind.indicator_wide(_records(_t(spark, sf_dir))), path)
    wide = ind.read_wide_csv(spark, path)
    return round_doubles(ind.wide_to_long(wide, "codigo").where("valor IS NOT NULL").select("codigo", "indicador", "anio", "valor"))


@query
def q_macro_file(spark, sf_dir):
    """S3 -> U3: the wide indicator table as a CSV file with a byte-order mark, read by its header, one row per year."""
    path = _scratch(spark, "macro")
    ind.write_csv(bridge.macro_wide(_t(spark, sf_dir)), path, order="_row")
    return round_doubles(pan.macro_by_year(ind.read_wide_csv(spark, path)))


@query
def q_locate_report(spark, sf_dir):
    t = _t(spark, sf_dir)
    return fl.locate_reports(source(t, "listing", lambda: bridge.report_listing(t, SPEC)),
                             source(t, "requests", lambda: bridge.report_requests(t, SPEC)))


@query
def q_file_manifest(spark, sf_dir):
    return fl.file_manifest(spark, sf_dir, "*.parquet")


def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    import uuid
    from panelkit.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"


@query
def q_src_panel(spark, sf_dir):
    """S1 + K7: panel written as CSV with a header, read back with an
    explicit schema (no inference)."""
    p = panel(_t(spark, sf_dir))
    path = _scratch(spark, "panel-csv")
    p.write.option("header", True).csv(path)
    back = spark.read.option("header", True).schema(p.schema).csv(path)
    return round_doubles(back)


@query
def q_sink_roundtrip(spark, sf_dir):
    """K1-K3 + T1: enriched panel in canonical column order, written as
    parquet partitioned by period and sorted inside partitions, read back
    with an explicit schema."""
    e = enriched(_t(spark, sf_dir))
    path = _scratch(spark, "panel-parquet")
    (e.repartition(SPEC.period).sortWithinPartitions(SPEC.period, SPEC.entity, SPEC.area, SPEC.sex)
      .write.partitionBy(SPEC.period).parquet(path))
    back = spark.read.schema(e.schema).parquet(path)
    return round_doubles(back.select(*e.columns))


@query
def q_sink_national(spark, sf_dir):
    """K2: the national series written as one CSV, sorted by year and period, and read back with its row order."""
    series = q_national_series(spark, sf_dir)
    path = _scratch(spark, "national-csv")
    series.orderBy("anio", "periodo").coalesce(1).write.csv(path, header=True)  # a row per period
    back = spark.read.csv(path, header=True, schema=series.schema).withColumn("fila", F.monotonically_increasing_id())
    return back


@query
def q_sink_features(spark, sf_dir):
    """K3: the feature table written as CSV and read back with its schema."""
    f = _ft(spark, sf_dir)
    path = _scratch(spark, "features-csv")
    f.write.csv(path, header=True)
    return round_doubles(spark.read.csv(path, header=True, schema=f.schema))


@query
def q_sink_cv_detail(spark, sf_dir):
    """K4: metrics per model and period, written and read back."""
    m = _cv_metrics(spark, sf_dir)
    path = _scratch(spark, "cv-detail")
    m.write.csv(path, header=True)
    return round_doubles(spark.read.csv(path, header=True, schema=m.schema))


@query
def q_sink_predictions(spark, sf_dir):
    """K4: the final predictions with residual and bands, written and read back."""
    p = _scored(spark, sf_dir)
    path = _scratch(spark, "final-predictions")
    p.write.csv(path, header=True)
    return round_doubles(spark.read.csv(path, header=True, schema=p.schema))


@query
def q_sink_importances(spark, sf_dir):
    """K4: the importance table, written sorted and read back."""
    imp = tn.importance_table(spark, {"Ridge": tn.linear_importances(_ft(spark, sf_dir), FEW_FEATURES, SPEC.target)})
    path = _scratch(spark, "importances")
    imp.orderBy("modelo", "puesto").coalesce(1).write.csv(path, header=True)  # a row per feature
    return round_doubles(spark.read.csv(path, header=True, schema=imp.schema))


def _summary(spark, sf_dir):
    """M14 summary of all models: best model, rounded metrics, map model ->
    metrics, counts, risk accuracies and the top-10 weights."""
    f = _ft(spark, sf_dir)
    s = ev.cv_summary(_contest_metrics(spark, sf_dir))
    acc = _contest_accuracy(spark, sf_dir).withColumnRenamed("precision_riesgo", "acc")
    sc = _scored(spark, sf_dir)
    acc_train = sc.select(F.avg((F.col("riesgo_real") == F.col("riesgo_predicho")).cast("double"))).scalar()
    top10 = [k for k, _ in sorted(WEIGHTS.items(), key=lambda kv: -abs(kv[1]))[:10]]
    m = F.struct(F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 4).alias("r2"))
    j = s.join(acc, "modelo")
    one = j.agg(F.max_by("modelo", F.col("mejor").cast("int")).alias("mejor_modelo"),
                F.max_by(m, F.col("mejor").cast("int")).alias("metricas_cv"),
                F.map_from_entries(F.collect_list(F.struct("modelo", m))).alias("todos_modelos_cv"),
                F.round(F.max_by("acc", F.col("mejor").cast("int")), 4).alias("precision_riesgo_cv"))
    counts = fitted(f, n=F.count(F.lit(1)), p=F.count_distinct(SPEC.period), e=F.count_distinct(SPEC.entity))
    return one.select("mejor_modelo", "metricas_cv", "todos_modelos_cv",
                      F.lit(len(model_features(f))).alias("n_features"), F.lit(counts["n"]).alias("n_filas"),
                      F.lit(counts["p"]).alias("n_periodos"), F.lit(counts["e"]).alias("n_provincias"),
                      F.round(acc_train, 4).alias("precision_riesgo_train"), "precision_riesgo_cv",
                      F.array(*[F.lit(x) for x in top10]).alias("features_top10"))


@query
def q_run_summary(spark, sf_dir):
    """M14 + K5: the summary as one JSON document."""
    return _summary(spark, sf_dir).select(F.to_json(F.struct("*")).alias("resumen"))


@query
def q_src_summary(spark, sf_dir):
    """The summary written as a (multi-line) JSON file and read back
    with an explicit schema."""
    s = _summary(spark, sf_dir)
    path = _scratch(spark, "summary-json")
    s.coalesce(1).write.json(path)
    return spark.read.schema(s.schema).option("multiLine", True).json(path)


@query
def q_score_loaded(spark, sf_dir):
    """K6 + S10: a fitted pipeline (assembler + ridge-mapped linear
    regression) saved to the shared folder, loaded back and used to score."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    f = _ft(spark, sf_dir)
    feats = model_features(f)
    med = sco.column_medians(f, feats)
    data = f.select(*KEY, SPEC.target, *[F.coalesce(F.col(c).cast("double"), med[c]).alias(c) for c in feats])
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=SPEC.target, regParam=0.001,
                                             elasticNetParam=0.0, solver="normal")])
    model = pipe.fit(data.where(F.col(SPEC.target).isNotNull()))
    path = _scratch(spark, "model")
    model.write().save(path)
    loaded = PipelineModel.load(path)
    out = loaded.transform(data).select(*KEY, SPEC.target, F.greatest(F.col("prediction"), F.lit(0.0)).alias("prediccion"))
    return round_doubles(out)


# ---------------------------------------------------------------- other report grids
@query
def q_national_series(spark, sf_dir):
    """G10 + U7 + K2: national series from the newest report only, by year."""
    t = _t(spark, sf_dir)
    g = source(t, "national_grid", lambda: bridge.national_grid(t, SPEC))
    ns = gr.national_series(g)
    newest = ns.agg(F.max("file_id").alias("file_id"))  # one row: the latest report
    return round_doubles(ns.join(F.broadcast(newest), "file_id").drop("file_id", "row").orderBy("anio", "periodo"))


@query
def q_national_range(spark, sf_dir):
    """First and last year, and the last record of the series."""
    s = q_national_series(spark, sf_dir)
    return s.agg(F.min("anio").alias("anio_min"), F.max("anio").alias("anio_max"),
                 F.max_by("periodo", F.struct("anio", "periodo")).alias("ultimo_periodo"),
                 F.max_by("tasa_desempleo", F.struct("anio", "periodo")).alias("ultima_tasa"))


@query
def q_sector_shares(spark, sf_dir):
    """Sector shares found below each anchor in the sector reports."""
    t = _t(spark, sf_dir)
    reg = _registry(t).withColumn("file_id", F.regexp_replace("file_id", "^c2_", "c13_"))
    s = gr.sector_blocks(source(t, "sector_grid", lambda: bridge.sector_grid(t, SPEC)), reg, _patterns(t))
    return round_doubles(s.drop("pub_seq"))


@query
def q_grid_informal(spark, sf_dir):
    """Informality rows 10-29, label in column 1, consolidated keep-last
    over (publication, row)."""
    t = _t(spark, sf_dir)
    reg = (_registry(t).withColumn("file_id", F.regexp_replace("file_id", "^c2_", "c39_"))
           .withColumn("col_inf", F.col("col_pct") - 1))
    r = gr.row_records(source(t, "informal_grid", lambda: bridge.informal_grid(t, SPEC)), reg, _patterns(t), label_col=1, probe_col=None,
                       value_cols={"empleo_informal_pct": "col_inf"}, start_row=10, end_row=30, check_row=False,
                       first_per_entity=False)
    out = pan.keep_last(r.drop("file_id"), ["provincia", "periodo"], ("pub_seq", "row"))
    return round_doubles(out.drop("pub_seq", "row"))


# ---------------------------------------------------------------- quality and streaming
from panelkit.operators import quality as qa  # noqa: E402


@query
def q_quality_report(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = panel(t)
    a = qa.panel_quality(p, SPEC).withColumn("tabla", F.lit("panel"))
    b = qa.feature_quality(_ft(spark, sf_dir), len(enriched(t).columns), SPEC).withColumn("tabla", F.lit("features"))
    c = qa.prediction_quality(_scored(spark, sf_dir), ev.cv_summary(_cv_metrics(spark, sf_dir))).withColumn(
        "tabla", F.lit("predicciones"))
    return a.unionByName(b).unionByName(c)


@query
def q_prediction_quality(spark, sf_dir):
    """Q3 over all models: columns, bounds, at least four models, and the best model's risk accuracy."""
    s = ev.cv_summary(_contest_metrics(spark, sf_dir))
    best = s.where("mejor").join(_contest_accuracy(spark, sf_dir), "modelo").first()  # one row
    return qa.prediction_quality(_scored(spark, sf_dir), s, best["precision_riesgo"], min_models=4,
                                 required=[SPEC.entity, SPEC.period, SPEC.target, "prediccion", "riesgo_real", "riesgo_predicho"])


@query
def q_stream_consolidate(spark, sf_dir):
    """Publications streamed in as files into one table, of which the latest records are taken."""
    from panelkit.streaming.consolidate import consolidated, publish
    t = _t(spark, sf_dir)
    v = source(t, "vintages", lambda: bridge.vintages(t, SPEC))
    src, table = _scratch(spark, "publications"), _scratch(spark, "published")
    v.write.parquet(src)
    publish(spark, src, v.schema, table, _scratch(spark, "stream-ckpt"))
    return round_doubles(consolidated(spark, table, v.schema, KEY).select(*KEY, "anio", *MEASURES))


def prepare_sources(spark, sf_dir) -> None:
    """Write the fixture inputs (report grids, publications, payloads,
    listings) once, before any timing: they play the role of input files."""
    t = _t(spark, sf_dir)
    _grid(t), _registry(t)
    source(t, "vintages", lambda: bridge.vintages(t, SPEC))
    source(t, "payloads", lambda: bridge.indicator_payloads(t))
    source(t, "listing", lambda: bridge.report_listing(t, SPEC))
    source(t, "requests", lambda: bridge.report_requests(t, SPEC))
    source(t, "national_grid", lambda: bridge.national_grid(t, SPEC))
    source(t, "sector_grid", lambda: bridge.sector_grid(t, SPEC))
    source(t, "informal_grid", lambda: bridge.informal_grid(t, SPEC))
    reg = _report_registry(t)
    source(t, "grid_cuadro4", lambda: rf.age_grid(t, reg, SPEC))
    for name in rr.ROW_TABLES:
        source(t, f"grid_{name}", lambda: rf.row_grid(t, name, reg, SPEC))


@query
def q_sink_reports(spark, sf_dir):
    """K4: evaluation outputs (per-fold metrics and out-of-fold predictions)
    written as parquet report tables and read back."""
    f = _ft(spark, sf_dir)
    preds = baseline_predictions(f).drop(ev.FOLD)
    metrics = _cv_metrics(spark, sf_dir)
    base = _scratch(spark, "reports")
    preds.write.partitionBy("modelo").parquet(base + "/predicciones_cv")
    metrics.write.parquet(base + "/cv_resultados")
    back = spark.read.schema(preds.schema).parquet(base + "/predicciones_cv")
    return round_doubles(back.select(*preds.columns))


@query
def q_qq_positions(spark, sf_dir):
    """X7 part 1: order statistics and Filliben plotting positions."""
    return round_doubles(st.qq_positions(_tot(spark, sf_dir), SPEC.target))
