"""DuckDB SQL twins of the registered queries.

Written independently of the Spark code: plain SQL over the same parquet
tables, composed from named CTEs.  Column lists are the fixed schema of the
panel data model.
"""

from __future__ import annotations

from panelkit.functions import normal as nm
from panelkit.plans.common import HIGH, LOW

KEY = "provincia, periodo, area, sexo"
# rows of the nation table, which the columns of the twins are named after
ENTITIES = [f"NATION_{i}" for i in range(25)]
# columns of the wide twins: the calendar of the test tables
YEARS = [str(y) for y in range(1995, 2002)]
PERIODS = [f"{y}-{m}" for y in YEARS for m in ("03", "08")]
SERIES = "PARTITION BY provincia, area, sexo ORDER BY periodo"

ORDER_ATTRS = ["tasa_actividad_total", "tasa_actividad_urbana", "tasa_actividad_rural",
               "pct_sin_educacion", "pct_primaria", "pct_secundaria", "pct_universitaria",
               "empleo_informal_pct"]
LINE_ATTRS = ["pct_jovenes_pea", "pct_mayores_pea", "pct_sector_primario", "pct_sector_secundario",
              "pct_sector_terciario", "pct_subempleo", "pct_microempresa", "pct_empresa_grande"]
MACRO_COLS = ["pib_crecimiento", "inflacion", "indice_gini", "gasto_educacion_pib",
              "desempleo_juvenil_nacional", "exportaciones_pib", "pib_per_capita",
              "poblacion_total_nacional"]
PANEL_NUM = ["anio", "poblacion_15_mas", "pea", "ocupados", "desocupados",
             "tasa_desempleo", "tasa_participacion"]
CONTRAST = ["brecha_desempleo_urb_rur", "ratio_pea_urbana", "brecha_desempleo_genero"]
ENRICHED_NUM = PANEL_NUM + ORDER_ATTRS + LINE_ATTRS + ["mediana_salario"] + MACRO_COLS
LAGS = ["tasa_desempleo", "tasa_participacion", "empleo_informal_pct", "mediana_salario", "pct_subempleo"]
DELTAS = ["tasa_participacion", "empleo_informal_pct", "mediana_salario"]


def q(name: str) -> str:
    return '"' + name + '"'


def share(cond: str, denom: str = "count(*)") -> str:
    return f"CASE WHEN {denom} > 0 THEN CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) * 100 / {denom} END"


FACTS = """facts AS (
  SELECT n.n_name AS provincia,
         CAST(year(o.o_orderdate) AS VARCHAR) || CASE WHEN month(o.o_orderdate) <= 6 THEN '-03' ELSE '-08' END AS periodo,
         CAST(year(o.o_orderdate) AS INTEGER) AS anio,
         CASE WHEN substr(o.o_orderpriority, 1, 1) IN ('1', '2') THEN 'urbana' ELSE 'rural' END AS area,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'hombres' ELSE 'mujeres' END AS sexo,
         o.o_orderkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

PANEL = FACTS + """,
panel0 AS (
  SELECT provincia, periodo, anio, coalesce(area, 'total') AS area, coalesce(sexo, 'total') AS sexo,
         CAST(count(*) AS BIGINT) AS poblacion_15_mas,
         CAST(count(*) FILTER (WHERE o_orderstatus <> 'P') AS BIGINT) AS pea,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS desocupados
  FROM facts
  GROUP BY GROUPING SETS ((provincia, periodo, anio, area, sexo), (provincia, periodo, anio, area),
                          (provincia, periodo, anio, sexo), (provincia, periodo, anio))),
panel AS (
  SELECT provincia, periodo, anio, area, sexo, poblacion_15_mas, pea, pea - desocupados AS ocupados, desocupados,
         CASE WHEN pea > 0 THEN CAST(desocupados AS DOUBLE) * 100 / pea END AS tasa_desempleo,
         CASE WHEN poblacion_15_mas > 0 THEN CAST(pea AS DOUBLE) * 100 / poblacion_15_mas END AS tasa_participacion
  FROM panel0)"""

LINES = """,
lfacts AS (
  SELECT f.provincia, f.periodo, l.l_quantity, l.l_returnflag, p.p_size
  FROM lineitem l JOIN facts f ON l.l_orderkey = f.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""

ATTRS = LINES + f""",
oattr AS (
  SELECT provincia, periodo,
         {share("o_orderstatus <> 'P'")} AS tasa_actividad_total,
         {share("o_orderstatus <> 'P' AND area = 'urbana'", "count(*) FILTER (WHERE area = 'urbana')")} AS tasa_actividad_urbana,
         {share("o_orderstatus <> 'P' AND area = 'rural'", "count(*) FILTER (WHERE area = 'rural')")} AS tasa_actividad_rural,
         {share("substr(o_orderpriority, 1, 1) = '5'")} AS pct_sin_educacion,
         {share("substr(o_orderpriority, 1, 1) = '3'")} AS pct_primaria,
         {share("substr(o_orderpriority, 1, 1) = '2'")} AS pct_secundaria,
         {share("substr(o_orderpriority, 1, 1) = '1'")} AS pct_universitaria,
         {share("substr(o_orderpriority, 1, 1) = '4'")} AS empleo_informal_pct,
         median(o_totalprice) AS mediana_salario
  FROM facts GROUP BY provincia, periodo),
lattr AS (
  SELECT provincia, periodo,
         {share("p_size <= 10")} AS pct_jovenes_pea,
         {share("p_size > 40")} AS pct_mayores_pea,
         {share("l_returnflag = 'A'")} AS pct_sector_primario,
         {share("l_returnflag = 'N'")} AS pct_sector_secundario,
         {share("l_returnflag = 'R'")} AS pct_sector_terciario,
         {share("l_quantity < 25")} AS pct_subempleo,
         {share("l_quantity < 5")} AS pct_microempresa,
         {share("l_quantity >= 50")} AS pct_empresa_grande
  FROM lfacts GROUP BY provincia, periodo),
mlong AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, l_returnflag || '_' || l_linestatus AS src,
         sum(l_extendedprice) / 1e6 AS val
  FROM lineitem GROUP BY 1, 2),
macro AS (
  SELECT anio,
         max(CASE WHEN src = 'A_F' THEN val END) AS pib_crecimiento,
         max(CASE WHEN src = 'A_O' THEN val END) AS inflacion,
         CAST(NULL AS DOUBLE) AS indice_gini,
         CAST(NULL AS DOUBLE) AS gasto_educacion_pib,
         max(CASE WHEN src = 'N_F' THEN val END) AS desempleo_juvenil_nacional,
         max(CASE WHEN src = 'N_O' THEN val END) AS exportaciones_pib,
         max(CASE WHEN src = 'R_F' THEN val END) AS pib_per_capita,
         max(CASE WHEN src = 'R_O' THEN val END) AS poblacion_total_nacional
  FROM mlong GROUP BY anio),
enriched AS (
  SELECT p.*, {", ".join("o." + c for c in ORDER_ATTRS)}, o.mediana_salario,
         {", ".join("l." + c for c in LINE_ATTRS)}, {", ".join("m." + c for c in MACRO_COLS)}
  FROM panel p LEFT JOIN oattr o USING (provincia, periodo)
               LEFT JOIN lattr l USING (provincia, periodo)
               LEFT JOIN macro m USING (anio))"""


def contrast_cte(src: str, name: str) -> str:
    part = "PARTITION BY provincia, periodo"
    return f"""{name} AS (
  SELECT *,
    max(CASE WHEN area = 'urbana' AND sexo = 'total' THEN tasa_desempleo END) OVER ({part})
      - max(CASE WHEN area = 'rural' AND sexo = 'total' THEN tasa_desempleo END) OVER ({part}) AS brecha_desempleo_urb_rur,
    CAST(max(CASE WHEN area = 'urbana' AND sexo = 'total' THEN pea END) OVER ({part}) AS DOUBLE)
      / nullif(max(CASE WHEN area = 'total' AND sexo = 'total' THEN pea END) OVER ({part}), 0) AS ratio_pea_urbana,
    max(CASE WHEN area = 'total' AND sexo = 'mujeres' THEN tasa_desempleo END) OVER ({part})
      - max(CASE WHEN area = 'total' AND sexo = 'hombres' THEN tasa_desempleo END) OVER ({part}) AS brecha_desempleo_genero
  FROM {src})"""


def fill_expr(c: str) -> str:
    return (f"coalesce({q(c)}, last_value({q(c)} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({q(c)} IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {q(c)}")


def fill_cte(src: str, name: str, cols: list[str]) -> str:
    return f"{name} AS (SELECT * REPLACE ({', '.join(fill_expr(c) for c in cols)}) FROM {src})"


DUMMIES = ([("provincia", "prov", m) for m in sorted(ENTITIES)[1:]]
           + [("area", "area", "total"), ("area", "area", "urbana"),
              ("sexo", "sexo", "mujeres"), ("sexo", "sexo", "total")])
DUMMY_COLS = [f"{p}_{m}" for _, p, m in DUMMIES]
RATIOS = ["empleo_formal_pct", "educacion_alta", "ratio_terciario_primario", "ratio_micro_grande", "salario_rel_pib"]
INTERACTIONS = ["lag_x_post_covid", "lag_x_sexo_mujeres", "lag_x_area_urbana"]
FEATURE_NUM2 = (ENRICHED_NUM + CONTRAST + ["anio_norm", "post_covid"] + RATIOS + INTERACTIONS + DUMMY_COLS)

FEATURES = PANEL + ATTRS + ",\n" + contrast_cte("enriched", "fx1") + ",\n" + fill_cte("fx1", "fx2", ENRICHED_NUM + CONTRAST) + f""",
fx3 AS (
  SELECT *, (anio - min(anio) OVER ()) / greatest(max(anio) OVER () - min(anio) OVER (), 1) AS anio_norm,
         CAST(anio >= 2021 AS INTEGER) AS post_covid
  FROM fx2),
fx4 AS (
  SELECT *, {", ".join(f"lag({c}) OVER ({SERIES}) AS {c}_lag1" for c in LAGS)},
         {", ".join(f"{c} - lag({c}) OVER ({SERIES}) AS {c}_delta" for c in DELTAS)}
  FROM fx3),
fx5 AS (
  SELECT *, 100 - empleo_informal_pct AS empleo_formal_pct,
         pct_universitaria + pct_secundaria AS educacion_alta,
         pct_sector_terciario / nullif(pct_sector_primario, 0) AS ratio_terciario_primario,
         pct_microempresa / nullif(pct_empresa_grande, 0) AS ratio_micro_grande,
         mediana_salario / nullif(pib_per_capita / 12, 0) AS salario_rel_pib,
         tasa_desempleo_lag1 * post_covid AS lag_x_post_covid,
         tasa_desempleo_lag1 * CAST(sexo = 'mujeres' AS INTEGER) AS lag_x_sexo_mujeres,
         tasa_desempleo_lag1 * CAST(area = 'urbana' AS INTEGER) AS lag_x_area_urbana,
         {", ".join(f"CAST({c} = '{m}' AS INTEGER) AS {q(p + '_' + m)}" for c, p, m in DUMMIES)}
  FROM fx4),
""" + fill_cte("fx5", "features", FEATURE_NUM2)


INT_COLS = {"anio", "poblacion_15_mas", "pea", "ocupados", "desocupados", "post_covid"} | set(DUMMY_COLS)


def with_(body: str, select: str, doubles=None) -> str:
    """Compose CTEs + final select; round the listed double columns to 6 dp."""
    sql = "WITH " + body + "\n" + select
    if doubles:
        rep = ", ".join(f"round({q(c)}, 6) AS {q(c)}" for c in doubles)
        sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) t"
    return sql


def dbl(cols) -> list[str]:
    return [c for c in cols if c not in INT_COLS]


def all_sql() -> dict[str, str]:
    s = {}
    s["build_panel"] = with_(PANEL, "SELECT * FROM panel", ["tasa_desempleo", "tasa_participacion"])
    s["contrast_features"] = with_(PANEL + ",\n" + contrast_cte("panel", "c"),
                                   f"SELECT {KEY}, tasa_desempleo, {', '.join(CONTRAST)} FROM c",
                                   ["tasa_desempleo"] + CONTRAST)
    s["latest_ranked"] = with_(PANEL + ",\n" + contrast_cte("panel", "c"), f"""
SELECT provincia, periodo, tasa_desempleo, {', '.join(CONTRAST)},
       CASE WHEN tasa_desempleo IS NULL THEN 'critico' WHEN tasa_desempleo < {LOW} THEN 'bajo'
            WHEN tasa_desempleo < {HIGH} THEN 'moderado' ELSE 'critico' END AS riesgo
FROM c WHERE periodo = (SELECT max(periodo) FROM panel) AND area = 'total' AND sexo = 'total'""",
                               ["tasa_desempleo"] + CONTRAST)
    s["enrich_panel"] = with_(PANEL + ATTRS, "SELECT * EXCLUDE (" + ", ".join(MACRO_COLS) + ") FROM enriched",
                               dbl(PANEL_NUM + ORDER_ATTRS + LINE_ATTRS + ["mediana_salario"]))
    s["macro_by_year"] = with_(PANEL + ATTRS, "SELECT * FROM macro", MACRO_COLS)
    s["enrich_macro"] = with_(PANEL + ATTRS, f"SELECT {KEY}, anio, {', '.join(MACRO_COLS)} FROM enriched", MACRO_COLS)
    s["feature_table"] = with_(FEATURES, "SELECT * FROM features",
                                 dbl(FEATURE_NUM2) + [c + "_lag1" for c in LAGS] + [c + "_delta" for c in DELTAS])
    s["sink_features"] = s["feature_table"]
    s["sample_fixed"] = with_(FEATURES, f"""
SELECT {KEY}, tasa_desempleo FROM features
ORDER BY md5(concat_ws('|', '42', {', '.join(f"coalesce({k.strip()}, '')" for k in KEY.split(','))})), {KEY} LIMIT 500""", ["tasa_desempleo"])
    s["fill_panel"] = with_(PANEL + ATTRS + ",\n" + fill_cte("enriched", "f", ENRICHED_NUM),
                            "SELECT * FROM f", dbl(ENRICHED_NUM))
    s["lag_features"] = with_(FEATURES, f"SELECT {KEY}, {', '.join(c + '_lag1' for c in LAGS)} FROM features",
                                    [c + "_lag1" for c in LAGS])
    s["delta_features"] = with_(FEATURES, f"SELECT {KEY}, {', '.join(c + '_delta' for c in DELTAS)} FROM features",
                                      [c + "_delta" for c in DELTAS])
    s["time_features"] = with_(FEATURES, f"SELECT {KEY}, anio, anio_norm, post_covid FROM features", ["anio_norm"])
    s["ratios"] = with_(FEATURES, f"SELECT {KEY}, {', '.join(RATIOS)} FROM features", RATIOS)
    s["interactions"] = with_(FEATURES, f"SELECT {KEY}, tasa_desempleo_lag1, {', '.join(INTERACTIONS)} FROM features",
                                    ["tasa_desempleo_lag1"] + INTERACTIONS)
    s["one_hot"] = with_(FEATURES, f"SELECT {KEY}, {', '.join(q(c) for c in DUMMY_COLS)} FROM features")
    stats_sql(s)
    consolidation_sql(s)
    grid_sql(s)
    evaluation_sql(s)
    scoring_sql(s)
    misc_sql(s)
    quality_sql(s)
    qq_sql(s)
    return s


# ------------------------------------------------------------------ statistics
ERA_SPLIT = 1998
PERIOD_PAIR = ("1996-08", "2000-08")
CORR_COLS = ["tasa_desempleo", "tasa_participacion", "pct_subempleo", "empleo_informal_pct",
             "pct_universitaria", "pct_sin_educacion", "pct_sector_primario", "pct_sector_terciario",
             "pct_empresa_grande", "mediana_salario", "pib_crecimiento"]
DESCRIBE_COLS = ["tasa_desempleo", "tasa_participacion", "pea", "pct_subempleo", "empleo_informal_pct",
                 "mediana_salario", "pct_universitaria", "pct_sector_terciario"]
TOT = PANEL + ",\ntot AS (SELECT * FROM panel WHERE area = 'total' AND sexo = 'total')"
ETOT = PANEL + ATTRS + ",\netot AS (SELECT * FROM enriched WHERE area = 'total' AND sexo = 'total')"


def corr_sql(src: str, cols: list[str], listwise: bool) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[: i + 1]]
    where = (" WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)) if listwise else ""
    parts = [f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr({a}, {b}) AS r, "
             f"CAST(count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS BIGINT) AS n FROM {src}{where}"
             for a, b in pairs]
    return "\nUNION ALL\n".join(parts)


def stats_sql(s: dict) -> None:
    s["member_counts"] = with_(PANEL, """
SELECT 'area' AS dimension, area AS member, CAST(count(*) AS BIGINT) AS n FROM panel GROUP BY area
UNION ALL SELECT 'sexo', sexo, CAST(count(*) AS BIGINT) FROM panel GROUP BY sexo""")
    s["panel_shape"] = with_(PANEL, """
SELECT CAST(count(*) AS BIGINT) AS n_filas, CAST(count(DISTINCT provincia) AS BIGINT) AS n_provincias,
       CAST(count(DISTINCT periodo) AS BIGINT) AS n_periodos, list_sort(list(DISTINCT periodo)) AS periodos,
       min(periodo) AS periodo_min, max(periodo) AS periodo_max FROM panel""")
    cols = ["provincia", "periodo", "anio", "area", "sexo"] + ENRICHED_NUM[1:]
    s["coverage"] = with_(PANEL + ATTRS, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS columna, CAST(count({c}) AS BIGINT) AS no_nulos, CAST(count(*) - count({c}) AS BIGINT) AS nulos, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 1) AS pct_nulos, "
        f"count({c}) * 100.0 / count(*) AS pct_cobertura FROM enriched" for c in cols),
        ["pct_nulos", "pct_cobertura"])
    s["null_profile"] = with_(PANEL + ATTRS + ",\nc AS (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS columna, CAST(count(*) - count({c}) AS BIGINT) AS nulos, round((count(*) - count({c})) * 100.0 / count(*), 1) AS pct_nulos, "
        f"count(*) AS n FROM enriched" for c in cols) + ")", """
SELECT columna, nulos, pct_nulos, CAST(row_number() OVER (ORDER BY pct_nulos DESC, nulos DESC, columna) AS INTEGER) AS puesto,
       CAST((SELECT sum(nulos) FROM c) AS BIGINT) AS celdas_nulas, round((SELECT sum(nulos) * 100.0 / sum(n) FROM c), 1) AS pct_celdas
FROM c WHERE nulos > 0""")
    s["null_matrix"] = with_(PANEL + ATTRS, "SELECT provincia, periodo, CAST(sum(" + " + ".join(
        f"CAST({c} IS NULL AS INTEGER)" for c in ENRICHED_NUM) + ") AS BIGINT) AS nulos FROM enriched GROUP BY ALL")
    band = ("CAST(count(tasa_desempleo) AS BIGINT) AS n, avg(tasa_desempleo) AS media, stddev_samp(tasa_desempleo) AS std, "
            "min(tasa_desempleo) AS minimo, max(tasa_desempleo) AS maximo, "
            "avg(tasa_desempleo) - stddev_samp(tasa_desempleo) AS banda_inf, "
            "avg(tasa_desempleo) + stddev_samp(tasa_desempleo) AS banda_sup")
    six = ["media", "std", "minimo", "maximo", "banda_inf", "banda_sup"]
    s["period_stats"] = with_(TOT, f"SELECT periodo, {band} FROM tot GROUP BY periodo", six)
    s["entity_ranking"] = with_(TOT, f"SELECT provincia, {band} FROM tot GROUP BY provincia",
                                ) .replace("SELECT provincia, ", "SELECT provincia, ", 1)
    s["entity_ranking"] = with_(TOT, "SELECT provincia, n, " + ", ".join(f"round({c}, 2) AS {c}" for c in six)
                                + f" FROM (SELECT provincia, {band} FROM tot GROUP BY provincia)")
    s["heatmap_matrix"] = with_(TOT, "SELECT provincia, " + ", ".join(
        f"round(avg(CASE WHEN periodo = '{p}' THEN tasa_desempleo END), 6) AS \"{p}\"" for p in PERIODS) + " FROM tot GROUP BY provincia")
    s["median_by_group"] = with_(TOT, "SELECT provincia, quantile_cont(tasa_desempleo, 0.5) AS mediana "
                                      "FROM tot WHERE tasa_desempleo IS NOT NULL GROUP BY provincia", ["mediana"])
    s["gap_by_period"] = with_(PANEL + """,
g AS (SELECT periodo, avg(CASE WHEN sexo = 'mujeres' THEN tasa_desempleo END)
                    - avg(CASE WHEN sexo = 'hombres' THEN tasa_desempleo END) AS brecha_genero
      FROM panel WHERE area = 'total' GROUP BY periodo),
u AS (SELECT periodo, avg(CASE WHEN area = 'urbana' THEN tasa_desempleo END)
                    - avg(CASE WHEN area = 'rural' THEN tasa_desempleo END) AS brecha_urb_rur
      FROM panel WHERE sexo = 'total' GROUP BY periodo),
gu AS (SELECT coalesce(g.periodo, u.periodo) AS periodo, brecha_genero, brecha_urb_rur
       FROM g FULL JOIN u ON g.periodo = u.periodo)""",
        "SELECT *, (SELECT avg(brecha_genero) FROM gu) AS brecha_genero_media, "
        "(SELECT avg(brecha_urb_rur) FROM gu) AS brecha_urb_rur_media FROM gu",
        ["brecha_genero", "brecha_urb_rur", "brecha_genero_media", "brecha_urb_rur_media"])
    s["era_change"] = with_(TOT + f""",
r AS (SELECT provincia, avg(CASE WHEN anio < {ERA_SPLIT} THEN tasa_desempleo END) AS media_pre,
             avg(CASE WHEN anio >= {ERA_SPLIT} THEN tasa_desempleo END) AS media_post FROM tot GROUP BY provincia)""",
        "SELECT *, media_post - media_pre AS cambio, (SELECT avg(media_post - media_pre) FROM r) AS cambio_medio FROM r",
        ["media_pre", "media_post", "cambio", "cambio_medio"])
    s["describe_panel"] = with_(PANEL + ATTRS, "\nUNION ALL\n".join(
        f"SELECT '{c}' AS columna, CAST(count({c}) AS BIGINT) AS count, round_even(avg({c}), 2) AS mean, "
        f"round_even(stddev_samp({c}), 2) AS std, round_even(min({c}), 2) AS min, round_even(quantile_cont({c}, 0.25), 2) AS q25, "
        f"round_even(quantile_cont({c}, 0.5), 2) AS q50, round_even(quantile_cont({c}, 0.75), 2) AS q75, "
        f"round_even(max({c}), 2) AS max FROM enriched" for c in DESCRIBE_COLS))
    s["box_stats"] = with_(TOT + """,
q AS (SELECT provincia, quantile_cont(tasa_desempleo, 0.25) AS q1, quantile_cont(tasa_desempleo, 0.5) AS mediana,
             quantile_cont(tasa_desempleo, 0.75) AS q3 FROM tot WHERE tasa_desempleo IS NOT NULL GROUP BY provincia),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lim_inf, q3 + 1.5 * (q3 - q1) AS lim_sup FROM q)""", """
SELECT f.*, min(CASE WHEN t.tasa_desempleo BETWEEN lim_inf AND lim_sup THEN t.tasa_desempleo END) AS bigote_inf,
       max(CASE WHEN t.tasa_desempleo BETWEEN lim_inf AND lim_sup THEN t.tasa_desempleo END) AS bigote_sup,
       CAST(count(*) FILTER (WHERE NOT t.tasa_desempleo BETWEEN lim_inf AND lim_sup) AS BIGINT) AS n_atipicos,
       CAST(count(*) AS BIGINT) AS n
FROM f JOIN tot t ON f.provincia = t.provincia AND t.tasa_desempleo IS NOT NULL
GROUP BY ALL""", ["q1", "mediana", "q3", "iqr", "lim_inf", "lim_sup", "bigote_inf", "bigote_sup"])
    s["histogram"] = with_(TOT + """,
lim AS (SELECT min(tasa_desempleo) AS lo, (max(tasa_desempleo) - min(tasa_desempleo)) / 25 AS w FROM tot),
b AS (SELECT CAST(coalesce(least(floor((tasa_desempleo - lo) / nullif(w, 0)), 24), 0) AS INTEGER) AS bin, count(*) AS n
      FROM tot, lim WHERE tasa_desempleo IS NOT NULL GROUP BY 1)""", """
SELECT CAST(r.bin AS INTEGER) AS bin, lo + r.bin * w AS desde, lo + (r.bin + 1) * w AS hasta, CAST(coalesce(b.n, 0) AS BIGINT) AS n
FROM (SELECT range AS bin FROM range(25)) r CROSS JOIN lim LEFT JOIN b ON b.bin = r.bin""", ["desde", "hasta"])
    s["scale_limits"] = with_(TOT, f"""
SELECT greatest(15.0, max(tasa_desempleo) * 1.1) AS lim_color, min(tasa_desempleo) - 1 AS eje_min,
       max(tasa_desempleo) + 1 AS eje_max, max(tasa_desempleo) * 1.15 AS lim_barras
FROM tot WHERE periodo IN ('{PERIOD_PAIR[0]}', '{PERIOD_PAIR[1]}')""", ["lim_color", "eje_min", "eje_max", "lim_barras"])
    s["corr_pairwise"] = with_(ETOT, corr_sql("etot", CORR_COLS, False), ["r"])
    s["corr_listwise"] = with_(ETOT, corr_sql("etot", ["tasa_participacion", "pct_subempleo", "pct_sector_primario",
                                                       "mediana_salario", "tasa_desempleo"], True), ["r"])
    s["corr_target"] = with_(ETOT + ",\nc AS (" + corr_sql("etot", CORR_COLS, False) + ")", """
SELECT var_a AS variable, r, abs(r) AS abs_r, CASE WHEN r > 0 THEN '+' ELSE '-' END AS signo
FROM c WHERE var_b = 'tasa_desempleo' AND var_a <> 'tasa_desempleo' ORDER BY abs_r DESC, variable LIMIT 4""",
        ["r", "abs_r"])
    s["trend_line"] = with_(ETOT, "\nUNION ALL\n".join(
        f"SELECT '{x}' AS variable, regr_slope(tasa_desempleo, {x}) AS pendiente, "
        f"regr_intercept(tasa_desempleo, {x}) AS intercepto, CAST(regr_count(tasa_desempleo, {x}) AS BIGINT) AS n FROM etot"
        for x in CORR_COLS[1:]), ["pendiente", "intercepto"])
    out = TOT + """,
d AS (SELECT * FROM tot WHERE tasa_desempleo IS NOT NULL),
q AS (SELECT quantile_cont(tasa_desempleo, 0.25) AS q1, quantile_cont(tasa_desempleo, 0.75) AS q3 FROM d),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
o AS (SELECT d.provincia, d.periodo, d.tasa_desempleo,
             CASE WHEN tasa_desempleo > hi THEN 'alto' ELSE 'bajo' END AS lado, lo AS limite_inf, hi AS limite_sup,
             (SELECT count(*) FILTER (WHERE tasa_desempleo < lo OR tasa_desempleo > hi) * 100.0 / count(*) FROM d, f) AS pct_atipicos
      FROM d, f WHERE tasa_desempleo < lo OR tasa_desempleo > hi)"""
    s["iqr_outliers"] = with_(out, "SELECT * FROM o", ["tasa_desempleo", "limite_inf", "limite_sup", "pct_atipicos"])
    s["iqr_top_outliers"] = with_(out, "SELECT provincia, periodo, tasa_desempleo FROM o WHERE lado = 'alto' "
                                       "ORDER BY tasa_desempleo DESC, provincia, periodo LIMIT 10", ["tasa_desempleo"])
    rank_sum = (TOT + f""",
d AS (SELECT tasa_desempleo AS v, anio < {ERA_SPLIT} AS g FROM tot WHERE tasa_desempleo IS NOT NULL),
r AS (SELECT v, g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS mr FROM d),
t AS (SELECT sum(CASE WHEN g THEN mr END) AS r1, CAST(count(*) FILTER (WHERE g) AS DOUBLE) AS n1,
             CAST(count(*) FILTER (WHERE NOT g) AS DOUBLE) AS n2 FROM r),
ties AS (SELECT sum(c * c * c - c) AS tt FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM d GROUP BY v)),
u AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2 AS u1, tt FROM t, ties),
rs AS (SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u1, n1 * n2 - u1 AS u2,
       (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5)
         / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tt / ((n1 + n2) * (n1 + n2 - 1)))) AS z
FROM u)""")
    s["rank_sum_test"] = with_(rank_sum, "SELECT * FROM rs", ["u1", "u2", "z"])
    s["rank_sum_pvalue"] = with_(rank_sum + ",\nx AS (SELECT *, z / sqrt(2) AS x, abs(z / sqrt(2)) AS y FROM rs)",
                                 f"SELECT n1, n2, u1, u2, z, {erfc_sql('x', 'y')} AS p_valor FROM x", ["u1", "u2", "z", "p_valor"])
    s["normality_jb"] = with_(TOT + """,
d AS (SELECT tasa_desempleo AS v FROM tot WHERE tasa_desempleo IS NOT NULL),
m AS (SELECT avg(v) AS mu, count(*) AS n FROM d),
c AS (SELECT n, avg(power(v - mu, 2)) AS m2, avg(power(v - mu, 3)) AS m3, avg(power(v - mu, 4)) AS m4 FROM d, m GROUP BY n),
k AS (SELECT CAST(n AS BIGINT) AS n, m3 / power(m2, 1.5) AS asimetria, m4 / (m2 * m2) - 3 AS curtosis FROM c)""",
        "SELECT *, n / 6.0 * (asimetria * asimetria + curtosis * curtosis / 4) AS jb, "
        "exp(-(n / 6.0 * (asimetria * asimetria + curtosis * curtosis / 4)) / 2) AS p_valor FROM k",
        ["asimetria", "curtosis", "jb", "p_valor"])
    s["kde_grid"] = with_(TOT + """,
d AS (SELECT tasa_desempleo AS x FROM tot WHERE tasa_desempleo IS NOT NULL),
p AS (SELECT min(x) AS lo, (max(x) - min(x)) / 49 AS step, count(*) AS n, stddev_samp(x) * power(count(*), -0.2) AS h FROM d),
g AS (SELECT CAST(range AS INTEGER) AS k FROM range(50))""", """
SELECT g.k, lo + g.k * step AS x,
       sum(exp(-0.5 * power((lo + g.k * step - d.x) / h, 2))) / sqrt(2 * pi()) / (n * h) AS densidad
FROM g CROSS JOIN p CROSS JOIN d GROUP BY g.k, lo, step, n, h""", ["x", "densidad"])
    s["frame_ranking"] = with_(TOT, "SELECT periodo, provincia, tasa_desempleo, CAST(row_number() OVER "
                                    "(PARTITION BY periodo ORDER BY tasa_desempleo DESC, provincia) AS INTEGER) AS puesto "
                                    "FROM tot WHERE tasa_desempleo IS NOT NULL", ["tasa_desempleo"])
    s["slice"] = with_(PANEL, "SELECT provincia, periodo, tasa_desempleo FROM panel WHERE area = 'urbana' AND "
                              "sexo = 'total' AND provincia IN ('NATION_1', 'NATION_2')", ["tasa_desempleo"])
    p1, p2 = PERIOD_PAIR
    s["period_compare"] = with_(TOT + f""",
r AS (SELECT provincia, max(CASE WHEN periodo = '{p1}' THEN tasa_desempleo END) AS tasa_p1,
             max(CASE WHEN periodo = '{p2}' THEN tasa_desempleo END) AS tasa_p2
      FROM tot WHERE periodo IN ('{p1}', '{p2}') GROUP BY provincia)""",
        f"SELECT *, tasa_p2 - tasa_p1 AS cambio, (SELECT greatest(15.0, max(tasa_desempleo) * 1.1) FROM tot "
        f"WHERE periodo IN ('{p1}', '{p2}')) AS lim_max FROM r", ["tasa_p1", "tasa_p2", "cambio", "lim_max"])


def consolidation_sql(s: dict) -> None:
    meas = "poblacion_15_mas, pea, ocupados, desocupados, tasa_desempleo, tasa_participacion"
    s["vintage_latest"] = with_(PANEL + """,
v AS (
  SELECT provincia, periodo, anio, area, sexo, poblacion_15_mas, pea, ocupados, desocupados + 1 AS desocupados,
         tasa_desempleo + 0.5 AS tasa_desempleo, tasa_participacion,
         (CAST(substr(periodo, 1, 4) AS INTEGER) - 1990) * 2 + CAST(substr(periodo, 6, 2) > '06' AS INTEGER) AS pub_seq,
         0 AS "row"
  FROM panel
  UNION ALL
  SELECT provincia, periodo, anio, area, sexo, poblacion_15_mas, pea, ocupados, desocupados, tasa_desempleo,
         tasa_participacion,
         (CAST(substr(periodo, 1, 4) AS INTEGER) - 1990) * 2 + CAST(substr(periodo, 6, 2) > '06' AS INTEGER) + 1,
         0
  FROM panel WHERE NOT (area = 'rural' AND sexo = 'mujeres'))""",
        f"SELECT {KEY}, anio, {meas} FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} "
        f"ORDER BY pub_seq DESC, \"row\" DESC) AS rn FROM v) WHERE rn = 1",
        ["tasa_desempleo", "tasa_participacion"])
    shares = ["pct_jovenes_pea", "pct_mayores_pea", "pct_sin_educacion", "pct_primaria", "pct_secundaria",
              "pct_universitaria", "pct_subempleo", "pct_microempresa", "pct_empresa_grande"]
    act = ["tasa_actividad_total", "tasa_actividad_urbana", "tasa_actividad_rural"]
    # what the report grids hold: nations with key % 7 = 4 miss one part, those with key % 5 = 3 have a second age block
    s["age_structure"] = with_(PANEL + LINES, f"""
SELECT provincia, periodo,
       CASE WHEN n_nationkey % 7 <> 4 THEN (CAST(count(*) FILTER (WHERE p_size <= 10) AS DOUBLE) + CAST(n_nationkey % 5 = 3 AS INTEGER)) / count(*) * 100 END AS pct_jovenes_pea,
       {share("p_size > 40")} AS pct_mayores_pea
FROM lfacts JOIN nation ON n_name = provincia GROUP BY provincia, periodo, n_nationkey""", shares[:2])
    s["composition_shares"] = with_(PANEL + ATTRS, """
SELECT coalesce(l.provincia, o.provincia) AS provincia, coalesce(l.periodo, o.periodo) AS periodo,
       pct_sin_educacion, pct_primaria, CASE WHEN n_nationkey % 7 <> 4 THEN pct_secundaria END AS pct_secundaria, pct_universitaria,
       CASE WHEN n_nationkey % 7 <> 4 THEN pct_subempleo END AS pct_subempleo, pct_microempresa,
       CASE WHEN n_nationkey % 7 <> 4 THEN pct_empresa_grande END AS pct_empresa_grande
FROM lattr l FULL JOIN oattr o ON l.provincia = o.provincia AND l.periodo = o.periodo
JOIN nation ON n_name = coalesce(l.provincia, o.provincia)""", shares[2:])
    s["activity_rates"] = with_(PANEL + ATTRS, """
SELECT provincia, periodo, tasa_actividad_total, CASE WHEN n_nationkey % 7 <> 4 THEN tasa_actividad_urbana END AS tasa_actividad_urbana,
       tasa_actividad_rural
FROM oattr JOIN nation ON n_name = provincia""", act)
    s["median_wage"] = with_(PANEL + ATTRS, "SELECT provincia, periodo, mediana_salario FROM oattr", ["mediana_salario"])


SEQ = "(CAST(substr(periodo, 1, 4) AS INTEGER) - 1990) * 2 + CAST(substr(periodo, 6, 2) > '06' AS INTEGER)"
GRID = PANEL + f""",
pers AS (SELECT DISTINCT periodo, anio, {SEQ} AS seq FROM panel),
reg0 AS (SELECT seq AS pub_seq, periodo, anio, 'cur' AS role FROM pers
         UNION ALL SELECT seq + 1, periodo, anio, 'prev' FROM pers),
reg AS (SELECT *, 'c2_' || lpad(CAST(pub_seq AS VARCHAR), 3, '0') AS file_id,
               CASE pub_seq % 3 WHEN 0 THEN 'expanded' WHEN 1 THEN 'compact' ELSE 'format_b' END AS layout
        FROM reg0),
fe AS (SELECT DISTINCT r.file_id, r.pub_seq, r.layout, p.provincia, n.n_nationkey AS k
       FROM panel p JOIN reg r ON p.periodo = r.periodo JOIN nation n ON n.n_name = p.provincia),
anch AS (SELECT file_id, provincia,
           CAST(CASE WHEN k >= 22 THEN 8 + 22 * (CASE layout WHEN 'expanded' THEN 66 WHEN 'compact' THEN 30 ELSE 54 END)
                                       + (k - 22) * (CASE layout WHEN 'expanded' THEN 22 WHEN 'compact' THEN 10 ELSE 54 END)
                ELSE 8 + k * (CASE layout WHEN 'expanded' THEN 66 WHEN 'compact' THEN 30 ELSE 54 END) END AS INTEGER) AS "row",
           pub_seq, layout, k
         FROM fe),
areas AS (SELECT * FROM (VALUES ('total'), ('urbana'), ('rural')) a(area)),
sexes AS (SELECT * FROM (VALUES ('total'), ('hombres'), ('mujeres')) s(sexo)),
exp AS (SELECT a.file_id, a.pub_seq, a.provincia, r.periodo, r.anio, r.role, ar.area, sx.sexo
        FROM anch a JOIN reg r ON a.file_id = r.file_id CROSS JOIN areas ar CROSS JOIN sexes sx
        WHERE ar.area = 'total' OR (a.layout <> 'format_b' AND a.k < 22)),
core AS (
  SELECT e.file_id, e.pub_seq, e.provincia, e.periodo, e.anio, e.area, e.sexo,
         CAST(CASE WHEN NOT (e.role = 'prev' AND e.area = 'rural' AND e.sexo = 'mujeres') THEN p.poblacion_15_mas END AS DOUBLE) AS poblacion_15_mas,
         CAST(CASE WHEN NOT (e.role = 'prev' AND e.area = 'rural' AND e.sexo = 'mujeres') THEN p.pea END AS DOUBLE) AS pea,
         CAST(CASE WHEN NOT (e.role = 'prev' AND e.area = 'rural' AND e.sexo = 'mujeres') THEN p.ocupados END AS DOUBLE) AS ocupados,
         CAST(CASE WHEN e.role = 'cur' THEN p.desocupados + 1
                   WHEN NOT (e.area = 'rural' AND e.sexo = 'mujeres') THEN p.desocupados END AS DOUBLE) AS desocupados,
         CASE WHEN e.role = 'cur' THEN p.tasa_desempleo + 0.5
              WHEN NOT (e.area = 'rural' AND e.sexo = 'mujeres') THEN p.tasa_desempleo END AS tasa_desempleo
  FROM exp e LEFT JOIN panel p ON p.provincia = e.provincia AND p.periodo = e.periodo AND p.area = e.area AND p.sexo = e.sexo),
core2 AS (SELECT *, CASE WHEN poblacion_15_mas > 0 AND pea IS NOT NULL THEN pea / poblacion_15_mas * 100 END AS tasa_participacion FROM core)"""

LABELS = """lv AS (
  SELECT n_nationkey, v.variante, CASE v.variante
      WHEN 0 THEN CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN n_name || ' ..........'
                                       WHEN 2 THEN '  ' || lower(n_name) || '…' ELSE n_name || ' ··' END
      WHEN 1 THEN '  ' || n_name || ' ...... x'
      WHEN 2 THEN 'Total ' || n_name
      WHEN 3 THEN CAST(n_nationkey AS VARCHAR) || ' ' || n_name
      WHEN 4 THEN 'Urbana'
      ELSE 'República de ' || n_name || ' y sus provincias y comarcas indígenas del país' END AS etiqueta
  FROM nation CROSS JOIN (SELECT CAST(range AS INTEGER) AS variante FROM range(6)) v),
lc AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(etiqueta, '^\\s+|\\s+$', '', 'g'),
                 '[\\.…·]+\\s*$', ''), '\\.{3,}', '', 'g')) AS limpia FROM lv)"""


CORE_OUT = ["poblacion_15_mas", "pea", "ocupados", "desocupados", "tasa_desempleo", "tasa_participacion"]


def grid_sql(s: dict) -> None:
    # 5 measures a kept cell, 4 label cells an entity, 2 captions an entity with areas, 13 header cells, a break after every 50 rows
    s["grid_build"] = with_(GRID + """,
lay AS (SELECT * FROM (VALUES ('expanded', 22, 11, true), ('compact', 10, 5, true), ('format_b', 54, 15, false)) l(layout, sub, last, areas)),
ent AS (SELECT a.file_id, a.provincia, a."row" AS st, l.sub, l.last, l.areas AND a.k < 22 AS split FROM anch a JOIN lay l USING (layout)),
vals AS (SELECT e.file_id, e.st + e.last + e.sub * (CASE p.area WHEN 'urbana' THEN 1 WHEN 'rural' THEN 2 ELSE 0 END) AS r
         FROM ent e JOIN reg USING (file_id) JOIN panel p ON p.provincia = e.provincia AND p.periodo = reg.periodo
         WHERE NOT (reg.role = 'prev' AND p.area = 'rural' AND p.sexo = 'mujeres') AND (e.split OR p.area = 'total')),
cells AS (SELECT file_id, 5 * count(*) AS n, max(r) AS r FROM vals GROUP BY file_id
          UNION ALL SELECT file_id, 4 * count(*), max(st + 1) FROM ent GROUP BY file_id
          UNION ALL SELECT file_id, 2 * count(*), max(st + 2 * sub) FROM ent WHERE split GROUP BY file_id
          UNION ALL SELECT DISTINCT file_id, 13, 7 FROM ent),
pg AS (SELECT file_id, sum(n) AS n, max(r) + max(r) // 50 AS r FROM cells GROUP BY file_id)""", """
SELECT file_id, CAST(n + greatest(1, r // 51) AS BIGINT) AS celdas, CAST(greatest(r, greatest(1, r // 51) * 51 - 1) AS INTEGER) AS ultima_fila FROM pg""")
    s["grid_anchors"] = with_(GRID, 'SELECT file_id, "row", provincia FROM anch')
    cols = "file_id, provincia, periodo, anio, area, sexo, " + ", ".join(CORE_OUT)
    s["grid_core"] = with_(GRID, f"SELECT {cols} FROM core2", CORE_OUT)
    s["grid_panel"] = with_(GRID, f"SELECT provincia, periodo, anio, area, sexo, {', '.join(CORE_OUT)} FROM "
                                  f"(SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY pub_seq DESC) AS rn FROM core2) "
                                  f"WHERE rn = 1", CORE_OUT)
    s["clean_label"] = "WITH " + LABELS + "\nSELECT n_nationkey, variante, etiqueta, limpia FROM lc"
    pats = sorted(ENTITIES, key=lambda n: (-len(n), n))
    case = " ".join(f"WHEN contains(lower(limpia), '{p.lower()}') THEN '{p}'" for p in pats)
    s["canonical_entity"] = ("WITH " + LABELS + "\nSELECT n_nationkey, variante, CASE WHEN limpia = '' OR length(limpia) > 40 "
                             f"THEN NULL ELSE CASE {case} END END AS entidad FROM lc")
    s["entity_rows"] = ("WITH " + LABELS + "\nSELECT n_nationkey, variante, NOT (lower(limpia) IN ('urbana', 'rural', 'hombres', "
                        "'mujeres') OR contains(lower(limpia), 'total') OR contains(lower(limpia), 'no ind') OR "
                        "regexp_matches(lower(limpia), '^[0-9]')) AS valida FROM lc")
    s["safe_double"] = with_("""t AS (
  SELECT o_orderkey, CASE o_orderkey % 8
      WHEN 0 THEN format('{:,.2f}', o_totalprice) WHEN 1 THEN '..' WHEN 2 THEN '-'
      WHEN 3 THEN CAST(o_totalprice AS VARCHAR) || 'd' WHEN 4 THEN ' \t' || CAST(o_totalprice AS VARCHAR) || ' '
      WHEN 5 THEN replace(CAST(o_totalprice AS VARCHAR), '.', '_') WHEN 6 THEN 'n/d'
      ELSE CAST(o_totalprice AS VARCHAR) || 'e-2' END AS texto
  FROM orders),
c AS (SELECT o_orderkey, texto, replace(replace(trim(texto, ' \t'), ',', ''), '..', '') AS s FROM t)""", """
SELECT o_orderkey, texto, CASE WHEN s = '' OR s = '-' THEN NULL
  WHEN regexp_full_match(lower(s), '[+-]?(([0-9](_?[0-9])*(\\.([0-9](_?[0-9])*)?)?|\\.[0-9](_?[0-9])*)(e[+-]?[0-9](_?[0-9])*)?|inf|infinity|nan)')
  THEN TRY_CAST(replace(s, '_', '') AS DOUBLE) END AS valor FROM c""", ["valor"])
    s["parse_period_label"] = with_("""l AS (SELECT DISTINCT CASE o_orderkey % 5
      WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) || ' (octubre)' WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || ' (Abril)'
      WHEN 2 THEN CAST(year(o_orderdate) AS VARCHAR) || ' (R)' WHEN 3 THEN 'Año ' || CAST(year(o_orderdate) AS VARCHAR)
      ELSE 'Nota: cifras preliminares' END AS etiqueta FROM orders)""", """
SELECT etiqueta, CAST(regexp_extract(etiqueta, '([0-9]{4})', 1) AS INTEGER) AS anio,
       regexp_extract(etiqueta, '([0-9]{4})', 1) || '-' || CASE WHEN contains(lower(etiqueta), 'oct') THEN '10'
           WHEN contains(lower(etiqueta), 'abr') THEN '04' ELSE '08' END AS periodo
FROM l WHERE regexp_extract(etiqueta, '([0-9]{4})', 1) <> ''""")


SELECTED = ["tasa_desempleo_lag1", "tasa_participacion", "pct_subempleo", "empleo_informal_pct",
            "pct_sin_educacion", "pct_universitaria", "pct_jovenes_pea", "pct_mayores_pea",
            "pct_sector_primario", "pct_sector_secundario", "pct_empresa_grande",
            "brecha_desempleo_urb_rur", "brecha_desempleo_genero", "ratio_pea_urbana",
            "area_total", "area_urbana", "sexo_mujeres", "sexo_total",
            "pct_subempleo_lag1", "empleo_informal_pct_delta", "post_covid",
            "lag_x_post_covid", "lag_x_sexo_mujeres", "lag_x_area_urbana",
            "pib_crecimiento", "desempleo_juvenil_nacional", "mediana_salario",
            "ratio_terciario_primario", "educacion_alta"]


def unpivot_features(src: str, keys: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT {keys}, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}"
                                for c in SELECTED)


BASE_PRED = FEATURES + f""",
folds AS (SELECT DISTINCT periodo AS fold FROM features),
dy AS (SELECT * FROM features WHERE tasa_desempleo IS NOT NULL),
pp AS (SELECT periodo, count(*) AS n, sum(tasa_desempleo) AS sy FROM dy GROUP BY periodo),
pers_pred AS (
  SELECT {KEY}, d.periodo AS fold, tasa_desempleo AS real,
         greatest(coalesce(tasa_desempleo_lag1,
                           ((SELECT sum(sy) FROM pp) - pp.sy) / ((SELECT sum(n) FROM pp) - pp.n)), 0) AS predicho,
         'Persistencia' AS modelo
  FROM dy d JOIN pp USING (periodo)),
dx AS (SELECT * FROM dy WHERE tasa_desempleo_lag1 IS NOT NULL),
px AS (SELECT periodo, count(*) AS n, sum(tasa_desempleo_lag1) AS sx, sum(tasa_desempleo) AS sy,
              sum(tasa_desempleo_lag1 * tasa_desempleo_lag1) AS sxx, sum(tasa_desempleo_lag1 * tasa_desempleo) AS sxy
       FROM dx GROUP BY periodo),
tx AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM px),
fx AS (SELECT p.periodo, t.n - p.n AS n, t.sx - p.sx AS sx, t.sy - p.sy AS sy, t.sxx - p.sxx AS sxx, t.sxy - p.sxy AS sxy
       FROM px p, tx t),
fb AS (SELECT periodo, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS b, sx, sy, n FROM fx),
fab AS (SELECT periodo, b, (sy - b * sx) / n AS a FROM fb),
ols_pred AS (
  SELECT {KEY}, d.periodo AS fold, tasa_desempleo AS real, greatest(a + b * tasa_desempleo_lag1, 0) AS predicho,
         'MCO1' AS modelo
  FROM dx d JOIN fab USING (periodo)),
preds AS (SELECT * FROM pers_pred UNION ALL SELECT * FROM ols_pred),
met AS (
  SELECT modelo, fold AS periodo, CAST(count(*) AS BIGINT) AS n, avg(abs(real - predicho)) AS mae,
         sqrt(avg((real - predicho) * (real - predicho))) AS rmse,
         CASE WHEN count(*) <= 1 THEN 0.0
              WHEN var_pop(real) * count(*) = 0 THEN CASE WHEN sum((real - predicho) * (real - predicho)) = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1 - sum((real - predicho) * (real - predicho)) / (var_pop(real) * count(*)) END AS r2
  FROM preds GROUP BY modelo, fold),
summ AS (SELECT modelo, avg(mae) AS mae, avg(rmse) AS rmse, avg(r2) AS r2 FROM met GROUP BY modelo),
best AS (SELECT arg_min(modelo, (rmse, modelo)) AS modelo FROM summ)"""


# Ridge with alpha 1 on three standardised features in closed form (Cramer's rule), per period left out and, as 'final', on all rows.
RIDGE_FEW = FEATURES + """,
f3 AS (SELECT periodo, tasa_desempleo AS y, tasa_desempleo_lag1 AS x1, tasa_participacion AS x2, pct_subempleo AS x3 FROM features),
folds AS (SELECT DISTINCT periodo AS fold FROM f3 UNION ALL SELECT 'final'),
med AS (SELECT fold, quantile_cont(x1, 0.5) AS d1, quantile_cont(x2, 0.5) AS d2, quantile_cont(x3, 0.5) AS d3
        FROM folds JOIN f3 ON periodo <> fold GROUP BY fold),
filled AS (SELECT m.fold, f.periodo, f.y, coalesce(x1, d1) AS x1, coalesce(x2, d2) AS x2, coalesce(x3, d3) AS x3
           FROM med m CROSS JOIN f3 f WHERE f.y IS NOT NULL),
test AS (SELECT * FROM filled WHERE periodo = fold),
st AS (SELECT fold, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3,
              stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(x3) AS s3,
              covar_pop(x1, x2) AS v12, covar_pop(x1, x3) AS v13, covar_pop(x2, x3) AS v23,
              covar_pop(x1, y) AS v1, covar_pop(x2, y) AS v2, covar_pop(x3, y) AS v3
       FROM filled WHERE periodo <> fold GROUP BY fold),
eq AS (SELECT *, n + 1 AS a, n * v12 / (s1 * s2) AS b, n * v13 / (s1 * s3) AS c, n * v23 / (s2 * s3) AS d,
              n * v1 / s1 AS r1, n * v2 / s2 AS r2, n * v3 / s3 AS r3 FROM st),
w AS (SELECT *, a * (a * a - d * d) - b * (b * a - d * c) + c * (b * d - a * c) AS det,
             (r1 * (a * a - d * d) - b * (r2 * a - d * r3) + c * (r2 * d - a * r3)) / (a * (a * a - d * d) - b * (b * a - d * c) + c * (b * d - a * c)) AS w1,
             (a * (r2 * a - d * r3) - r1 * (b * a - d * c) + c * (b * r3 - r2 * c)) / (a * (a * a - d * d) - b * (b * a - d * c) + c * (b * d - a * c)) AS w2,
             (a * (a * r3 - r2 * d) - b * (b * r3 - r2 * c) + r1 * (b * d - a * c)) / (a * (a * a - d * d) - b * (b * a - d * c) + c * (b * d - a * c)) AS w3
      FROM eq)"""


def band_sql(col: str) -> str:
    return (f"CASE WHEN {col} < {LOW} THEN 'bajo' WHEN {col} < {HIGH} THEN 'moderado' ELSE 'critico' END")


def evaluation_sql(s: dict) -> None:
    s["lopo_split"] = with_(FEATURES, "SELECT periodo AS fold, CAST((SELECT count(*) FROM features) - count(*) AS BIGINT) AS n_train, "
                                      "CAST(count(*) AS BIGINT) AS n_test FROM features GROUP BY periodo")
    tr = FEATURES + ",\nfolds AS (SELECT DISTINCT periodo AS fold FROM features),\nfl AS (" + unpivot_features(
        "features", "periodo") + "),\ntrl AS (SELECT f.fold, l.feature, l.value FROM fl l JOIN folds f ON l.periodo <> f.fold)"
    s["fold_impute"] = with_(tr, "SELECT fold, feature, quantile_cont(value, 0.5) AS median FROM trl "
                                 "WHERE value IS NOT NULL GROUP BY fold, feature", ["median"])
    s["fold_scale"] = with_(tr + """,
med AS (SELECT fold, feature, quantile_cont(value, 0.5) AS median FROM trl WHERE value IS NOT NULL GROUP BY fold, feature),
imp AS (SELECT t.fold, t.feature, coalesce(t.value, m.median) AS value FROM trl t LEFT JOIN med m USING (fold, feature)),
sc AS (SELECT fold, feature, avg(value) AS media, stddev_pop(value) AS sd FROM imp GROUP BY fold, feature)""",
        "SELECT fold, feature, media, CASE WHEN sd = 0 OR sd IS NULL THEN 1.0 ELSE sd END AS escala FROM sc",
        ["media", "escala"])
    m6 = ["mae", "rmse", "r2"]
    s["lopo_persistence"] = with_(BASE_PRED, "SELECT periodo, n, mae, rmse, r2 FROM met WHERE modelo = 'Persistencia'", m6)
    s["lopo_ols1"] = with_(BASE_PRED, "SELECT periodo, n, mae, rmse, r2 FROM met WHERE modelo = 'MCO1'", m6)
    s["cv_predictions"] = with_(BASE_PRED, f"SELECT {KEY}, real, predicho, modelo FROM preds", ["real", "predicho"])
    s["cv_metrics"] = with_(BASE_PRED, "SELECT * FROM met", m6)
    s["sink_reports"] = s["cv_predictions"]
    s["sink_cv_detail"] = s["cv_metrics"]
    s["cv_summary"] = with_(BASE_PRED, """
SELECT s.modelo, s.mae, s.rmse, s.r2, s.modelo = (SELECT modelo FROM best) AS mejor, m.periodo, m.rmse AS rmse_periodo
FROM summ s LEFT JOIN met m ON m.modelo = s.modelo AND s.modelo = (SELECT modelo FROM best)""",
        m6 + ["rmse_periodo"])
    s["risk_accuracy"] = with_(BASE_PRED + f""",
rb AS (SELECT modelo, {band_sql('real')} AS riesgo_real, {band_sql('predicho')} AS riesgo_pred FROM preds)""", """
SELECT modelo, riesgo_real, avg(CAST(riesgo_real = riesgo_pred AS DOUBLE)) AS precision, CAST(count(*) AS BIGINT) AS soporte
FROM rb GROUP BY modelo, riesgo_real
UNION ALL
SELECT modelo, 'todas', avg(CAST(riesgo_real = riesgo_pred AS DOUBLE)), CAST(count(*) AS BIGINT) FROM rb GROUP BY modelo""",
        ["precision"])
    s["cv_matrix"] = with_(BASE_PRED, """
SELECT periodo,
  round(max(CASE WHEN modelo = 'MCO1' THEN rmse END), 4) AS MCO1_rmse, round(max(CASE WHEN modelo = 'MCO1' THEN mae END), 4) AS MCO1_mae,
  round(max(CASE WHEN modelo = 'MCO1' THEN r2 END), 4) AS MCO1_r2,
  round(max(CASE WHEN modelo = 'Persistencia' THEN rmse END), 4) AS Persistencia_rmse,
  round(max(CASE WHEN modelo = 'Persistencia' THEN mae END), 4) AS Persistencia_mae,
  round(max(CASE WHEN modelo = 'Persistencia' THEN r2 END), 4) AS Persistencia_r2
FROM met GROUP BY periodo""")
    s["lopo_ridge_few"] = with_(RIDGE_FEW, """
SELECT fold AS periodo, CAST(count(*) AS BIGINT) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
       CASE WHEN count(*) <= 1 THEN 0.0 WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
            ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2
FROM (SELECT t.fold, t.y, greatest(w.my + w1 / s1 * (t.x1 - m1) + w2 / s2 * (t.x2 - m2) + w3 / s3 * (t.x3 - m3), 0) AS p
      FROM test t JOIN w ON w.fold = t.fold) GROUP BY fold""", m6)
    s["linear_importance"] = with_(RIDGE_FEW, """
SELECT 'Ridge' AS modelo, feature, importancia, CAST(row_number() OVER (ORDER BY importancia DESC, feature) AS INTEGER) AS puesto
FROM (SELECT unnest(['tasa_desempleo_lag1', 'tasa_participacion', 'pct_subempleo']) AS feature, unnest([abs(w1), abs(w2), abs(w3)]) AS importancia
      FROM w WHERE fold = 'final')""", ["importancia"])
    s["sink_importances"] = s["linear_importance"]
    s["model_table"] = with_(BASE_PRED, """
SELECT modelo, mae, rmse, r2, mae = (SELECT min(mae) FROM summ) AS mejor_mae, rmse = (SELECT min(rmse) FROM summ) AS mejor_rmse,
       r2 = (SELECT max(r2) FROM summ) AS mejor_r2 FROM summ""", m6)


# ------------------------------------------------------------------ scoring / explanation / what-if
from panelkit.plans.common import EXPLAIN_ROW, FIXTURE_SLIDERS, INTERCEPT, SCENARIOS, WEIGHTS  # noqa: E402


def lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def linear_sql(fill: dict) -> str:
    return lit(INTERCEPT) + "".join(f" + {lit(w)} * coalesce({c}, {fill[c]})" for c, w in WEIGHTS.items())


MEDS = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in WEIGHTS)
SCORED = FEATURES + f""",
med AS (SELECT {MEDS} FROM features),
sc0 AS (SELECT f.provincia, f.periodo, f.area, f.sexo, f.anio, f.tasa_desempleo,
               {linear_sql({c: 'med.' + c for c in WEIGHTS}).replace('coalesce(', 'coalesce(f.')} AS raw
        FROM features f, med),
scored AS (SELECT provincia, periodo, area, sexo, anio, tasa_desempleo, greatest(raw, 0) AS prediccion,
                  tasa_desempleo - raw AS residuo, {band_sql('tasa_desempleo')} AS riesgo_real,
                  {band_sql('raw')} AS riesgo_predicho FROM sc0),
stot AS (SELECT * FROM scored WHERE area = 'total' AND sexo = 'total')"""

PHI = SCORED + f""",
filled AS (SELECT f.provincia, f.periodo, f.area, f.sexo, {", ".join(f"coalesce(f.{c}, med.{c}) AS {c}" for c in WEIGHTS)}
           FROM features f, med),
mu AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in WEIGHTS)} FROM filled),
phi AS (
  {" UNION ALL ".join(f"SELECT {KEY}, '{c}' AS feature, filled.{c} AS valor, {lit(w)} * (filled.{c} - mu.{c}) AS phi, "
                      f"{lit(INTERCEPT)}{''.join(f' + {lit(w2)} * mu.{c2}' for c2, w2 in WEIGHTS.items())} AS base FROM filled, mu"
                      for c, w in WEIGHTS.items())}),
gimp AS (SELECT feature, avg(abs(phi)) AS importancia FROM phi GROUP BY feature)"""


def scoring_sql(s: dict) -> None:
    sc_cols = ["tasa_desempleo", "prediccion", "residuo"]
    s["score_panel"] = with_(SCORED, "SELECT * FROM scored", sc_cols)
    s["sink_predictions"] = s["score_panel"]
    s["latest_predicted"] = with_(SCORED, "SELECT * FROM stot WHERE periodo = (SELECT max(periodo) FROM scored)", sc_cols)
    s["risk_band"] = with_(PANEL, f"SELECT {KEY}, {band_sql('tasa_desempleo')} AS riesgo, CASE WHEN tasa_desempleo IS NULL "
                                  f"THEN 'sin datos' ELSE {band_sql('tasa_desempleo')} END AS riesgo_mapa FROM panel")
    s["risk_kpis"] = with_(SCORED, "SELECT riesgo_real, CAST(count(*) AS BIGINT) AS n FROM stot WHERE periodo = "
                                   "(SELECT max(periodo) FROM scored) GROUP BY riesgo_real")
    s["risk_table"] = with_(SCORED, f"SELECT provincia, tasa_desempleo, prediccion, riesgo_real, riesgo_predicho FROM stot "
                                    f"WHERE periodo = '{PERIOD_PAIR[1]}'", ["tasa_desempleo", "prediccion"])
    s["residual_stats"] = with_(SCORED, "SELECT periodo, avg(residuo) AS residuo_medio, avg(abs(residuo)) AS residuo_abs_medio, "
                                        "CAST(count(residuo) AS BIGINT) AS n FROM scored GROUP BY periodo",
                                ["residuo_medio", "residuo_abs_medio"])
    s["real_vs_pred"] = with_(SCORED + f""",
one AS (SELECT * FROM stot WHERE periodo = '{PERIOD_PAIR[1]}')""", """
SELECT provincia, tasa_desempleo, prediccion, riesgo_real, riesgo_predicho,
       (SELECT least(min(tasa_desempleo), min(prediccion)) FROM one) AS lim_inf,
       (SELECT greatest(max(tasa_desempleo), max(prediccion)) FROM one) AS lim_sup FROM one""",
        ["tasa_desempleo", "prediccion", "lim_inf", "lim_sup"])
    ph = ["valor", "phi", "base"]
    s["explain_linear"] = with_(PHI, "SELECT * FROM phi", ph)
    s["explain_global"] = with_(PHI, "SELECT * FROM gimp ORDER BY importancia DESC, feature LIMIT 5", ["importancia"])
    e, p, a, x = EXPLAIN_ROW
    s["explain_text"] = with_(PHI + """,
t AS (SELECT * FROM phi WHERE area = 'total' AND sexo = 'total'),
r AS (SELECT *, row_number() OVER (PARTITION BY provincia, periodo, area, sexo ORDER BY abs(phi) DESC, feature) AS puesto FROM t)""", """
SELECT provincia, periodo, area, sexo,
  printf('Prediccion: %.2f%%', max(base) + sum(phi)) || chr(10) || printf('Valor base (promedio): %.2f%%', max(base)) || chr(10) || chr(10)
  || 'Top 3 factores que influyen en esta prediccion:' || chr(10)
  || string_agg(printf('  %d. %s: %s la prediccion en %.2f pp', puesto, feature, CASE WHEN phi > 0 THEN 'aumenta' ELSE 'disminuye' END, abs(phi)), chr(10) ORDER BY puesto)
       FILTER (WHERE puesto <= 3) AS explicacion
FROM r GROUP BY ALL""")
    s["explain_row"] = with_(PHI + f""",
r AS (SELECT *, CAST(row_number() OVER (ORDER BY abs(phi) DESC, feature) AS INTEGER) AS puesto FROM phi
      WHERE provincia = '{e}' AND periodo = '{p}' AND area = '{a}' AND sexo = '{x}')""", """
SELECT *, base + sum(phi) OVER (ORDER BY puesto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS acumulado
FROM r WHERE puesto <= 5""", ph + ["acumulado"])
    s["explain_dependence"] = with_(PHI + """,
top AS (SELECT feature FROM gimp ORDER BY importancia DESC, feature LIMIT 3)""", f"""
SELECT p.provincia, p.periodo, p.area, p.sexo, p.feature, p.valor, p.phi, f.tasa_participacion AS color
FROM phi p JOIN top USING (feature) JOIN features f USING (provincia, periodo, area, sexo)""", ["valor", "phi", "color"])
    model = " UNION ALL ".join(f"SELECT '{c}' AS feature, {lit(abs(w))} AS importancia" for c, w in WEIGHTS.items())
    s["importance_compare"] = with_(PHI + f""",
mdl AS ({model}),
t5 AS (SELECT * FROM gimp),
j AS (SELECT coalesce(m.feature, t.feature) AS feature, coalesce(m.importancia, 0) AS modelo, coalesce(t.importancia, 0) AS shap
      FROM mdl m FULL JOIN t5 t ON m.feature = t.feature)""",
        "SELECT *, modelo / (SELECT max(modelo) FROM j) AS modelo_rel, shap / (SELECT max(shap) FROM j) AS shap_rel FROM j",
        ["modelo", "shap", "modelo_rel", "shap_rel"])
    names = list(FIXTURE_SLIDERS)
    vals = ", ".join(f"({i}, '{e}', '{a}', '{x}', '{v}', {lit(val)})" for i, e, a, x, v, val in SCENARIOS)
    piv = ", ".join(f"max(CASE WHEN variable = '{n}' THEN value END) AS o_{n}" for n in names)
    clamp = ", ".join(f"CASE WHEN b.periodo IS NOT NULL THEN greatest({lit(lo)}, least({lit(hi)}, coalesce(pv.o_{n}, b.{n}))) END AS {n}"
                      for n, (lo, hi) in FIXTURE_SLIDERS.items())
    zero = {c: "0" for c in WEIGHTS}
    wi = FEATURES + f""",
base AS (SELECT * FROM features WHERE periodo = (SELECT max(periodo) FROM features)),
scn AS (SELECT * FROM (VALUES {vals}) t(scenario_id, provincia, area, sexo, variable, value)),
pv AS (SELECT scenario_id, provincia, area, sexo, {piv} FROM scn GROUP BY scenario_id, provincia, area, sexo),
j0 AS (SELECT pv.scenario_id, b.periodo IS NOT NULL AS found, b.* REPLACE ({clamp}, pv.provincia AS provincia, pv.area AS area, pv.sexo AS sexo)
       FROM pv LEFT JOIN base b ON b.provincia = pv.provincia AND b.area = pv.area AND b.sexo = pv.sexo),
j1 AS (SELECT * REPLACE (tasa_desempleo_lag1 * post_covid AS lag_x_post_covid,
                         tasa_desempleo_lag1 * sexo_mujeres AS lag_x_sexo_mujeres,
                         tasa_desempleo_lag1 * area_urbana AS lag_x_area_urbana,
                         pct_subempleo AS pct_subempleo_lag1) FROM j0),
wf AS (SELECT *, CASE WHEN found THEN {linear_sql(zero)} END AS prediccion FROM j1)"""
    s["what_if"] = with_(wi, f"""
SELECT scenario_id, provincia, area, sexo, periodo, tasa_desempleo AS tasa_real, prediccion,
       CASE WHEN found THEN {band_sql('prediccion')} END AS riesgo, prediccion - tasa_desempleo AS delta,
       CASE WHEN found THEN 'ok' ELSE 'sin fila base' END AS estado, {", ".join(names)} FROM wf""",
        ["tasa_real", "prediccion", "delta"] + names)
    s["scenario_values"] = with_(wi, " UNION ALL ".join(
        f"SELECT scenario_id, '{n}' AS variable, round({n}, 6) AS valor FROM wf" for n in names))
    s["row_profile"] = with_(PANEL + ATTRS, " UNION ALL ".join(
        f"SELECT provincia || ' - ' || periodo AS opcion, '{c}' AS variable, round(CAST({c} AS DOUBLE), 6) AS valor "
        f"FROM enriched WHERE provincia = '{e}' AND periodo = '{p}' AND area = '{a}' AND sexo = '{x}' AND {c} IS NOT NULL"
        for c in ENRICHED_NUM))


# ------------------------------------------------------------------ regions, sources, other grids, quality
# authalic function of the latitude on WGS84; e is the first eccentricity
_E = "0.0818191908426215"
AUTHALIC = (f"((1 - {_E} * {_E}) * (sin(radians({{0}})) / (1 - power({_E} * sin(radians({{0}})), 2)) "
            f"- ln((1 - {_E} * sin(radians({{0}}))) / (1 + {_E} * sin(radians({{0}})))) / (2 * {_E})))")
REGION_SQL = """rv AS (
  SELECT CASE WHEN n_nationkey % 5 = 0 THEN n_name WHEN n_nationkey = 24 THEN 'Nation 24 Comarca Indigena'
              ELSE 'Nation ' || CAST(n_nationkey AS VARCHAR) END AS region,
         CAST(n_nationkey % 4 AS INTEGER) AS level, 0 AS part, 0 AS ring, CAST(s AS INTEGER) AS seq,
         CAST(-80.0 AS DOUBLE) + (n_nationkey % 5) * CAST(1.0 AS DOUBLE)
           + (CAST(0.2 AS DOUBLE) + (n_nationkey % 3) * CAST(0.05 AS DOUBLE)) * cos(2 * pi() * s / (3 + n_nationkey % 5)) AS x,
         CAST(8.0 AS DOUBLE) + floor(n_nationkey / 5) * CAST(0.5 AS DOUBLE)
           + (CAST(0.2 AS DOUBLE) + (n_nationkey % 3) * CAST(0.05 AS DOUBLE)) * sin(2 * pi() * s / (3 + n_nationkey % 5)) AS y
  FROM (SELECT n_nationkey, n_name, unnest(range(0, 3 + n_nationkey % 5)) AS s FROM nation)),
edges AS (SELECT region, level, x, y,
                 coalesce(lead(x) OVER (PARTITION BY region ORDER BY seq), first_value(x) OVER (PARTITION BY region ORDER BY seq)) AS x2,
                 coalesce(lead(y) OVER (PARTITION BY region ORDER BY seq), first_value(y) OVER (PARTITION BY region ORDER BY seq)) AS y2
          FROM rv WHERE ring = 0),
pm0 AS (SELECT region, level, sum(x * y2 - x2 * y) / 2 AS a,
               sum(radians(x - x2) * (""" + AUTHALIC.format("y") + " + " + AUTHALIC.format("y2") + """)) / 4 * 6378.137 * 6378.137 AS km2, sum((x + x2) * (x * y2 - x2 * y)) AS cx,
               sum((y + y2) * (x * y2 - x2 * y)) AS cy, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax,
               CAST(count(*) AS BIGINT) AS vertices FROM edges GROUP BY region, level),
pm AS (SELECT region, level, vertices, abs(a) AS area_grados2, cx / (6 * a) AS centro_x, cy / (6 * a) AS centro_y,
              abs(km2) AS area_km2, xmin, xmax, ymin, ymax FROM pm0),
rmap AS (SELECT DISTINCT region, CASE WHEN region LIKE 'Nation %' THEN 'NATION_' || split_part(region, ' ', 2) ELSE region END AS provincia
         FROM rv)"""


def colour_sql(band: str) -> str:
    return (f"CASE {band} WHEN 'bajo' THEN '#2ecc71' WHEN 'moderado' THEN '#f39c12' WHEN 'critico' THEN '#e74c3c' "
            f"ELSE '#cccccc' END")


def nullsafe_band(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN 'sin datos' ELSE {band_sql(col)} END"


LINKS = r"""a0 AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a>') AS l FROM pages),
a1 AS (SELECT page_id, url, unnest(l) AS a, unnest(generate_series(0, len(l) - 1)) AS pos FROM a0),
a2 AS (SELECT page_id, url, CAST(pos AS INTEGER) AS pos,
              regexp_extract(a, '(?is)^<a\s[^>]*?\bhref\s*=\s*"([^"]*)"', 1) AS href0,
              regexp_matches(a, '(?is)^<a\s[^>]*?\bhref\s*=\s*"([^"]*)"') AS has_href,
              CASE WHEN regexp_matches(a, '(?is)^<a\s[^>]*?\btitle\s*=\s*"([^"]*)"')
                   THEN regexp_extract(a, '(?is)^<a\s[^>]*?\btitle\s*=\s*"([^"]*)"', 1) END AS title0,
              regexp_replace(regexp_extract(a, '(?is)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g') AS text0
       FROM a1),
a3 AS (SELECT page_id, url, pos,
              replace(replace(replace(replace(replace(replace(href0, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS href,
              replace(replace(replace(replace(replace(replace(title0, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS title,
              regexp_replace(replace(replace(replace(replace(replace(replace(text0, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS text
       FROM a2 WHERE has_href)"""


def misc_sql(s: dict) -> None:
    s["region_vertices"] = with_(REGION_SQL, "SELECT region, level, part, ring, seq, x, y FROM rv", ["x", "y"])
    pmc = ["area_grados2", "centro_x", "centro_y", "area_km2", "xmin", "xmax", "ymin", "ymax"]
    s["polygon_measures"] = with_(REGION_SQL, "SELECT * FROM pm", pmc)
    # closed form: n/2 r^2 sin(2 pi / n) for an outline, a quarter of it for its hole
    s["multipart_measures"] = with_("""
k AS (SELECT c_custkey AS k, 3 + c_custkey % 5 AS n, 0.2 + (c_custkey % 3) * 0.05 AS r,
             -80.0 + c_custkey % 5 AS cx, 8.0 + floor(c_custkey / 5) * 0.5 AS cy, c_custkey % 4 AS level FROM customer),
ar AS (SELECT *, n / 2.0 * r * r * sin(2 * pi() / n) AS a, CASE WHEN level % 2 = 0 THEN 1 ELSE 0 END AS isl FROM k)""", """
SELECT 'Zona ' || CAST(k AS VARCHAR) AS region,
       CAST(level AS INTEGER) AS level, CAST(n * (2 + isl) AS BIGINT) AS vertices, CAST(a * (0.75 + isl) AS DOUBLE) AS area_grados2,
       CAST((0.75 * cx + isl * (cx + 10)) / (0.75 + isl) AS DOUBLE) AS centro_x, CAST(cy AS DOUBLE) AS centro_y FROM ar""",
        ["area_grados2", "centro_x", "centro_y"])
    s["layer_profile"] = with_(REGION_SQL, """
SELECT level, CAST(count(*) AS BIGINT) AS regiones, min(xmin) AS xmin, max(xmax) AS xmax, min(ymin) AS ymin, max(ymax) AS ymax,
       min(area_km2) AS area_min, max(area_km2) AS area_max, avg(area_km2) AS area_media, sum(area_km2) AS area_total
FROM pm GROUP BY level""", ["xmin", "xmax", "ymin", "ymax", "area_min", "area_max", "area_media", "area_total"])
    s["geo_enrich"] = with_(TOT + ",\n" + REGION_SQL + """,
grid AS (SELECT m.region, m.provincia, p.periodo FROM rmap m CROSS JOIN (SELECT DISTINCT periodo FROM tot) p),
ge AS (SELECT g.region, g.provincia, g.periodo, t.tasa_desempleo FROM grid g LEFT JOIN tot t USING (provincia, periodo))""",
        f"SELECT *, {nullsafe_band('tasa_desempleo')} AS riesgo, {colour_sql(nullsafe_band('tasa_desempleo'))} AS color FROM ge",
        ["tasa_desempleo"])
    s["geo_export"] = with_(SCORED + ",\n" + REGION_SQL + """,
lp AS (SELECT * FROM stot WHERE periodo = (SELECT max(periodo) FROM scored)),
ex AS (SELECT m.region, l.tasa_desempleo, l.prediccion FROM rmap m LEFT JOIN lp l USING (provincia))""", f"""
SELECT region, CASE WHEN length(region) > 15 THEN substr(region, 1, 12) || '...' ELSE region END AS etiqueta,
       coalesce(round(tasa_desempleo, 2), 0.0) AS tasa_desempleo, coalesce(round(prediccion, 2), 0.0) AS prediccion,
       {nullsafe_band('tasa_desempleo')} AS riesgo_real, {nullsafe_band('prediccion')} AS riesgo_predicho,
       {colour_sql(nullsafe_band('prediccion'))} AS color FROM ex""")
    rb, pb = nullsafe_band("tasa_desempleo"), nullsafe_band("prediccion")
    s["geo_real_vs_pred"] = with_(SCORED + ",\n" + REGION_SQL + f""",
lp AS (SELECT * FROM stot WHERE periodo = '{PERIOD_PAIR[1]}'),
ex AS (SELECT m.region, m.provincia, l.tasa_desempleo, l.prediccion FROM rmap m LEFT JOIN lp l USING (provincia))""", f"""
SELECT region, provincia, '{PERIOD_PAIR[1]}' AS periodo, tasa_desempleo, prediccion, {rb} AS riesgo_real, {pb} AS riesgo_predicho,
       {colour_sql(rb)} AS color_real, {colour_sql(pb)} AS color_predicho,
       CASE WHEN tasa_desempleo IS NOT NULL AND prediccion IS NOT NULL THEN {rb} = {pb} END AS coincide FROM ex""", ["tasa_desempleo", "prediccion"])
    s["harvest_links"] = with_(LINKS, r"""
SELECT page_id, pos,
       CASE WHEN text <> '' THEN text WHEN coalesce(title, '') <> '' THEN title ELSE string_split(href, '/')[-1] END AS nombre,
       CASE WHEN starts_with(href, '../') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || '/' || replace(href, '../', '')
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || href
            WHEN NOT starts_with(href, 'http') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || '/' || href
            ELSE href END AS url_completa
FROM a3 WHERE contains(lower(href), '/de')""")
    rec = """rl AS (
  SELECT CASE l_returnflag || '_' || l_linestatus WHEN 'A_F' THEN 'NY.GDP.MKTP.KD.ZG' WHEN 'A_O' THEN 'FP.CPI.TOTL.ZG'
           WHEN 'N_F' THEN 'SL.UEM.1524.ZS' WHEN 'N_O' THEN 'NE.EXP.GNFS.ZS' WHEN 'R_F' THEN 'NY.GDP.PCAP.CD'
           WHEN 'R_O' THEN 'SP.POP.TOTL' END AS codigo,
         CAST(year(l_shipdate) AS INTEGER) AS anio, round(sum(l_extendedprice) / 1e6, 4) AS v
  FROM lineitem GROUP BY 1, 2),
recs AS (
  SELECT 'Panamá' AS pais, codigo, 'Indicador ' || codigo AS indicador, anio,
         nullif(CASE WHEN codigo = 'NY.GDP.MKTP.KD.ZG' AND anio = (SELECT min(anio) FROM rl) THEN 0.0 ELSE v END, 0) AS valor
  FROM rl)"""
    s["indicator_records"] = with_(rec, "SELECT * FROM recs", ["valor"])
    s["indicator_wide"] = with_(rec, "SELECT codigo, indicador, " + ", ".join(
        f"round(min(CASE WHEN anio = {y} THEN valor END), 6) AS \"{y}\"" for y in YEARS) + " FROM recs WHERE valor IS NOT NULL GROUP BY codigo, indicador")
    s["indicator_files"] = with_(rec, """
SELECT codigo, CAST(count(*) AS BIGINT) AS registros, CAST(count(valor) AS BIGINT) AS con_valor, max(pais) AS pais, round(sum(valor), 4) AS suma_larga,
       CASE WHEN count(valor) > 0 THEN max(indicador) END AS indicador, CASE WHEN count(valor) > 0 THEN CAST(count(valor) AS BIGINT) END AS celdas,
       round(sum(valor), 4) AS suma_ancha
FROM recs GROUP BY codigo""")
    s["indicator_file_wide"] = with_(rec, "SELECT codigo, indicador, anio, valor FROM recs WHERE valor IS NOT NULL", ["valor"])
    s["macro_file"] = with_(PANEL + ATTRS, "SELECT * FROM macro", MACRO_COLS)
    s["indicator_coverage"] = with_(rec, """
SELECT codigo, CAST(count(valor) AS BIGINT) AS anios_con_dato, CAST(count(DISTINCT anio) AS BIGINT) AS anios_en_registro,
       (SELECT CAST(count(DISTINCT anio) AS BIGINT) FROM recs) AS anios_total,
       count(valor) = (SELECT count(DISTINCT anio) FROM recs) AS completo
FROM recs GROUP BY codigo""")
    s["indicators_per_year"] = with_(rec, "SELECT anio, CAST(count(DISTINCT codigo) AS BIGINT) AS indicadores FROM recs GROUP BY anio")
    ids = ", ".join(f"({i}, '{c}')" for i, c in enumerate(["2", "4", "6", "13", "16", "19", "22", "25", "39", "1A"]))
    s["locate_report"] = with_(GRID + f""",
ids AS (SELECT * FROM (VALUES {ids}) t(n, cuadro)),
pubs AS (SELECT DISTINCT pub_seq FROM reg0)""", """
SELECT 'pub_' || lpad(CAST(pub_seq AS VARCHAR), 3, '0') AS folder, cuadro,
       CASE pub_seq % 4 WHEN 0 THEN 'Cuadro ' || cuadro || '. Poblacion ocupada.xlsx'
                        WHEN 1 THEN 'Cuadro ' || cuadro || ' . Poblacion.xls'
                        WHEN 2 THEN 'CUADRO ' || cuadro || '. POBLACION.XLSX'
                        ELSE 'P' || CAST(pub_seq AS VARCHAR) || '1441-' || lpad(CAST(n + 1 AS VARCHAR), 2, '0') || '.xls' END AS archivo,
       CAST(pub_seq % 4 + 1 AS INTEGER) AS prioridad
FROM pubs CROSS JOIN ids""")
    s["src_panel"] = s["build_panel"]
    s["sink_roundtrip"] = with_(PANEL + ATTRS, "SELECT * FROM enriched",
                                dbl(PANEL_NUM + ORDER_ATTRS + LINE_ATTRS + ["mediana_salario"] + MACRO_COLS))
    s["stream_consolidate"] = s["vintage_latest"]
    nat = PANEL + """,
nt AS (SELECT periodo, anio, sum(poblacion_15_mas) AS pob, sum(pea) AS pea, sum(ocupados) AS ocu, sum(desocupados) AS des
       FROM panel WHERE area = 'total' AND sexo = 'total' GROUP BY periodo, anio),
ns AS (SELECT anio,
              CAST(anio AS VARCHAR) || '-' || CASE WHEN substr(periodo, 6, 2) = '03' THEN '04' ELSE '08' END AS periodo,
              CASE WHEN substr(periodo, 6, 2) = '03' THEN CAST(anio AS VARCHAR) || ' (abril)'
                   WHEN anio % 2 = 0 THEN CAST(anio AS VARCHAR) || ' (R)' ELSE CAST(anio AS VARCHAR) END AS etiqueta_original,
              CAST(pob AS DOUBLE) AS poblacion_15_mas, CAST(pea AS DOUBLE) AS pea,
              CAST(pea AS DOUBLE) * 100 / pob AS tasa_participacion, CAST(ocu AS DOUBLE) AS ocupados,
              CAST(des AS DOUBLE) AS desocupados, CAST(des AS DOUBLE) * 100 / pea AS tasa_desempleo,
              CAST(pob - pea AS DOUBLE) AS no_economicamente_activa FROM nt)"""
    s["national_series"] = with_(nat, "SELECT * FROM ns", ["poblacion_15_mas", "pea", "tasa_participacion", "ocupados",
                                                             "desocupados", "tasa_desempleo", "no_economicamente_activa"])
    s["sink_national"] = with_(nat, "SELECT *, CAST(row_number() OVER (ORDER BY anio, periodo) - 1 AS BIGINT) AS fila FROM ns",
                               ["poblacion_15_mas", "pea", "tasa_participacion", "ocupados", "desocupados", "tasa_desempleo", "no_economicamente_activa"])
    s["national_range"] = with_(nat, """
SELECT min(anio) AS anio_min, max(anio) AS anio_max, arg_max(periodo, (anio, periodo)) AS ultimo_periodo,
       round(arg_max(tasa_desempleo, (anio, periodo)), 6) AS ultima_tasa FROM ns""")
    sec = ["pct_sector_primario", "pct_sector_secundario", "pct_sector_terciario"]
    s["sector_shares"] = with_(GRID + ATTRS + """,
fe13 AS (SELECT DISTINCT r.pub_seq, l.provincia FROM lattr l JOIN reg r ON l.periodo = r.periodo)""", """
SELECT 'c13_' || lpad(CAST(r.pub_seq AS VARCHAR), 3, '0') AS file_id, fe.provincia, r.periodo, r.anio,
       l.pct_sector_primario, l.pct_sector_secundario, l.pct_sector_terciario
FROM fe13 fe JOIN reg r ON r.pub_seq = fe.pub_seq
LEFT JOIN lattr l ON l.provincia = fe.provincia AND l.periodo = r.periodo""", sec)
    s["grid_informal"] = with_(GRID + ATTRS + """,
fe39 AS (SELECT DISTINCT r.pub_seq, o.provincia FROM oattr o JOIN reg r ON o.periodo = r.periodo
         JOIN nation n ON n.n_name = o.provincia WHERE n.n_nationkey < 19),
inf AS (SELECT fe.provincia, r.periodo, r.anio, r.pub_seq,
               CASE WHEN fe.provincia = 'NATION_3' THEN o.empleo_informal_pct + 1 ELSE o.empleo_informal_pct END AS v
        FROM fe39 fe JOIN reg r ON r.pub_seq = fe.pub_seq
        LEFT JOIN oattr o ON o.provincia = fe.provincia AND o.periodo = r.periodo)""",
        "SELECT provincia, periodo, anio, v AS empleo_informal_pct FROM (SELECT *, row_number() OVER (PARTITION BY provincia, "
        "periodo ORDER BY pub_seq DESC) AS rn FROM inf) WHERE rn = 1", ["empleo_informal_pct"])


def quality_sql(s: dict) -> None:
    feat_cols = (4 + len(ENRICHED_NUM) + len(CONTRAST) + 2 + len(LAGS) + len(DELTAS) + len(RATIOS)
                 + len(INTERACTIONS) + len(DUMMY_COLS))
    panel_cols = 4 + len(ENRICHED_NUM)
    n_dum = sum(c.startswith("prov_") for c in DUMMY_COLS)
    s["quality_report"] = with_(SCORED + BASE_PRED[len(FEATURES):], f"""
SELECT 'no_vacio' AS "check", count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS observed, 'panel' AS tabla FROM panel
UNION ALL SELECT 'min_entidades', count(DISTINCT provincia) >= 10, CAST(count(DISTINCT provincia) AS VARCHAR), 'panel' FROM panel
UNION ALL SELECT 'min_periodos', count(DISTINCT periodo) >= 5, CAST(count(DISTINCT periodo) AS VARCHAR), 'panel' FROM panel
UNION ALL SELECT 'tasa_en_rango', coalesce(bool_and(tasa_desempleo BETWEEN 0 AND 100), true),
                 CAST(count(*) FILTER (WHERE NOT tasa_desempleo BETWEEN 0 AND 100) AS VARCHAR), 'panel' FROM panel
UNION ALL SELECT 'pea_no_negativa', coalesce(bool_and(pea >= 0), true), CAST(min(pea) AS VARCHAR), 'panel' FROM panel
UNION ALL SELECT 'areas_presentes', list_sort(list(DISTINCT area)) @> ['total', 'urbana', 'rural'],
                 array_to_string(list_sort(list(DISTINCT area)), ','), 'panel' FROM panel
UNION ALL SELECT 'sexos_presentes', list_sort(list(DISTINCT sexo)) @> ['total', 'hombres', 'mujeres'],
                 array_to_string(list_sort(list(DISTINCT sexo)), ','), 'panel' FROM panel
UNION ALL SELECT 'clave_unica', count(DISTINCT (provincia, periodo, area, sexo)) = count(*),
                 CAST(count(*) - count(DISTINCT (provincia, periodo, area, sexo)) AS VARCHAR), 'panel' FROM panel
UNION ALL SELECT 'sin_nan', count(*) FILTER (WHERE isnan(tasa_desempleo)) = 0,
                 CAST(count(*) FILTER (WHERE isnan(tasa_desempleo)) AS VARCHAR), 'panel' FROM panel
UNION ALL SELECT 'columnas_requeridas', true, 'ok', 'panel'
UNION ALL SELECT 'mas_columnas', {feat_cols} > {panel_cols}, '{feat_cols}', 'features'
UNION ALL SELECT 'tiene_lags', true, '{len(LAGS)}', 'features'
UNION ALL SELECT 'tiene_interacciones', true, '{len(INTERACTIONS)}', 'features'
UNION ALL SELECT 'tiene_dummies', true, '{n_dum}', 'features'
UNION ALL SELECT 'post_covid_binaria', coalesce(bool_and(post_covid IN (0, 1)), true),
                 array_to_string(list_sort(list(DISTINCT CAST(post_covid AS VARCHAR))), ','), 'features' FROM features
UNION ALL SELECT 'predicciones_no_negativas', coalesce(bool_and(prediccion >= 0), true),
                 CAST(count(*) FILTER (WHERE prediccion < 0) AS VARCHAR), 'predicciones' FROM scored
UNION ALL SELECT 'min_modelos', count(*) >= 2, CAST(count(*) AS VARCHAR), 'predicciones' FROM summ
UNION ALL SELECT 'r2_positivo', max(r2) > 0, printf('%.4f', max(r2)), 'predicciones' FROM summ
UNION ALL SELECT 'rmse_acotado', min(rmse) < 5, printf('%.4f', min(rmse)), 'predicciones' FROM summ""")


def poly_sql(coefficients: list[float], x: str) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + CAST({c!r} AS DOUBLE))"
    return out


def erfc_sql(x: str, y: str) -> str:
    """Complementary error function of the column ``x`` with absolute value ``y``."""
    q = f"(1 / ({y} * {y}))"
    above = (f"CASE WHEN {y} <= 4 THEN exp(-{y} * {y}) * {poly_sql(nm.ERFC_NUM, y)} / {poly_sql(nm.ERFC_DEN, y)} "
             f"ELSE exp(-{y} * {y}) / {y} * (1 / sqrt(pi()) - {q} * {poly_sql(nm.TAIL_NUM, q)} / {poly_sql(nm.TAIL_DEN, q)}) END")
    near = f"1 - {x} * {poly_sql(nm.ERF_NUM, f'({y} * {y})')} / {poly_sql(nm.ERF_DEN, f'({y} * {y})')}"
    return f"CASE WHEN {y} <= 0.46875 THEN {near} WHEN {x} > 0 THEN {above} ELSE 2 - ({above}) END"


def qq_sql(s: dict) -> None:
    s["qq_positions"] = with_(TOT + """,
d AS (SELECT tasa_desempleo AS v FROM tot WHERE tasa_desempleo IS NOT NULL),
o AS (SELECT CAST(row_number() OVER (ORDER BY v) AS BIGINT) AS i, v AS valor, count(*) OVER () AS n FROM d)""", """
SELECT i, valor, CASE WHEN i = 1 THEN 1 - power(0.5, 1.0 / n) WHEN i = n THEN power(0.5, 1.0 / n)
                      ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o""", ["valor", "p"])

    # the quantile by bisection on erfc, which needs no approximation of its own
    s["qq_points"] = with_(TOT + f""",
d AS (SELECT tasa_desempleo AS v FROM tot WHERE tasa_desempleo IS NOT NULL),
o AS (SELECT CAST(row_number() OVER (ORDER BY v) AS BIGINT) AS i, v AS valor, count(*) OVER () AS n FROM d),
q AS (SELECT i, valor, CASE WHEN i = 1 THEN 1 - power(0.5, 1.0 / n) WHEN i = n THEN power(0.5, 1.0 / n)
                            ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o),
halving AS (
  SELECT i, valor, p, -9.0::DOUBLE AS lo, 9.0::DOUBLE AS hi, 0 AS k FROM q
  UNION ALL
  SELECT i, valor, p, CASE WHEN below < p THEN mid ELSE lo END, CASE WHEN below < p THEN hi ELSE mid END, k + 1
  FROM (SELECT *, ({erfc_sql('x', 'y')}) / 2 AS below FROM (
    SELECT *, (lo + hi) / 2 AS mid, -(lo + hi) / 2 / sqrt(2) AS x, abs((lo + hi) / 2 / sqrt(2)) AS y FROM halving WHERE k < 60) a) b)""",
        "SELECT i, valor, p, CASE WHEN abs(lo + hi) < 1e-9 THEN 0.0 ELSE (lo + hi) / 2 END AS teorico FROM halving WHERE k = 60", ["valor", "p", "teorico"]).replace("WITH ", "WITH RECURSIVE ", 1)
