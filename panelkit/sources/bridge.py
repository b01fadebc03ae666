"""Fixture bridge: derive panel-shaped inputs from the TPC-H-style tables.

The panel operators need a regional panel (entity x period x area x sex),
entity-period attribute tables, a wide year table, publication vintages,
report grids and region shapes.  This module derives all of them from
``/root/testdata`` with plain DataFrame jobs, so every query's work grows
with the input tables.

Mapping (fixed rules of the fixture):
  entity     = nation name of the ordering customer
  period     = order year + "-03" (January-June) or "-08" (July-December)
  area       = order priority 1-2 -> urbana, else rural
  sex        = market segment AUTOMOBILE/MACHINERY -> hombres, else mujeres
  population = orders, labour force = orders not in status P,
  unemployed = orders in status F, rate = 100 * unemployed / labour force
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.quantiles import exact_median
from panelkit.sources.tables import Tables
from panelkit.spec import DEFAULT_SPEC, PanelSpec

# Fixed values of the fixture mapping.
URBAN_PRIORITIES = ("1", "2")
MEN_SEGMENTS = ("AUTOMOBILE", "MACHINERY")
# line flag_status -> macro indicator code; two codes are left without a source
MACRO_SOURCE = {
    "A_F": "NY.GDP.MKTP.KD.ZG",
    "A_O": "FP.CPI.TOTL.ZG",
    "N_F": "SL.UEM.1524.ZS",
    "N_O": "NE.EXP.GNFS.ZS",
    "R_F": "NY.GDP.PCAP.CD",
    "R_O": "SP.POP.TOTL",
}


def period_of(ts) -> F.Column:
    y = F.year(ts).cast("string")
    return F.concat(y, F.when(F.month(ts) <= 6, F.lit("-03")).otherwise(F.lit("-08")))


def order_facts(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One row per order with its panel coordinates.

    nation (25 rows, fixed by the schema) is broadcast; orders x customer is
    a key join that Spark plans as a sort-merge join at scale (AQE splits
    skewed customer keys) and as a broadcast when customer is small.
    """
    n = F.broadcast(t.nation.select("n_nationkey", "n_name"))
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                        "o_orderpriority", "o_totalprice")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("n_name").alias(spec.entity),
        period_of(F.col("o_orderdate")).alias(spec.period),
        F.year("o_orderdate").cast("int").alias(spec.year),
        F.when(F.substring("o_orderpriority", 1, 1).isin(*URBAN_PRIORITIES), F.lit(spec.urban))
         .otherwise(F.lit(spec.rural)).alias(spec.area),
        F.when(F.col("c_mktsegment").isin(*MEN_SEGMENTS), F.lit(spec.men))
         .otherwise(F.lit(spec.women)).alias(spec.sex),
        F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice"),
    )


def order_cube(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One partial aggregation of the order facts at the finest panel grain
    (entity, period, area, sex) with every count the panel and the
    order-level attribute tables need.  Both are rolled up from this small
    result (materialised once per table accessor), so the order fact join
    is scanned once."""
    e, p, y, a, s = spec.entity, spec.period, spec.year, spec.area, spec.sex
    pri = F.substring("o_orderpriority", 1, 1)
    return t.derived(f"order_cube:{spec}", lambda: order_facts(t, spec).groupBy(e, p, y, a, s).agg(
        F.count(F.lit(1)).alias("_pob"),
        F.count_if(F.col("o_orderstatus") != "P").alias("_pea"),
        F.count_if(F.col("o_orderstatus") == "F").alias("_des"),
        *[F.count_if(pri == str(k)).alias(f"_p{k}") for k in range(1, 6)],
    ))


def build_panel(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Panel with marginal 'total' members.

    Counts come pre-aggregated at the finest grain (``order_cube``); the
    four grouping sets run over that small result, so the fact scan is
    never expanded 4x.
    """
    e, p, y, a, s = spec.entity, spec.period, spec.year, spec.area, spec.sex
    fine = order_cube(t, spec)
    sets = fine.groupingSets([[e, p, y, a, s], [e, p, y, a], [e, p, y, s], [e, p, y]], e, p, y, a, s)
    rolled = sets.agg(
        F.sum("_pob").cast("bigint").alias(spec.population),
        F.sum("_pea").cast("bigint").alias(spec.labour_force),
        F.sum("_des").cast("bigint").alias(spec.unemployed),
    )
    pob, pea, des = F.col(spec.population), F.col(spec.labour_force), F.col(spec.unemployed)
    return rolled.select(
        e, p, y,
        F.coalesce(F.col(a), F.lit(spec.total)).alias(a),
        F.coalesce(F.col(s), F.lit(spec.total)).alias(s),
        pob, pea, (pea - des).alias(spec.employed), des,
        F.when(pea > 0, des * 100.0 / pea).alias(spec.target),
        F.when(pob > 0, pea * 100.0 / pob).alias(spec.participation),
    )


def _share(cond, denom) -> F.Column:
    return F.when(denom > 0, F.count_if(cond) * 100.0 / denom)


def _pct(num, den) -> F.Column:
    return F.when(den > 0, num * 100.0 / den)


def order_attributes(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Entity-period attributes from orders, rolled up from ``order_cube``:
    activity rates (table 6), education shares by priority (16),
    informality (39)."""
    e, p = spec.entity, spec.period
    urb = F.col(spec.area) == spec.urban
    pob, pea = F.sum("_pob"), F.sum("_pea")
    pob_u, pea_u = F.sum(F.when(urb, F.col("_pob"))), F.sum(F.when(urb, F.col("_pea")))
    pob_r, pea_r = F.sum(F.when(~urb, F.col("_pob"))), F.sum(F.when(~urb, F.col("_pea")))
    return order_cube(t, spec).groupBy(e, p).agg(
        _pct(pea, pob).alias("tasa_actividad_total"),
        _pct(pea_u, pob_u).alias("tasa_actividad_urbana"),
        _pct(pea_r, pob_r).alias("tasa_actividad_rural"),
        _pct(F.sum("_p5"), pob).alias("pct_sin_educacion"),
        _pct(F.sum("_p3"), pob).alias("pct_primaria"),
        _pct(F.sum("_p2"), pob).alias("pct_secundaria"),
        _pct(F.sum("_p1"), pob).alias("pct_universitaria"),
        _pct(F.sum("_p4"), pob).alias("empleo_informal_pct"),
    )


def wage_attributes(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Median order value per entity-period (table 25), exact and skew-safe."""
    f = order_facts(t, spec)
    return exact_median(f, [spec.entity, spec.period], "o_totalprice", "mediana_salario")


def line_facts(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Line items with the panel coordinates of their order and part size.

    lineitem x orders is the one fact-fact join (on the order key); part is
    joined on its key.  Both are left to the planner (sort-merge at scale,
    broadcast when a side is measured small by AQE)."""
    o = order_facts(t, spec).select(spec.entity, spec.period, "o_orderkey")
    pt = t.part.select("p_partkey", "p_size")
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(pt, li.l_partkey == pt.p_partkey)
              .select(spec.entity, spec.period, "l_quantity", "l_returnflag", "p_size"))


def line_attributes(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Entity-period attributes from line items, one aggregation: age bands
    (table 4), sectors (13), under-employment (19), company size (22)."""
    e, p = spec.entity, spec.period
    f = line_facts(t, spec)
    n = F.count(F.lit(1))
    q = F.col("l_quantity")
    return f.groupBy(e, p).agg(
        _share(F.col("p_size") <= 10, n).alias("pct_jovenes_pea"),
        _share(F.col("p_size") > 40, n).alias("pct_mayores_pea"),
        _share(F.col("l_returnflag") == "A", n).alias("pct_sector_primario"),
        _share(F.col("l_returnflag") == "N", n).alias("pct_sector_secundario"),
        _share(F.col("l_returnflag") == "R", n).alias("pct_sector_terciario"),
        _share(q < 25, n).alias("pct_subempleo"),
        _share(q < 5, n).alias("pct_microempresa"),
        _share(q >= 50, n).alias("pct_empresa_grande"),
    )


def attribute_sources(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    """The three aggregations the eight report tables come from.  Enrichment
    takes these whole: a per-report projection would be column-pruned into
    a separate plan per report and the line-item join would run once per
    report instead of once."""
    return {"orders": order_attributes(t, spec), "lines": line_attributes(t, spec),
            "wage": wage_attributes(t, spec)}


def macro_long(t: Tables) -> DataFrame:
    """Indicator values (_code, _row, _year, _val) from one pass over the line
    items: line revenue in millions by ship year for one
    return-flag/line-status combination; ``_row`` = source row order."""
    li = t.lineitem.select(F.concat("l_returnflag", F.lit("_"), "l_linestatus").alias("_src"),
                           F.year("l_shipdate").alias("_year"), "l_extendedprice").where("_year IS NOT NULL")
    code = F.create_map(*[F.lit(x) for kv in MACRO_SOURCE.items() for x in kv])
    order = F.create_map(*[F.lit(x) for i, c in enumerate(MACRO_SOURCE.values()) for x in (c, i)])
    sums = li.groupBy(code[F.col("_src")].alias("_code"), "_year").agg((F.sum("l_extendedprice") / 1e6).alias("_val"))
    return sums.select("_code", order[F.col("_code")].alias("_row"), "_year", "_val")


def macro_wide(t: Tables) -> DataFrame:
    """Wide indicator table: one row per code, one column per year (as text),
    plus ``_row`` = source row order."""
    long = t.derived("macro_long", lambda: macro_long(t))
    years = sorted(str(r[0]) for r in long.select("_year").distinct().collect())  # the calendar of the data
    wide = long.where("_code IS NOT NULL").groupBy(F.col("_code").alias("codigo_indicador"), "_row").pivot("_year", [int(y) for y in years]).agg(F.first("_val"))
    return wide.select("codigo_indicador", "_row", *years)


def publication_seq(period_col) -> F.Column:
    """Publication number of a period label 'YYYY-MM': two per year, in order."""
    yr = F.substring(period_col, 1, 4).cast("int")
    return ((yr - 1990) * 2 + (F.substring(period_col, 6, 2) > "06").cast("int")).cast("int")


def vintages(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Publication vintages of the panel.

    Publication k reports its own period (preliminary: rate + 0.5, one more
    unemployed) and revises the previous period (final values).  The
    revision omits the rural/women cells, so for those keys the preliminary
    value survives a keep-last consolidation.  ``row`` = position in the
    publication (a stable hash of the cell)."""
    p = build_panel(t, spec)
    seq = publication_seq(F.col(spec.period))
    row = (F.xxhash64(spec.entity, spec.area, spec.sex) % 100000).cast("int")
    prelim = p.withColumns({
        spec.target: F.col(spec.target) + 0.5,
        spec.unemployed: F.col(spec.unemployed) + 1,
        "pub_seq": seq, "row": row,
    })
    final = (p.where(~((F.col(spec.area) == spec.rural) & (F.col(spec.sex) == spec.women)))
              .withColumns({"pub_seq": seq + 1, "row": row}))
    return prelim.unionByName(final)


# ------------------------------------------------------------------ report grids
COMARCA_FROM_KEY = 22  # nations 22-24 play the total-only entities ("comarcas")
GRID_HEADER = [  # (row, col, text): title, captions and decoy labels above the first block
    (0, 0, "Cuadro 2. Población de 15 y más años por condición de actividad según NATION_0 y área"),
    (1, 0, "Provincia, área y sexo"),
    (2, 0, "TOTAL"), (2, 1, "1"),
    (3, 0, "15-19"), (3, 1, "1"),
    (4, 0, "Urbana"), (4, 1, "1"),
    (5, 0, "Total NATION_0"), (5, 1, "1"),
    (6, 0, "República de NATION_0 y sus provincias y comarcas indígenas"), (6, 1, "1"),
    (7, 0, "Nota NATION_1"),
]
PAGE_ROWS = 50  # a '(Continuación)' row after every 50 rows of content


def entity_patterns(names: list[str]) -> list[tuple[str, str]]:
    """Ordered (pattern, canonical) list: longer names first so that a
    name that is a prefix of another never wins (NATION_1 vs NATION_10)."""
    return [(n, n) for n in sorted(names, key=lambda n: (-len(n), n))]


def decorate(name: F.Column, k: F.Column) -> F.Column:
    """Label decorations seen in reports: trailing dot leaders, ellipsis,
    middle dots, case and leading blanks."""
    m = k % 4
    return (F.when(m == 0, name)
             .when(m == 1, F.concat(name, F.lit(" ..........")))
             .when(m == 2, F.concat(F.lit("  "), F.lower(name), F.lit("…")))
             .otherwise(F.concat(name, F.lit(" ··"))))


def _layout_of(seq: F.Column) -> F.Column:
    return F.when(seq % 3 == 0, F.lit("expanded")).when(seq % 3 == 1, F.lit("compact")).otherwise(F.lit("format_b"))


def grid_registry(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Publication registry — file s reports period s (current) and
    period s-1 (previous); columns: previous at 2-4, current at 5-7 (or the
    only period at 2-4); sector percentages at 3 (previous) / 4 (current)."""
    p = build_panel(t, spec).select(spec.period, spec.year).distinct()
    seq = publication_seq(F.col(spec.period))
    reg = (p.select(spec.period, spec.year, seq.alias("pub_seq"), F.lit("cur").alias("role"))
             .unionByName(p.select(spec.period, spec.year, (seq + 1).alias("pub_seq"), F.lit("prev").alias("role"))))
    n = reg.groupBy("pub_seq").agg(F.count(F.lit(1)).alias("_np"))
    reg = reg.join(n, "pub_seq")
    first = (F.col("role") == "prev") | (F.col("_np") == 1)
    return reg.select(
        F.concat(F.lit("c2_"), F.format_string("%03d", F.col("pub_seq").cast("int"))).alias("file_id"),
        "pub_seq", _layout_of(F.col("pub_seq")).alias("layout"), "role",
        F.col(spec.period).alias("periodo"), F.col(spec.year).alias("anio"),
        F.when(first, F.lit(2)).otherwise(F.lit(5)).alias("col_total"),
        F.when(first, F.lit(3)).otherwise(F.lit(4)).alias("col_pct"),
    )


def _page(row: F.Column) -> F.Column:
    return (row + F.floor(row / PAGE_ROWS)).cast("int")


def _fmt(v: F.Column, measure: F.Column) -> F.Column:
    txt = F.when(measure == "tasa_desempleo", F.format_string("%.12f", v.cast("double"))) \
           .otherwise(F.format_number(v.cast("double"), 0))
    return F.coalesce(txt, F.lit(".."))


def core_grid(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Report grid of the core table: each publication written at the layout
    offsets (current period preliminary, previous period revised, the
    revision without rural/women cells), with decorated labels, a decoy
    label inside every block, sub-block captions, header decoys and
    page-break rows.  Long format (file_id, row, col, text)."""
    from panelkit.operators.grid import LAYOUTS, SEXES
    p = build_panel(t, spec)
    seq = publication_seq(F.col(spec.period))
    cur = p.select(*spec.key, seq.alias("pub_seq"),
                   F.col(spec.population).alias("poblacion_15_mas"), F.col(spec.labour_force).alias("pea"),
                   F.col(spec.employed).alias("ocupados"), (F.col(spec.unemployed) + 1).alias("desocupados"),
                   (F.col(spec.target) + 0.5).alias("tasa_desempleo"))
    prev = (p.where(~((F.col(spec.area) == spec.rural) & (F.col(spec.sex) == spec.women)))
             .select(*spec.key, (seq + 1).alias("pub_seq"),
                     F.col(spec.population).alias("poblacion_15_mas"), F.col(spec.labour_force).alias("pea"),
                     F.col(spec.employed).alias("ocupados"), F.col(spec.unemployed).alias("desocupados"),
                     F.col(spec.target).alias("tasa_desempleo")))
    reg = grid_registry(t, spec).select("file_id", "pub_seq", "layout", "periodo", "col_total")
    nat = F.broadcast(t.nation.select(F.col("n_name").alias(spec.entity), F.col("n_nationkey").alias("_k")))
    rows = cur.unionByName(prev).join(reg, ["pub_seq", "periodo"]).join(nat, spec.entity)

    sub = F.lit(0)
    areas = F.lit(True)
    offs = {}
    for name, lay in LAYOUTS.items():
        sub = F.when(F.col("layout") == name, F.lit(lay["sub"])).otherwise(sub)
        areas = F.when(F.col("layout") == name, F.lit(lay["areas"])).otherwise(areas)
    comarca = F.col("_k") >= COMARCA_FROM_KEY
    block = F.when(areas, sub * 3).otherwise(sub)
    start = F.when(comarca, 8 + COMARCA_FROM_KEY * block + (F.col("_k") - COMARCA_FROM_KEY) * sub) \
             .otherwise(8 + F.col("_k") * block)
    area_off = (F.when(F.col(spec.area) == spec.urban, sub).when(F.col(spec.area) == spec.rural, sub * 2)
                 .otherwise(F.lit(0)))
    sex_off = F.when(F.col(spec.sex) == SEXES[1], 1).when(F.col(spec.sex) == SEXES[2], 2).otherwise(0)
    measures = list(LAYOUTS["expanded"]["offsets"])
    for m in measures:
        o = F.lit(None).cast("int")
        for name, lay in LAYOUTS.items():
            o = F.when(F.col("layout") == name, F.lit(lay["offsets"][m])).otherwise(o)
        offs[m] = o
    keep = (areas & ~comarca) | (F.col(spec.area) == spec.total)
    cells = rows.where(keep).select(
        "file_id", start.alias("_start"), area_off.alias("_aoff"), (F.col("col_total") + sex_off).alias("col"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("_m"), offs[m].alias("_o"), F.col(m).cast("double").alias("_v"))
                            for m in measures])).alias("_x"))
    values = cells.select("file_id", (F.col("_start") + F.col("_aoff") + F.col("_x._o")).alias("row"), "col",
                          _fmt(F.col("_x._v"), F.col("_x._m")).alias("text"))

    ents = rows.select("file_id", "layout", spec.entity, "_k").distinct()
    sub_e = F.lit(0)
    areas_e = F.lit(True)
    for name, lay in LAYOUTS.items():
        sub_e = F.when(F.col("layout") == name, F.lit(lay["sub"])).otherwise(sub_e)
        areas_e = F.when(F.col("layout") == name, F.lit(lay["areas"])).otherwise(areas_e)
    comarca_e = F.col("_k") >= COMARCA_FROM_KEY
    block_e = F.when(areas_e, sub_e * 3).otherwise(sub_e)
    start_e = F.when(comarca_e, 8 + COMARCA_FROM_KEY * block_e + (F.col("_k") - COMARCA_FROM_KEY) * sub_e) \
               .otherwise(8 + F.col("_k") * block_e)
    name = F.col(spec.entity)
    lab = [F.struct(F.lit(0).alias("_o"), F.lit(0).alias("col"), decorate(name, F.col("_k")).alias("text")),
           F.struct(F.lit(0).alias("_o"), F.lit(1).alias("col"), F.lit("1").alias("text")),
           F.struct(F.lit(1).alias("_o"), F.lit(0).alias("col"), F.concat(name, F.lit(" (cont.)")).alias("text")),
           F.struct(F.lit(1).alias("_o"), F.lit(1).alias("col"), F.lit("1").alias("text"))]
    labels = ents.select("file_id", start_e.alias("_start"), sub_e.alias("_sub"),
                         (areas_e & ~comarca_e).alias("_areas"), F.explode(F.array(*lab)).alias("_x"))
    captions = (ents.where(areas_e & ~comarca_e)
                    .select("file_id", start_e.alias("_start"), sub_e.alias("_sub"))
                    .select("file_id", F.explode(F.array(
                        F.struct((F.col("_start") + F.col("_sub")).alias("row"), F.lit("Urbana").alias("text")),
                        F.struct((F.col("_start") + 2 * F.col("_sub")).alias("row"), F.lit("Rural").alias("text")))).alias("_c"))
                    .select("file_id", F.col("_c.row").alias("row"), F.lit(0).alias("col"), F.col("_c.text").alias("text")))
    labels = labels.select("file_id", (F.col("_start") + F.col("_x._o")).alias("row"), F.col("_x.col").alias("col"),
                           F.col("_x.text").alias("text"))
    files = reg.select("file_id").distinct()
    header = files.select("file_id", F.explode(F.array(*[
        F.struct(F.lit(r).alias("row"), F.lit(c).alias("col"), F.lit(x).alias("text")) for r, c, x in GRID_HEADER
    ])).alias("_h")).select("file_id", "_h.*")
    content = values.unionByName(labels).unionByName(captions).unionByName(header)
    content = content.select("file_id", _page(F.col("row")).alias("row"), "col", "text")
    last = content.groupBy("file_id").agg(F.max("row").alias("_max"))
    breaks = (last.select("file_id", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.col("_max") / (PAGE_ROWS + 1)).cast("int")))).alias("_m"))
                  .select("file_id", (F.col("_m") * (PAGE_ROWS + 1) - 1).cast("int").alias("row"), F.lit(0).alias("col"),
                          F.lit("(Continuación)").alias("text")))
    return content.unionByName(breaks)


# ------------------------------------------------------------------ other report fixtures
def indicator_payloads(t: Tables) -> DataFrame:
    """API-shaped JSON payloads, one per indicator code, built with to_json
    from the yearly line-item totals.  Rules: the first year of the first
    code reports 0 (a falsy value); one code answers with an empty record
    list and one with no record element at all."""
    li = t.lineitem.select(F.concat("l_returnflag", F.lit("_"), "l_linestatus").alias("_src"),
                           F.year("l_shipdate").alias("_y"), "l_extendedprice")
    code_map = F.create_map(*[x for kv in MACRO_SOURCE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    long = (li.groupBy("_src", "_y").agg(F.round(F.sum("l_extendedprice") / 1e6, 4).alias("_v"))
              .select(code_map[F.col("_src")].alias("code"), "_y", "_v"))
    first_year = long.select(F.min("_y")).scalar()
    val = F.when((F.col("code") == "NY.GDP.MKTP.KD.ZG") & (F.col("_y") == first_year), F.lit(0.0)).otherwise(F.col("_v"))
    rec = F.struct(F.struct(F.col("code").alias("id"), F.concat(F.lit("Indicador "), F.col("code")).alias("value")).alias("indicator"),
                   F.struct(F.lit("PA").alias("id"), F.lit("Panamá").alias("value")).alias("country"),
                   F.col("_y").cast("string").alias("date"), val.alias("value"))
    per = long.groupBy("code").agg(F.sort_array(F.collect_list(F.struct(F.col("_y").alias("k"), rec.alias("r")))).alias("_l"))
    body = F.concat(F.lit("["), F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"),
                                                   F.size("_l").alias("total"))),
                    F.lit(","), F.to_json(F.transform("_l", lambda x: x["r"])), F.lit("]"))
    full = per.select("code", body.alias("body"))
    empty = full.sparkSession.createDataFrame(
        [("SI.POV.GINI", '[{"page":1,"pages":0,"total":0},[]]'),
         ("SE.XPD.TOTL.GD.ZS", '[{"message":[{"id":"120","value":"Invalid value"}]}]')], "code string, body string")
    return full.unionByName(empty)


REPORT_IDS = ["2", "4", "6", "13", "16", "19", "22", "25", "39", "1A"]  # fixed: report table ids


def report_listing(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Publication folders and file names, one folder per publication; the
    naming style rotates over four forms and every folder also carries
    decoys (a neighbouring table number, a non-spreadsheet file)."""
    reg = grid_registry(t, spec).select("pub_seq").distinct()
    ids = F.array(*[F.lit(i) for i in REPORT_IDS])
    f = reg.select(F.concat(F.lit("pub_"), F.format_string("%03d", F.col("pub_seq").cast("int"))).alias("folder"),
                   "pub_seq", F.posexplode(ids).alias("_n", "cuadro"))
    style = F.col("pub_seq") % 4
    num = F.format_string("%02d", (F.col("_n") + 1).cast("int"))
    name = (F.when(style == 0, F.concat(F.lit("Cuadro "), F.col("cuadro"), F.lit(". Poblacion ocupada.xlsx")))
             .when(style == 1, F.concat(F.lit("Cuadro "), F.col("cuadro"), F.lit(" . Poblacion.xls")))
             .when(style == 2, F.concat(F.lit("CUADRO "), F.col("cuadro"), F.lit(". POBLACION.XLSX")))
             .otherwise(F.concat(F.lit("P"), F.col("pub_seq").cast("string"), F.lit("1441-"), num, F.lit(".xls"))))
    decoy1 = F.concat(F.lit("Cuadro "), F.col("cuadro"), F.lit("1. Otro cuadro.xlsx"))
    decoy2 = F.concat(F.lit("Cuadro "), F.col("cuadro"), F.lit(". Notas.pdf"))
    return f.select("folder", F.explode(F.array(name, decoy1, decoy2)).alias("file"))


def report_requests(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    reg = grid_registry(t, spec).select("pub_seq").distinct()
    ids = F.array(*[F.lit(i) for i in REPORT_IDS])
    return reg.select(F.concat(F.lit("pub_"), F.format_string("%03d", F.col("pub_seq").cast("int"))).alias("folder"),
                      F.posexplode(ids).alias("_n", "cuadro")).select(
        "folder", "cuadro", F.format_string("%02d", (F.col("_n") + 1).cast("int")).alias("numero"))


def national_totals(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """National totals per period: sums over entities of the total/total cells."""
    p = build_panel(t, spec).where((F.col(spec.area) == spec.total) & (F.col(spec.sex) == spec.total))
    g = p.groupBy(spec.period, spec.year).agg(F.sum(spec.population).alias("pob"), F.sum(spec.labour_force).alias("pea"),
                                              F.sum(spec.employed).alias("ocu"), F.sum(spec.unemployed).alias("des"))
    return g


def national_label(period: F.Column, year: F.Column) -> F.Column:
    """Row label of a national-series report: '(abril)' for first-half
    periods, '(R)' for revised even years."""
    y = year.cast("string")
    return (F.when(F.substring(period, 6, 2) == "03", F.concat(y, F.lit(" (abril)")))
             .when(year % 2 == 0, F.concat(y, F.lit(" (R)"))).otherwise(y))


def national_grid(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Two national-series reports: 'c1a_1' without the latest period and
    'c1a_2' complete; data rows from 13, label in column 1, a note row at
    the end.  Row = 13 + rank of the period (from its label order)."""
    g = national_totals(t, spec)
    seq = publication_seq(F.col(spec.period))
    lo, hi = g.agg(F.min(seq), F.max(seq)).first()  # two numbers
    base = g.select(spec.period, spec.year, (seq - lo).alias("_i"), "pob", "pea", "ocu", "des", seq.alias("_s"))
    files = F.explode(F.array(F.struct(F.lit("c1a_1").alias("file_id"), F.lit(1).alias("_f")),
                              F.struct(F.lit("c1a_2").alias("file_id"), F.lit(2).alias("_f")))).alias("_x")
    rows = base.select("*", files).select("*", "_x.*").where((F.col("_f") == 2) | (F.col("_s") < hi))
    r = (13 + F.col("_i")).cast("int")
    rate = F.col("des") * 100.0 / F.col("pea")
    part = F.col("pea") * 100.0 / F.col("pob")
    cells = [(1, national_label(F.col(spec.period), F.col(spec.year))), (2, F.format_number(F.col("pob").cast("double"), 0)),
             (3, F.format_number(F.col("pea").cast("double"), 0)), (4, F.format_string("%.12f", part)),
             (5, F.format_number(F.col("ocu").cast("double"), 0)), (6, F.format_number(F.col("des").cast("double"), 0)),
             (7, F.format_string("%.12f", rate)), (8, F.format_number((F.col("pob") - F.col("pea")).cast("double"), 0))]
    out = rows.select("file_id", r.alias("row"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), v.alias("text")) for c, v in cells])).alias("_c")).select("file_id", "row", "_c.*")
    notes = rows.groupBy("file_id").agg(F.max(r).alias("_m")).select(
        "file_id", (F.col("_m") + 2).alias("row"), F.lit(1).alias("col"), F.lit("Nota: cifras de la encuesta").alias("text"))
    header = rows.select("file_id").distinct().select("file_id", F.lit(12).alias("row"), F.lit(1).alias("col"),
                                                      F.lit("Año").alias("text"))
    return out.unionByName(notes).unionByName(header)


SECTOR_ROWS = [  # (offset below the anchor, label in column 1, value rule) — fixed layout of the fixture
    (3, "Sector Primario", "decoy"), (7, "Sector Secundario", "sec"), (12, "Sector Terciario", "ter"),
    (20, "Sector Primario (revisado)", "pri"),
]


def sector_grid(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Sector report per publication: entity label at column 0 with a probe
    at column 3, sector rows below (the first 'Primario' row is superseded
    by a later one), blocks of 40 rows from row 10; values at the
    registry's percentage columns (3 previous, 4 current)."""
    reg = grid_registry(t, spec).select("pub_seq", "periodo", "col_pct")
    attrs = line_attributes(t, spec)
    nat = F.broadcast(t.nation.select(F.col("n_name").alias(spec.entity), F.col("n_nationkey").alias("_k")))
    rows = attrs.join(reg, "periodo").join(nat, spec.entity)
    fid = F.concat(F.lit("c13_"), F.format_string("%03d", F.col("pub_seq").cast("int")))
    start = 10 + F.col("_k") * 40
    val = {"pri": F.col("pct_sector_primario"), "sec": F.col("pct_sector_secundario"),
           "ter": F.col("pct_sector_terciario"), "decoy": F.lit(-1.0)}
    vals = rows.select(fid.alias("file_id"), start.alias("_st"), "col_pct", F.explode(F.array(*[
        F.struct(F.lit(o).alias("_o"), F.format_string("%.12f", val[k].cast("double")).alias("text")) for o, _, k in SECTOR_ROWS
    ])).alias("_x")).select("file_id", (F.col("_st") + F.col("_x._o")).cast("int").alias("row"),
                            F.col("col_pct").alias("col"), F.col("_x.text").alias("text"))
    ents = rows.select(fid.alias("file_id"), start.alias("_st"), spec.entity, "_k").distinct()
    labs = ents.select("file_id", F.explode(F.array(
        F.struct(F.col("_st").alias("row"), F.lit(0).alias("col"), decorate(F.col(spec.entity), F.col("_k")).alias("text")),
        F.struct(F.col("_st").alias("row"), F.lit(3).alias("col"), F.lit("100").alias("text")),
        *[F.struct((F.col("_st") + o).alias("row"), F.lit(1).alias("col"), F.lit(lab).alias("text")) for o, lab, _ in SECTOR_ROWS],
    )).alias("_x")).select("file_id", F.col("_x.row").cast("int").alias("row"), "_x.col", "_x.text")
    return vals.unionByName(labs)


def informal_grid(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Informality report per publication: one row per entity from row 10
    (label in column 1, values at column 2 previous / 3 current); row 29
    repeats entity 3 with a revised value (+1), entities from 19 on follow
    it, and only rows 10-29 are part of the table, so 19-24 fall outside."""
    reg = grid_registry(t, spec).select("pub_seq", "periodo", F.col("col_pct").alias("_c")).withColumn("_c", F.col("_c") - 1)
    o = order_attributes(t, spec).select(spec.entity, spec.period, "empleo_informal_pct")
    nat = F.broadcast(t.nation.select(F.col("n_name").alias(spec.entity), F.col("n_nationkey").alias("_k")))
    rows = o.join(reg, "periodo").join(nat, spec.entity)
    fid = F.concat(F.lit("c39_"), F.format_string("%03d", F.col("pub_seq").cast("int"))).alias("file_id")
    main = rows.select(fid, F.when(F.col("_k") < 19, 10 + F.col("_k")).otherwise(11 + F.col("_k")).cast("int").alias("row"),
                       "_c", spec.entity, "empleo_informal_pct")
    rev = (rows.where(F.col("_k") == 3)
               .select(fid, F.lit(29).alias("row"), "_c", F.concat(F.col(spec.entity), F.lit(" (revisado)")).alias(spec.entity),
                       (F.col("empleo_informal_pct") + 1).alias("empleo_informal_pct")))
    allr = main.unionByName(rev)
    vals = allr.select("file_id", "row", F.col("_c").alias("col"),
                       F.format_string("%.12f", F.col("empleo_informal_pct")).alias("text"))
    labs = allr.select("file_id", "row", F.lit(1).alias("col"), F.col(spec.entity).alias("text")).distinct()
    return vals.unionByName(labs)
