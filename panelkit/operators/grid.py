"""Report-grid extraction (G0-G10) as Spark jobs.

A report is a long table ``grid(file_id, row, col, text)``.  Row addressing
becomes equi-joins on ``(file_id, row, col)``; the only sequential rule —
greedy anchor selection, where an accepted anchor skips its block — runs as
an ``aggregate`` over a file's sorted candidates while they are few, and by
pointer doubling over (file, row) in longer files, so that no task holds more
than a run of rows of a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.functions.text import canonical_entity, is_entity_row, is_page_break, period_from_label, safe_double
from panelkit.session import materialize

# Rows of a file that one task takes together, and candidates that are scanned at once.
RUN, AT_ONCE = 4096, 4096

# Row offsets of the core measures inside one sub-block, the
# sub-block height, and whether the layout carries urban/rural sub-blocks.
LAYOUTS = {
    "expanded": {"sub": 22, "areas": True,
                 "offsets": {"poblacion_15_mas": 0, "pea": 2, "ocupados": 7, "desocupados": 8, "tasa_desempleo": 11}},
    "compact": {"sub": 10, "areas": True,
                "offsets": {"poblacion_15_mas": 0, "pea": 1, "ocupados": 3, "desocupados": 4, "tasa_desempleo": 5}},
    "format_b": {"sub": 54, "areas": False,
                 "offsets": {"poblacion_15_mas": 0, "pea": 2, "ocupados": 7, "desocupados": 12, "tasa_desempleo": 15}},
}
AREAS = ("total", "urbana", "rural")
SEXES = ("total", "hombres", "mujeres")
CORE_MEASURES = ("poblacion_15_mas", "pea", "ocupados", "desocupados", "tasa_desempleo")


def drop_page_breaks(grid: DataFrame, label_col: int = 0, marker: str = "ontinuaci", run: int = RUN) -> DataFrame:
    """remove page-break rows and renumber the rows below them.

    A cell moves up by the breaks above it: those of earlier runs of ``run``
    rows (a running sum over the runs of a file) and those above it in its own
    run (at most ``run`` row numbers)."""
    g = grid.withColumn("_run", F.floor(F.col("row") / run).cast("int"))
    is_break = (F.col("col") == label_col) & is_page_break(F.col("text"), marker)
    runs = g.groupBy("file_id", "_run").agg(F.collect_set(F.when(is_break, F.col("row"))).alias("_breaks"))
    earlier = Window.partitionBy("file_id").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_earlier", F.coalesce(F.sum(F.size("_breaks")).over(earlier), F.lit(0)))
    g = g.join(runs, ["file_id", "_run"])
    above = F.col("_earlier") + F.size(F.filter("_breaks", lambda b: b < F.col("row")))
    return (g.where(~F.array_contains("_breaks", F.col("row")))
             .select("file_id", (F.col("row") - above).cast("int").alias("row"), "col", "text"))


def row_view(grid: DataFrame, cols: list[int]) -> DataFrame:
    """One row per (file_id, row) with the listed columns as ``c<i>`` text."""
    return (grid.where(F.col("col").isin(*cols)).groupBy("file_id", "row")
                .agg(*[F.max(F.when(F.col("col") == c, F.col("text"))).alias(f"c{c}") for c in cols]))


def entity_candidates(grid: DataFrame, patterns, label_col: int = 0, probe_col: int | None = 1,
                      check_row: bool = True, start_row: int = 0, end_row: int | None = None) -> DataFrame:
    """Rows whose label resolves to an entity (F2), optionally with a
    non-empty probe cell and passing F4: (file_id, row, entity, label)."""
    cols = [label_col] + ([probe_col] if probe_col is not None else [])
    rv = row_view(grid, cols)
    lab = F.col(f"c{label_col}")
    ent = canonical_entity(lab, patterns)
    cond = ent.isNotNull() & (F.col("row") >= start_row)
    if end_row is not None:
        cond = cond & (F.col("row") < end_row)
    if probe_col is not None:
        cond = cond & F.col(f"c{probe_col}").isNotNull()
    if check_row:
        cond = cond & is_entity_row(lab)
    return rv.where(cond).select("file_id", "row", ent.alias("entity"), lab.alias("label"))


def greedy_anchors(cands: DataFrame, skip: F.Column, at_once: int = AT_ONCE) -> DataFrame:
    """Scan candidates in row order; accept one when its row is at or
    past the next allowed row, then jump ``skip`` rows (a rejected row only
    advances by one, which the 'row >= next' test already expresses).

    Files of up to ``at_once`` candidates run as one ``aggregate`` over their
    sorted array; larger ones by pointer doubling, with the same result."""
    c = materialize(cands.select("file_id", "row", "entity", skip.cast("int").alias("_skip")))
    sizes = c.groupBy("file_id").agg(F.count(F.lit(1)).alias("_n"))
    large = materialize(sizes.where(F.col("_n") > at_once).select("file_id"))
    if not large.limit(1).count():
        return _scanned(c)
    return _scanned(c.join(large, "file_id", "left_anti")).union(_linked(c.join(large, "file_id")))


def _scanned(c: DataFrame) -> DataFrame:
    """One ordered scan per file."""
    per_file = c.groupBy("file_id").agg(F.sort_array(F.collect_list(
        F.struct("row", "entity", "_skip"))).alias("_c"))
    init = F.struct(F.lit(0).alias("next"),
                    F.array().cast("array<struct<row:int,entity:string,_skip:int>>").alias("kept"))

    def step(state, x):
        take = x["row"] >= state["next"]
        return F.when(take, F.struct((x["row"] + x["_skip"]).alias("next"),
                                     F.array_append(state["kept"], x).alias("kept"))).otherwise(state)

    kept = per_file.select("file_id", F.explode(F.aggregate("_c", init, step)["kept"]).alias("_a"))
    return kept.select("file_id", F.col("_a.row").alias("row"), F.col("_a.entity").alias("entity"))


def _linked(c: DataFrame, run: int = RUN) -> DataFrame:
    """The scan without an order of work: every candidate points to the next one
    it would accept, and the anchors are those that the first candidate of a file
    reaches.  Pointers over 2**k steps come from those over 2**(k-1), and with
    each round the anchors known reach twice as far; all joins are on (file, row)."""
    # candidates that share a row: the scan meets the smallest first
    c = c.groupBy("file_id", "row").agg(F.min(F.struct("entity", "_skip")).alias("_x")).select("file_id", "row", "_x.*")
    ends = c.select("file_id", (F.col("row") + F.greatest("_skip", F.lit(1))).alias("at"), F.col("row").alias("_from"))
    marks = c.select("file_id", F.col("row").alias("at"), F.lit(None).cast("int").alias("_from")).union(ends)
    marks = marks.withColumn("_run", F.floor(F.col("at") / run))
    row = F.when(F.col("_from").isNull(), F.col("at"))
    # the next candidate at or below a mark: in its own run, else the first of a later run
    ahead = Window.partitionBy("file_id", "_run").orderBy("at", F.col("_from").isNull()).rowsBetween(0, Window.unboundedFollowing)
    later = Window.partitionBy("file_id").orderBy("_run").rowsBetween(1, Window.unboundedFollowing)
    firsts = marks.groupBy("file_id", "_run").agg(F.min(row).alias("_first"))
    firsts = firsts.select("file_id", "_run", F.min("_first").over(later).alias("_later"))
    pointers = marks.withColumn("_next", F.min(row).over(ahead)).where("_from IS NOT NULL").join(firsts, ["file_id", "_run"])
    pointers = materialize(pointers.select("file_id", F.col("_from").alias("row"), F.coalesce("_next", "_later").alias("next")).where("next IS NOT NULL"))
    reached = materialize(c.groupBy("file_id").agg(F.min("row").alias("row")))
    while pointers.limit(1).count():
        more = reached.join(pointers, ["file_id", "row"]).select("file_id", F.col("next").alias("row"))
        reached = materialize(reached.union(more))  # the two parts of a chain never meet
        hop = pointers.select("file_id", F.col("row").alias("next"), F.col("next").alias("_then"))
        pointers = materialize(pointers.join(hop, ["file_id", "next"]).select("file_id", "row", F.col("_then").alias("next")))
    return reached.join(c, ["file_id", "row"]).select("file_id", "row", "entity")


def layout_table(spark) -> DataFrame:
    """Broadcastable literal table (layout, area, sub-block offset, measure, row offset)."""
    rows = []
    for name, lay in LAYOUTS.items():
        areas = AREAS if lay["areas"] else ("total",)
        for ai, area in enumerate(areas):
            for m, off in lay["offsets"].items():
                rows.append((name, area, ai * lay["sub"], m, off))
    return spark.createDataFrame(rows, "layout string, area string, area_off int, measure string, offset int")


def block_skip(layout: F.Column, is_comarca: F.Column) -> F.Column:
    """Rows to jump after an anchor: 3 sub-blocks (or 1 without areas / for
    total-only entities)."""
    sub = F.lit(None).cast("int")
    full = F.lit(None).cast("int")
    for name, lay in LAYOUTS.items():
        sub = F.when(layout == name, F.lit(lay["sub"])).otherwise(sub)
        full = F.when(layout == name, F.lit(lay["sub"] * (3 if lay["areas"] else 1))).otherwise(full)
    return F.when(is_comarca, sub).otherwise(full)


def core_blocks(grid: DataFrame, registry: DataFrame, patterns, total_only: list[str],
                label_col: int = 0, probe_col: int = 1) -> DataFrame:
    """G1: core labour-market block per anchor, both periods of the file,
    every area (unless the entity or layout is total-only) and sex.

    ``registry``: (file_id, pub_seq, layout, periodo, anio, col_total) —
    one row per period reported in a file; men/women sit in the next two
    columns.  Output: one row per (file, entity, period, area, sex)."""
    g = drop_page_breaks(grid, label_col)
    files = registry.select("file_id", "layout").distinct()
    cands = entity_candidates(g, patterns, label_col, probe_col).join(files, "file_id")
    comarca = F.col("entity").isin(*total_only) if total_only else F.lit(False)
    anchors = greedy_anchors(cands, block_skip(F.col("layout"), comarca))
    lay = F.broadcast(layout_table(grid.sparkSession))
    sexes = F.explode(F.array(*[F.struct(F.lit(s).alias("sexo"), F.lit(i).alias("sex_off"))
                                for i, s in enumerate(SEXES)])).alias("_s")
    a = (anchors.join(registry, "file_id")
                .join(lay, "layout")
                .where(~(F.col("entity").isin(*total_only) & (F.col("area") != "total")) if total_only else F.lit(True))
                .select("*", sexes).select("*", "_s.*").drop("_s"))
    cells = a.select("file_id", "pub_seq", "entity", "periodo", "anio", "area", "sexo", "measure",
                     (F.col("row") + F.col("area_off") + F.col("offset")).alias("row"),
                     (F.col("col_total") + F.col("sex_off")).alias("col"))
    vals = cells.join(g, ["file_id", "row", "col"], "left").withColumn("value", safe_double(F.col("text")))
    out = vals.groupBy("file_id", "pub_seq", "entity", "periodo", "anio", "area", "sexo").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("value"))).alias(m) for m in CORE_MEASURES])
    pob, pea = F.col("poblacion_15_mas"), F.col("pea")
    out = out.withColumn("tasa_participacion", F.when((pob > 0) & pea.isNotNull(), pea / pob * 100))
    return out.withColumnRenamed("entity", "provincia")


def row_records(grid: DataFrame, registry: DataFrame, patterns, label_col: int, probe_col: int | None,
                value_cols: dict[str, str], start_row: int = 0, end_row: int | None = None,
                check_row: bool = True, first_per_entity: bool = True) -> DataFrame:
    """One record per entity row; values in the same row at the
    registry's per-period columns.  ``value_cols`` maps output name ->
    registry column holding the column index.  The first row of an entity
    in a file wins (W5 keep-first)."""
    cands = entity_candidates(grid, patterns, label_col, probe_col, check_row, start_row, end_row)
    if first_per_entity:
        cands = (cands.groupBy("file_id", "entity").agg(F.min("row").alias("row")))
    keep_row = [] if first_per_entity else ["row"]
    recs = cands.join(registry, "file_id")
    names = list(value_cols)
    cells = recs.select("*", F.explode(F.array(*[
        F.struct(F.lit(n).alias("_m"), F.col(value_cols[n]).alias("col")) for n in names])).alias("_x")
    ).select("file_id", "pub_seq", "entity", "periodo", "anio", "row", "_x._m", "_x.col")
    vals = cells.join(grid, ["file_id", "row", "col"], "left").withColumn("value", safe_double(F.col("text")))
    return (vals.groupBy("file_id", "pub_seq", F.col("entity").alias("provincia"), "periodo", "anio", *keep_row)
                .agg(*[F.max(F.when(F.col("_m") == n, F.col("value"))).alias(n) for n in names]))


def sector_blocks(grid: DataFrame, registry: DataFrame, patterns, label_col: int = 0, probe_col: int = 3,
                  sector_col: int = 1, labels: dict | None = None, search: int = 44, start_row: int = 10,
                  jump: int = 40) -> DataFrame:
    """After each anchor (greedy, jump ``jump``), search the next
    ``search`` rows for the sector labels in ``sector_col`` (last match wins),
    stopping at the next row that names a different valid entity.  Values
    are read at the registry's ``col_pct`` on the matched rows.

    Each anchor fans out to its ``search`` rows (bounded), equi-joined on
    (file_id, row); the stop row is the first different-entity row and is
    itself still searched, as in a scan that checks labels before stopping."""
    labels = labels or {"primario": "Sector Primario", "secundario": "Sector Secundario",
                        "terciario": "Sector Terciario"}
    cands = entity_candidates(grid, patterns, label_col, probe_col, True, start_row)
    anchors = greedy_anchors(cands, F.lit(jump))
    rv = row_view(grid, [label_col, sector_col])
    lab = F.col(f"c{label_col}")
    other = rv.select("file_id", F.col("row").alias("r2"),
                      canonical_entity(lab, patterns).alias("e2"), is_entity_row(lab).alias("ok2"),
                      ustrip_text(F.col(f"c{sector_col}")).alias("s2"))
    # each anchor fans out to the `search` rows below it (bounded), then an
    # equi-join on (file_id, row) picks those rows' labels
    win = (anchors.select("file_id", "row", "entity",
                          F.explode(F.sequence(F.col("row") + 1, F.col("row") + search)).alias("r2"))
                  .join(other, ["file_id", "r2"]))
    stop = win.where(F.col("e2").isNotNull() & (F.col("e2") != F.col("entity")) & F.col("ok2"))
    stop = stop.groupBy("file_id", "row").agg(F.min("r2").alias("_stop"))
    win = win.join(stop, ["file_id", "row"], "left").where(
        F.col("_stop").isNull() | (F.col("r2") <= F.col("_stop")))
    kind = F.lit(None).cast("string")
    for k, text in reversed(list(labels.items())):
        kind = F.when(F.col("s2").contains(text), F.lit(k)).otherwise(kind)
    hits = (win.where(kind.isNotNull()).groupBy("file_id", "row", "entity")
               .agg(*[F.max(F.when(kind == k, F.col("r2"))).alias(f"_r_{k}") for k in labels]))
    recs = hits.join(registry, "file_id")
    cells = recs.select("file_id", "pub_seq", "entity", "periodo", "anio", F.explode(F.array(*[
        F.struct(F.lit(k).alias("_m"), F.col(f"_r_{k}").alias("row")) for k in labels])).alias("_x"),
        F.col("col_pct").alias("col")).select("file_id", "pub_seq", "entity", "periodo", "anio", "_x._m", "_x.row", "col")
    vals = cells.join(grid, ["file_id", "row", "col"], "left").withColumn("value", safe_double(F.col("text")))
    return (vals.groupBy("file_id", "pub_seq", F.col("entity").alias("provincia"), "periodo", "anio")
                .agg(*[F.max(F.when(F.col("_m") == k, F.col("value"))).alias(f"pct_sector_{k}") for k in labels]))


def ustrip_text(c: F.Column) -> F.Column:
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def national_series(grid: DataFrame, start_row: int = 13, label_col: int = 1,
                    value_cols: dict[str, int] | None = None) -> DataFrame:
    """National series rows from ``start_row``: label -> (year, period)
    by F8; rows without a year are dropped."""
    value_cols = value_cols or {"poblacion_15_mas": 2, "pea": 3, "tasa_participacion": 4, "ocupados": 5,
                                "desocupados": 6, "tasa_desempleo": 7, "no_economicamente_activa": 8}
    cols = [label_col] + list(value_cols.values())
    rv = row_view(grid.where(F.col("row") >= start_row), cols)
    lab = F.col(f"c{label_col}")
    year, period = period_from_label(lab)
    out = rv.where(lab.isNotNull() & year.isNotNull()).select(
        "file_id", "row", year.alias("anio"), period.alias("periodo"),
        F.regexp_replace(lab, r"(?U)^\s+|\s+$", "").alias("etiqueta_original"),
        *[safe_double(F.col(f"c{c}")).alias(n) for n, c in value_cols.items()])
    return out
