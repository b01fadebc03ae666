"""Report grids of the entity-row tables (4, 6, 16, 19, 22, 25), written from the
fact tables in the shape reports have: decorated labels, a row above the first
data row, rows without a number or with a zero total before the real one, rows
that repeat an entity with other values, and missing parts.

Rules of the fixture, by nation key k: k % 5 = 1 has a row with a missing total
first, k % 5 = 2 one with a zero total (share tables), k % 5 = 3 a later row of
other values (in table 4 a second block, with one more in the youngest part);
k % 7 = 4 misses one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.report_rows import ROW_TABLES
from panelkit.sources import bridge
from panelkit.sources.tables import Tables
from panelkit.spec import DEFAULT_SPEC, PanelSpec

AGE_START, AGE_BLOCK, AGE_AGAIN = 5, 70, 32


def report_registry(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """One file per publication with its own period: (file, pub_seq, periodo, anio); a table's file_id is its number before ``file``."""
    reg = bridge.grid_registry(t, spec).where("role = 'cur'")
    return reg.select(F.regexp_replace("file_id", "^c2_", "_").alias("file"), "pub_seq", "periodo", "anio")


def registry_of(registry: DataFrame, number: str) -> DataFrame:
    return registry.select(F.concat(F.lit(f"c{number}"), "file").alias("file_id"), "pub_seq", "periodo", "anio")


def _number(v: Column) -> Column:
    """Counts as reports print them, with thousands separators."""
    return F.coalesce(F.format_number(v.cast("double"), 0), F.lit(".."))


def _rate(v: Column) -> Column:
    return F.coalesce(F.format_string("%.12f", v.cast("double")), F.lit(".."))


def order_counts(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    urb = F.col(spec.area) == spec.urban
    parts = bridge.order_cube(t, spec).groupBy(spec.entity, spec.period).agg(
        F.sum("_pob").alias("total"), F.sum("_pea").alias("pea"),
        *(F.sum(F.when(urb if a == "u" else ~urb, F.col(f"_{m}"))).alias(f"{m}_{a}") for m in ("pob", "pea") for a in "ur"),
        *(F.sum(f"_p{k}").alias(f"p{k}") for k in range(1, 6)))
    return parts


def line_counts(t: Tables, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    q, size = F.col("l_quantity"), F.col("p_size")
    return bridge.line_facts(t, spec).groupBy(spec.entity, spec.period).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(size <= 5).alias("a1"), F.count_if((size > 5) & (size <= 10)).alias("a2"),
        F.count_if((size > 40) & (size <= 45)).alias("a3"), F.count_if(size > 45).alias("a4"),
        F.count_if(q < 25).alias("short"), F.count_if(q < 5).alias("micro"), F.count_if(q >= 50).alias("big"))


def _rows(counts: DataFrame, registry: DataFrame, t: Tables, number: str, spec: PanelSpec) -> DataFrame:
    nat = t.nation.select(F.col("n_name").alias(spec.entity), F.col("n_nationkey").alias("k"))
    return counts.join(nat, spec.entity).join(registry_of(registry, number), spec.period)


def _cells(rows: DataFrame, at: Column, values: dict[int, Column], when: Column | None = None) -> DataFrame:
    rows = rows if when is None else rows.where(when)
    cells = F.array(*(F.struct(F.lit(c).alias("col"), v.cast("string").alias("text")) for c, v in values.items()))
    return rows.select("file_id", at.cast("int").alias("row"), F.explode(cells).alias("x")).select("file_id", "row", "x.col", "x.text").where("text IS NOT NULL")


def row_grid(t: Tables, name: str, registry: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """The grid of one table of ``ROW_TABLES``; entity k stands in rows start + 4k to start + 4k + 3."""
    table, number = ROW_TABLES[name], name.removeprefix("cuadro")
    missing = F.col("k") % 7 == 4
    c = F.col
    if name == "cuadro6":
        counts = order_counts(t, spec)
        pct = lambda n, d: F.when(c(d) > 0, c(n) * 100.0 / c(d))
        values = {1: _rate(pct("pea", "total")), 2: F.when(missing, F.lit("..")).otherwise(_rate(pct("pea_u", "pob_u"))), 3: _rate(pct("pea_r", "pob_r"))}
    elif name == "cuadro16":
        counts = order_counts(t, spec)
        half, third = F.expr("p3 DIV 2"), F.expr("p2 DIV 3")
        values = {3: _number(c("total")), 4: _number(c("p5")), 5: _number(half), 6: _number(c("p3") - half), 7: _number(third),
                  8: F.when(missing, F.lit("-")).otherwise(_number(third)), 9: _number(c("p2") - 2 * third), 10: _number(c("p1")), 11: _number(c("p4"))}
    elif name == "cuadro19":
        counts = line_counts(t, spec)
        values = {1: _number(c("total")), 2: F.when(~missing, _number(c("short"))), 5: _number(c("total") - c("short"))}
    elif name == "cuadro22":
        counts = line_counts(t, spec)
        values = {3: _number(c("total")), 4: _number(c("micro")), 8: F.when(missing, F.lit("n/d")).otherwise(_number(c("big")))}
    else:
        counts = bridge.wage_attributes(t, spec)
        values = {3: F.format_string("%.4f", c("mediana_salario"))}
    rows = _rows(counts, registry, t, number, spec)
    label, start = bridge.decorate(c(spec.entity), c("k")), F.lit(table.start_row) + 4 * c("k")
    real = {0: label, **values}
    other = {0: label, **{col: F.lit("7") for col in values}}
    out = _cells(rows, start + 1, real).union(_cells(rows, start + 2, other, c("k") % 5 == 3))
    out = out.union(_cells(rows, start, {0: label, **{col: F.lit("-" if col == table.total_col else "5") for col in values}}, c("k") % 5 == 1))
    if table.shares:
        out = out.union(_cells(rows, start, {0: label, **{col: F.lit("0" if col == table.total_col else "5") for col in values}}, c("k") % 5 == 2))
    out = out.union(_cells(rows, start + 3, {0: F.concat(F.lit("Total "), c(spec.entity)), **{col: F.lit("9") for col in values}}))
    above = rows.select("file_id").distinct()
    return out.union(_cells(above, F.lit(table.start_row - 1), {0: F.lit("NATION_1"), **{col: F.lit("8") for col in values}}))


def age_grid(t: Tables, registry: DataFrame, spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Table 4: a block of rows per entity, label in column 0, population in column 1, labour force in column 2."""
    c = F.col
    rows = _rows(line_counts(t, spec), registry, t, "4", spec)
    start = F.lit(AGE_START) + AGE_BLOCK * c("k")

    def block(at: Column, more: int, when: Column | None) -> DataFrame:
        out = _cells(rows, at, {0: bridge.decorate(c(spec.entity), c("k")), 1: _number(2 * c("total")), 2: _number(c("total"))}, when)
        out = out.union(_cells(rows, at + 1, {0: F.concat(c(spec.entity), F.lit(" (cont.)")), 1: F.lit("1"), 2: F.lit("1")}, when))
        parts = [(2, "15-19", _number(c("a1") + more)), (3, "20-24", F.when(c("k") % 7 != 4, _number(c("a2")))),
                 (8, "60-69", _number(c("a3"))), (9, "70 y más", _number(c("a4")))]
        for offset, label, v in parts:
            out = out.union(_cells(rows, at + offset, {0: F.lit(label), 1: F.lit("1"), 2: v}, when))
        return out

    return block(start, 0, None).union(block(start + AGE_AGAIN, 1, c("k") % 5 == 3))
