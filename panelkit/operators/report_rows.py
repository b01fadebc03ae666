"""Report tables with one record per entity row (G3, G5-G8) and with an age
block per entity (G2).

A reader tests every row of an entity before it chooses: a row counts only if
its total is a number (for shares: and not zero), and the first row that counts
is the entity's record.  All cells of a row come from one pivot of the grid; the
choice is a partial aggregation, so a report of any length spreads over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.text import canonical_entity, is_entity_row, safe_double
from panelkit.operators.grid import entity_candidates, greedy_anchors, row_view


@dataclass(frozen=True)
class RowTable:
    """Layout of a table: ``values`` maps an output to its columns, read as they
    are or, with ``shares``, summed and taken as a percentage of the total.  A
    missing part makes the share missing."""
    start_row: int
    total_col: int
    values: dict[str, tuple[int, ...]] = field(default_factory=dict)
    shares: bool = False


# First data row, total column and value columns of each report table.
ROW_TABLES = {
    "cuadro6": RowTable(10, 1, {"tasa_actividad_total": (1,), "tasa_actividad_urbana": (2,), "tasa_actividad_rural": (3,)}),
    "cuadro16": RowTable(15, 3, {"pct_sin_educacion": (4,), "pct_primaria": (5, 6), "pct_secundaria": (7, 8, 9),
                                 "pct_universitaria": (10,)}, shares=True),
    "cuadro19": RowTable(15, 1, {"pct_subempleo": (2,)}, shares=True),
    "cuadro22": RowTable(12, 3, {"pct_microempresa": (4,), "pct_empresa_grande": (8,)}, shares=True),
    "cuadro25": RowTable(15, 3, {"mediana_salario": (3,)}),
}
# Rows below an entity's row in the age table, and the rows to the next entity.
AGE_PARTS = {"pct_jovenes_pea": (2, 3), "pct_mayores_pea": (8, 9)}
AGE_COL, AGE_SKIP = 2, 30


def _percentage(parts: list[Column], total: Column) -> Column:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole + p  # a missing part makes the sum missing
    return F.when(total > 0, whole / total * 100)


def row_table(grid: DataFrame, registry: DataFrame, patterns, table: RowTable, label_col: int = 0) -> DataFrame:
    """(file_id, pub_seq, provincia, periodo, anio, row, values) of the
    first valid row of each entity.  ``registry``: one row per file."""
    cols = sorted({table.total_col, *(c for cs in table.values.values() for c in cs)})
    rows = row_view(grid.where(F.col("row") >= table.start_row), [label_col, *cols])
    label, total = F.col(f"c{label_col}"), safe_double(F.col(f"c{table.total_col}"))
    valid = total.isNotNull() & is_entity_row(label)
    if table.shares:
        valid = valid & (total != 0)
    cells = {c: safe_double(F.col(f"c{c}")) for c in cols}
    if table.shares:
        # a negative total is no zero: the percentage of it is taken all the same
        out = {n: sum((cells[c] for c in cs[1:]), cells[cs[0]]) / total * 100 for n, cs in table.values.items()}
    else:
        out = {n: cells[cs[0]] for n, cs in table.values.items()}
    records = rows.where(valid).select("file_id", "row", canonical_entity(label, patterns).alias("provincia"),
                                       *(v.alias(n) for n, v in out.items())).where("provincia IS NOT NULL")
    first = records.groupBy("file_id", "provincia").agg(F.min(F.struct("row", *table.values)).alias("first"))
    files = registry.select("file_id", "pub_seq", "periodo", "anio")
    return first.select("file_id", "provincia", "first.*").join(files, "file_id").select(
        "file_id", "pub_seq", "provincia", "periodo", "anio", "row", *table.values)


def age_table(grid: DataFrame, registry: DataFrame, patterns, label_col: int = 0, probe_col: int = 1) -> DataFrame:
    """Shares of the young and of the old in an entity's labour force, from
    several rows below its anchor; anchors are ``AGE_SKIP`` rows apart, and each
    is a record of its own."""
    anchors = greedy_anchors(entity_candidates(grid, patterns, label_col, probe_col), F.lit(AGE_SKIP))
    offsets = [0, *(o for os in AGE_PARTS.values() for o in os)]
    wanted = anchors.select("file_id", "entity", F.col("row").alias("anchor"), F.explode(F.array(*map(F.lit, offsets))).alias("offset"))
    wanted = wanted.withColumn("row", F.col("anchor") + F.col("offset"))
    cells = grid.where(F.col("col") == AGE_COL).select("file_id", "row", safe_double(F.col("text")).alias("value"))
    found = wanted.join(cells, ["file_id", "row"], "left").groupBy("file_id", "entity", "anchor").agg(
        *(F.max(F.when(F.col("offset") == o, F.col("value"))).alias(f"v{o}") for o in offsets))
    shares = {n: _percentage([F.col(f"v{o}") for o in os], F.col("v0")) for n, os in AGE_PARTS.items()}
    files = registry.select("file_id", "pub_seq", "periodo", "anio")
    return found.join(files, "file_id").select("file_id", "pub_seq", F.col("entity").alias("provincia"), "periodo", "anio",
                                               F.col("anchor").alias("row"), *(v.alias(n) for n, v in shares.items()))
