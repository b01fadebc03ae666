"""Panel consolidation: vintages, enrichment, macro reshaping, column order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.spec import DEFAULT_SPEC, MACRO_INDICATORS, PANEL_COLUMN_ORDER, PanelSpec


def existing(df: DataFrame, wanted) -> list[str]:
    """P5: the wanted columns that exist, in the wanted order (plan time)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def order_columns(df: DataFrame, order=PANEL_COLUMN_ORDER) -> DataFrame:
    """K1: canonical column order, only columns that exist."""
    return df.select(*existing(df, order))


def union_vintages(frames: list[DataFrame]) -> DataFrame | None:
    """Union of publications whose column sets may differ."""
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_last(df: DataFrame, key: list[str], order_cols=("pub_seq", "row")) -> DataFrame:
    """W5 keep-last: per key, the whole record of the latest (pub_seq, row).

    Nulls of the latest record are kept (no per-column coalescing).  One
    aggregation with ``max_by`` over a struct: partial aggregation happens
    map-side, so a hot key never gathers its rows in one task.
    """
    payload = [c for c in df.columns if c not in key]
    rec = F.struct(*[F.col(c) for c in payload])
    ordering = F.struct(*[F.col(c) for c in order_cols])
    return (df.groupBy(*key).agg(F.max_by(rec, ordering).alias("_r"))
              .select(*key, *[F.col("_r")[c].alias(c) for c in payload]))


def keep_first(df: DataFrame, key: list[str], order_cols=("pub_seq", "row")) -> DataFrame:
    """W5 keep-first variant (first entity occurrence in a report)."""
    payload = [c for c in df.columns if c not in key]
    rec = F.struct(*[F.col(c) for c in payload])
    ordering = F.struct(*[F.col(c) for c in order_cols])
    return (df.groupBy(*key).agg(F.min_by(rec, ordering).alias("_r"))
              .select(*key, *[F.col("_r")[c].alias(c) for c in payload]))


def vintage_latest(frames: list[DataFrame], spec: PanelSpec = DEFAULT_SPEC,
                   key: list[str] | None = None) -> DataFrame | None:
    """U1 + W5: consolidate publications, latest vintage wins per key."""
    u = union_vintages(frames)
    if u is None:
        return None
    out = keep_last(u, key or spec.key)
    return out.drop("pub_seq", "row")


def enrich_panel(panel: DataFrame, tables: dict[str, DataFrame] | list[DataFrame],
                 spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Left-enrich the panel with entity-period attribute tables.

    Sub-rows (area/sex) inherit the entity-level values.  Instead of one join
    per table, the tables (each de-duplicated keep-last per key when they
    carry vintage columns) are stacked and folded into one keyed row, then
    joined once.  The attribute side has entity-period grain; AQE broadcasts
    it when its measured size is small and shuffles otherwise.
    """
    frames = list(tables.values()) if isinstance(tables, dict) else list(tables)
    frames = [f for f in frames if f is not None]
    if not frames:
        return panel
    key = [spec.entity, spec.period]
    cleaned = []
    for f in frames:
        if "pub_seq" in f.columns:
            f = keep_last(f, key).drop("pub_seq", "row")
        cleaned.append(f)
    cols = []
    for f in cleaned:
        cols += [c for c in f.columns if c not in key and c not in cols and c not in panel.columns]
    stacked = union_vintages([f.select(*key, *[c for c in f.columns if c in cols]) for f in cleaned])
    attrs = stacked.groupBy(*key).agg(*[F.max(c).alias(c) for c in cols])
    return panel.join(attrs, key, "left")


def macro_by_year(wide: DataFrame, indicators: dict[str, str] = MACRO_INDICATORS,
                  code_col: str = "codigo_indicador", year_col: str = "anio") -> DataFrame:
    """Wide years -> one row per year with one column per wanted code.

    Years are the wide table's numeric column names (plan-time choice from the
    schema)."""
    years = [c for c in wide.columns if c.isdigit()]
    order = F.col("_row") if "_row" in wide.columns else F.lit(0)
    w = wide.select(F.col(code_col).alias("_code"), order.alias("_row"), *years)
    return macro_from_long(w.unpivot(["_code", "_row"], years, "_year", "_val"), indicators, year_col)


def macro_from_long(long: DataFrame, indicators: dict[str, str] = MACRO_INDICATORS, year_col: str = "anio") -> DataFrame:
    """U3 from (_code, _row, _year, _val).  A wanted code with no source row
    becomes an all-null column; duplicate code rows keep the first by ``_row``."""
    codes = list(indicators)
    pv = (long.groupBy(F.col("_year").cast("int").alias(year_col))
              .pivot("_code", codes)
              .agg(F.min_by("_val", "_row")))
    return pv.select(year_col, *[F.col(f"`{c}`").cast("double").alias(indicators[c]) for c in codes])


def enrich_macro(panel: DataFrame, macro: DataFrame | None,
                 spec: PanelSpec = DEFAULT_SPEC) -> DataFrame:
    """Left join of year attributes; one row per year, so the year table
    is bounded by the calendar and safe to broadcast."""
    if macro is None:
        return panel
    m = macro.select(spec.year, *[c for c in macro.columns if c != spec.year and c not in panel.columns])
    return panel.join(F.broadcast(m), spec.year, "left")
