"""Text column expressions for report cells.

All are built-in Spark SQL expressions; regexes use ``(?U)`` so that ``\\s``
and ``\\d`` mean Unicode whitespace/digits, as in Python's ``re`` on str.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"(?U)^\s+|\s+$"

# Ordered (pattern, canonical entity) pairs used to recognise
# the regional entities in report labels, first match wins; the longer
# "Panamá Oeste" forms come before "Panamá".
ENTITY_PATTERNS = [
    ("Bocas del Toro", "Bocas del Toro"),
    ("Coclé", "Coclé"),
    ("Cocl", "Coclé"),
    ("Colón", "Colón"),
    ("Col", "Colón"),
    ("Chiriquí", "Chiriquí"),
    ("Chiriqu", "Chiriquí"),
    ("Darién", "Darién"),
    ("Dari", "Darién"),
    ("Herrera", "Herrera"),
    ("Los Santos", "Los Santos"),
    ("Panamá Oeste", "Panamá Oeste"),
    ("Panama Oeste", "Panamá Oeste"),
    ("Panamá", "Panamá"),
    ("Panama", "Panamá"),
    ("Veraguas", "Veraguas"),
    ("Comarca Kuna Yala", "Comarca Kuna Yala"),
    ("Kuna Yala", "Comarca Kuna Yala"),
    ("Com. Kuna Yala", "Comarca Kuna Yala"),
    ("Comarca Emberá", "Comarca Emberá"),
    ("Ember", "Comarca Emberá"),
    ("Com. Ember", "Comarca Emberá"),
    ("Comarca Ngäbe", "Comarca Ngäbe Buglé"),
    ("Ng", "Comarca Ngäbe Buglé"),
    ("Com. Ng", "Comarca Ngäbe Buglé"),
]
# Entities reported with a total block only (no area split).
TOTAL_ONLY_ENTITIES = ["Comarca Kuna Yala", "Comarca Emberá", "Comarca Ngäbe Buglé"]


def ustrip(c: Column) -> Column:
    """Strip Unicode whitespace at both ends (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(c, _WS, "")


def clean_label(c: Column) -> Column:
    """null -> ''; strip; drop a trailing run of . … · (and trailing
    blanks); drop inner runs of 3+ dots; strip again."""
    s = ustrip(F.coalesce(c.cast("string"), F.lit("")))
    s = F.regexp_replace(s, r"(?U)[\.…·]+\s*$", "")
    s = F.regexp_replace(s, r"\.{3,}", "")
    return ustrip(s)


def canonical_entity(c: Column, patterns: list[tuple[str, str]] = ENTITY_PATTERNS, max_len: int = 40) -> Column:
    """first pattern (in list order) contained case-insensitively in the
    cleaned label; empty or longer than ``max_len`` -> null."""
    t = clean_label(c)
    low = F.lower(t)
    out = None
    for pat, canon in patterns:
        cond = low.contains(pat.lower())
        out = F.when(cond, F.lit(canon)) if out is None else out.when(cond, F.lit(canon))
    if out is None:
        return F.lit(None).cast("string")
    return F.when((t == "") | (F.length(t) > max_len), F.lit(None).cast("string")).otherwise(out)


# A Python float literal (underscores between digits allowed), or inf/nan.
_FLOAT = (r"(?i)^[+-]?((\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?"
          r"|inf|infinity|nan)$")


def safe_double(c: Column, is_numeric: bool = False) -> Column:
    """number -> double; text: strip, drop ',' then '..'; '' or '-' ->
    null; anything Python's float() would reject -> null.  NaN -> null.

    Spark's cast alone differs from Python (it accepts '1d', rejects
    '1_000'), hence the shape check before ``try_cast``."""
    if is_numeric:
        v = c.cast("double")
    else:
        s = ustrip(c.cast("string"))
        s = F.replace(F.replace(s, F.lit(","), F.lit("")), F.lit(".."), F.lit(""))
        ok = s.rlike(_FLOAT)
        v = F.when((s == "") | (s == "-") | ~ok, F.lit(None).cast("double")).otherwise(
            F.regexp_replace(s, "_", "").try_cast("double"))
    return F.nanvl(v, F.lit(None).cast("double"))


def is_entity_row(c: Column) -> Column:
    """not a sub-section label (urbana/rural/hombres/mujeres), not a
    total, not 'no ind…', not starting with a digit."""
    t = F.lower(clean_label(c))
    return ~(t.isin("urbana", "rural", "hombres", "mujeres") | t.contains("total")
             | t.contains("no ind") | t.rlike(r"(?U)^\d"))


def is_page_break(c: Column, marker: str = "ontinuaci") -> Column:
    """page-break row ('(Continuación)') in the label column."""
    return F.coalesce(F.lower(c.cast("string")).contains(marker), F.lit(False))


def period_from_label(c: Column) -> tuple[Column, Column]:
    """F8: (year, period) from a free label: first 4-digit run = year,
    month 08 by default, 10 when it mentions 'oct', 04 for 'abr'.  No year
    -> nulls (callers drop the row)."""
    s = ustrip(c.cast("string"))
    y = F.regexp_extract(s, r"(\d{4})", 1)
    low = F.lower(s)
    month = F.when(low.contains("oct"), F.lit("10")).when(low.contains("abr"), F.lit("04")).otherwise(F.lit("08"))
    year = F.when(y != "", y.cast("int"))
    return year, F.when(y != "", F.concat(y, F.lit("-"), month))


def short_label(c: Column, limit: int = 15, keep: int = 12) -> Column:
    """labels longer than ``limit`` -> first ``keep`` chars + '...'."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit("..."))).otherwise(c)
