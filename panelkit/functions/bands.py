"""Risk bands and lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default thresholds and band colours of the risk scale.
RISK_LOW = 6.0
RISK_HIGH = 8.0
BAND_COLOURS = {"bajo": "#2ecc71", "moderado": "#f39c12", "critico": "#e74c3c"}
NO_DATA = "sin datos"
NO_DATA_COLOUR = "#cccccc"


def risk_band(rate: Column, low: float = RISK_LOW, high: float = RISK_HIGH) -> Column:
    """<low bajo, <high moderado, else critico; a missing rate is 'critico'
    (the comparison chain falls through)."""
    return (F.when(rate < low, F.lit("bajo"))
             .when(rate < high, F.lit("moderado"))
             .otherwise(F.lit("critico")))


def risk_band_nullsafe(rate: Column, low: float = RISK_LOW, high: float = RISK_HIGH) -> Column:
    """as F5 but a missing rate is 'sin datos'."""
    return F.when(rate.isNull(), F.lit(NO_DATA)).otherwise(risk_band(rate, low, high))


def band_colour(band: Column) -> Column:
    """F16: band -> colour, grey default."""
    m = F.create_map(*[x for kv in BAND_COLOURS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(m[band], F.lit(NO_DATA_COLOUR))
