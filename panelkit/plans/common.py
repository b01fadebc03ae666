"""Shared building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from panelkit.operators import features as feat
from panelkit.operators import panel as pan
from panelkit.session import materialize
from panelkit.sources import bridge
from panelkit.sources.tables import Tables
from panelkit.spec import DEFAULT_SPEC

SPEC = DEFAULT_SPEC
# Risk thresholds used by the fixture queries: the terciles of the fixture's
# rate distribution (the default 6/8 would put every row in one band).
LOW, HIGH = 43.0, 56.0


def entities(t: Tables) -> dict[str, int]:
    """The entity dimension, name -> key, from the nation table."""
    return {r[0]: r[1] for r in t.nation.select("n_name", "n_nationkey").collect()}


def categories(t: Tables) -> dict[str, list[str]]:
    """Members of the one-hot columns."""
    return {"provincia": sorted(entities(t)), "area": ["rural", "total", "urbana"], "sexo": ["hombres", "mujeres", "total"]}


def round_doubles(df: DataFrame, dp: int = 6) -> DataFrame:
    """Round every floating column (comparison hygiene for the SQL twin)."""
    return df.select(*[
        F.round(F.col(f.name), dp).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ])


def panel(t: Tables) -> DataFrame:
    return bridge.build_panel(t, SPEC)


def enriched(t: Tables) -> DataFrame:
    p = pan.enrich_panel(panel(t), bridge.attribute_sources(t, SPEC), SPEC)
    p = pan.enrich_macro(p, pan.macro_from_long(bridge.macro_long(t)), SPEC)
    return pan.order_columns(p)


_STORE: dict = {}
_SOURCES: dict = {}


def source(t: Tables, name: str, build) -> DataFrame:
    """A fixture input derived from the tables (report grids, publication
    files, payloads), written once per session and input directory — it
    stands for the files the reference reads, so queries read it instead of
    re-deriving it."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _SOURCES:
        _SOURCES[key] = materialize(build())
    return _SOURCES[key]


def clear_derived() -> None:
    """Forget the shared derived tables (the bench times each query alone)."""
    _STORE.clear()


def stored(t: Tables, name: str, build) -> DataFrame:
    """A shared intermediate table, materialised once per session and input
    directory as a reliable checkpoint (the analogue of the feature file the
    pipeline steps hand to each other).  Later queries read the checkpoint
    instead of replaying the whole lineage."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _STORE:
        _STORE[key] = materialize(build())
    return _STORE[key]


def enriched_table(t: Tables) -> DataFrame:
    """The enriched panel as a shared checkpoint, for queries that read it
    more than once (statistics over many columns, profiles)."""
    return stored(t, "enriched", lambda: enriched(t))


def features(t: Tables) -> DataFrame:
    """Feature table; the year range comes from the (materialised) order
    cube, so the enriched panel is read once."""
    def build():
        from pyspark.sql import functions as F
        from panelkit.operators.util import fitted
        yr = fitted(panel(t), lo=F.min(SPEC.year), hi=F.max(SPEC.year))
        return feat.feature_table(enriched(t), SPEC, categories=categories(t), year_range=(yr["lo"], yr["hi"]))
    return stored(t, "features", build)


# Literal linear model of the fixture queries (scoring, explanation, what-if),
# so that the SQL twin can repeat every prediction exactly.
WEIGHTS = {
    "tasa_desempleo_lag1": 0.6, "tasa_participacion": -0.1, "pct_subempleo": 0.15,
    "empleo_informal_pct": 0.2, "pct_universitaria": -0.05, "pct_empresa_grande": -0.08,
    "mediana_salario": 0.00001, "pib_crecimiento": 0.002, "pct_subempleo_lag1": 0.1,
    "lag_x_sexo_mujeres": 0.05, "lag_x_area_urbana": -0.04, "brecha_desempleo_genero": 0.3,
    "area_urbana": 2.0, "sexo_mujeres": 1.5,
}
INTERCEPT = 12.0
# Slider ranges for the fixture's scale (its rates run 0-100).
FIXTURE_SLIDERS = {
    "tasa_desempleo_lag1": (0.0, 100.0), "tasa_participacion": (0.0, 100.0), "pct_subempleo": (0.0, 50.0),
    "empleo_informal_pct": (0.0, 40.0), "pct_universitaria": (0.0, 30.0), "pct_empresa_grande": (0.0, 5.0),
    "mediana_salario": (0.0, 1_000_000.0), "pib_crecimiento": (-10_000.0, 10_000.0),
}
SCENARIOS = [  # (scenario_id, provincia, area, sexo, variable, value)
    (1, "NATION_1", "total", "total", "tasa_participacion", 90.0),
    (1, "NATION_1", "total", "total", "pct_subempleo", 60.0),
    (2, "NATION_2", "urbana", "mujeres", "tasa_desempleo_lag1", -5.0),
    (3, "NATION_3", "rural", "hombres", "mediana_salario", 5_000_000.0),
    (3, "NATION_3", "rural", "hombres", "pib_crecimiento", 3.0),
    (4, "NATION_10", "total", "mujeres", "pct_universitaria", 10.0),
    (5, "NATION_24", "total", "total", "empleo_informal_pct", 50.0),
    (6, "NATION_99", "total", "total", "pct_subempleo", 10.0),  # no such cell
]
EXPLAIN_ROW = ("NATION_1", "2000-08", "total", "total")
