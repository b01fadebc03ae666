import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import get_session
    s = get_session("panelkit-tests", master="local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from panelkit.sources.tables import Tables
    return Tables(spark, SF)


@pytest.fixture(scope="session")
def synthetic(spark):
    """5 entities x 4 periods x 3 areas x 3 sexes = 180 rows, measures from
    a hash of the key (deterministic), ranges as in the reference fixture."""
    from pyspark.sql import functions as F
    ents = ["Bocas del Toro", "Coclé", "Colón", "Chiriquí", "Darién"]
    periods = ["2020-08", "2021-10", "2022-08", "2023-08"]
    rows = [(e, p, a, s) for e in ents for p in periods for a in ("total", "urbana", "rural")
            for s in ("total", "hombres", "mujeres")]
    df = spark.createDataFrame(rows, "provincia string, periodo string, area string, sexo string")
    h = lambda salt: (F.abs(F.xxhash64(F.lit(salt), "provincia", "periodo", "area", "sexo")) % 10000) / 10000.0
    ranges = {"tasa_desempleo": (2, 15), "tasa_participacion": (40, 80), "pct_subempleo": (5, 30),
              "empleo_informal_pct": (30, 80), "pct_universitaria": (5, 45), "pct_sin_educacion": (0, 20),
              "pct_secundaria": (20, 40), "pct_sector_primario": (5, 40), "pct_sector_secundario": (10, 30),
              "pct_sector_terciario": (30, 70), "pct_empresa_grande": (20, 70), "pct_microempresa": (10, 50),
              "mediana_salario": (200, 800), "pib_per_capita": (8000, 20000)}
    cols = {c: lo + (hi - lo) * h(c) for c, (lo, hi) in ranges.items()}
    cols["anio"] = F.substring("periodo", 1, 4).cast("int")
    cols["pea"] = (5000 + (F.abs(F.xxhash64(F.lit("pea"), "provincia", "periodo", "area", "sexo")) % 95000)).cast("bigint")
    return df.withColumns(cols)
