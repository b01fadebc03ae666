"""Explanations, scenarios, regions, streaming and the driver contract."""

import math

from pyspark.sql import functions as F

from panelkit.operators import explain as xp
from panelkit.operators import regions as rg
from panelkit.operators import scenario as scn
from panelkit.operators.scoring import linear_score

W = {"tasa_participacion": -0.1, "pct_subempleo": 0.2, "mediana_salario": 0.01}


def test_linear_explanation_efficiency(synthetic):
    keys = ["provincia", "periodo", "area", "sexo"]
    phi = xp.explain_linear(synthetic, keys, W, 3.0)
    assert phi.count() == synthetic.count() * len(W)  # rows x features
    s = phi.groupBy(*keys).agg((F.sum("phi") + F.first("base")).alias("f"))
    pred = synthetic.select(*keys, linear_score(synthetic, W, 3.0).alias("p"))
    assert s.join(pred, keys).where(F.abs(F.col("f") - F.col("p")) > 1e-9).count() == 0


def test_dominant_feature_ranks_first(synthetic):
    keys = ["provincia", "periodo", "area", "sexo"]
    phi = xp.explain_linear(synthetic, keys, {"mediana_salario": 1.0, "pct_subempleo": 1e-6}, 0.0)
    assert xp.explain_global(phi).first().feature == "mediana_salario"


def test_permutation_shapley_efficiency(spark, synthetic):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    feats = ["tasa_participacion", "pct_subempleo", "mediana_salario"]
    data = VectorAssembler(inputCols=feats, outputCol="features").transform(synthetic)
    model = DecisionTreeRegressor(labelCol="tasa_desempleo", maxDepth=3, seed=1).fit(data)
    keys = ["provincia", "periodo", "area", "sexo"]
    rows = synthetic.limit(10)
    phi = xp.permutation_shapley(rows, keys, feats, model, reps=4)
    s = phi.groupBy(*keys).agg(F.sum("phi").alias("sp"), F.first("f_x").alias("fx"), F.first("f_base").alias("fb"))
    assert s.count() == 10
    assert s.where(F.abs(F.col("sp") - (F.col("fx") - F.col("fb"))) > 1e-9).count() == 0


def test_what_if_clamps_and_recomputes(spark, synthetic):
    from panelkit.operators.features import feature_table
    f = feature_table(synthetic)
    sc = spark.createDataFrame([(1, "Coclé", "urbana", "mujeres", "pct_subempleo", 99.0),
                                (2, "Colón", "total", "total", "tasa_desempleo_lag1", -3.0)],
                               "scenario_id int, provincia string, area string, sexo string, variable string, value double")
    w = {"pct_subempleo": 1.0, "pct_subempleo_lag1": 1.0, "tasa_desempleo_lag1": 0.5, "lag_x_sexo_mujeres": 2.0}
    out = {r.scenario_id: r for r in scn.what_if(f, sc, w, 0.0, 6.0, 8.0).collect()}
    assert out[1].pct_subempleo == 45.0                      # clamped to the slider maximum
    assert out[2].tasa_desempleo_lag1 == 0.0                 # clamped to the minimum
    lag1 = out[1].tasa_desempleo_lag1
    assert math.isclose(out[1].prediccion, 45.0 + 45.0 + 0.5 * lag1 + 2.0 * lag1, rel_tol=1e-12)


def test_polygon_area_of_unit_square(spark):
    v = spark.createDataFrame([("sq", 0, 0, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])],
                              "region string, level int, ring int, seq int, x double, y double")
    m = rg.polygon_measures(v).first()
    assert m.area_grados2 == 1.0 and m.centro_x == 0.5 and m.centro_y == 0.5


def test_equal_area_of_cells_on_sphere_and_ellipsoid(spark):
    """A cell between meridians and parallels has its exact area, on the sphere by the cap formula,
    on WGS84 by integrating over the latitude."""
    cells = [(0, 0, 1, 1), (-80, 7, -77, 9.5), (10, 60, 11, 61), (-5, -30, 5, -29)]
    v = spark.createDataFrame([(str(k), 0, 0, i, float(x), float(y)) for k, (a, b, c, d) in enumerate(cells)
                               for i, (x, y) in enumerate([(a, b), (c, b), (c, d), (a, d)])],
                              "region string, level int, ring int, seq int, x double, y double")
    sphere = {r.region: r.area_km2 for r in rg.polygon_measures(v, radius=6371.0, flattening=0.0).collect()}
    earth = {r.region: r.area_km2 for r in rg.polygon_measures(v).collect()}
    axis, flat = rg.WGS84
    e2 = flat * (2 - flat)
    for k, (a, b, c, d) in enumerate(cells):
        want = 6371.0 ** 2 * math.radians(c - a) * (math.sin(math.radians(d)) - math.sin(math.radians(b)))
        assert math.isclose(sphere[str(k)], want, rel_tol=1e-6)
        steps = 2000
        lats = [math.radians(b + (i + 0.5) * (d - b) / steps) for i in range(steps)]
        strip = sum(math.cos(t) / (1 - e2 * math.sin(t) ** 2) ** 2 for t in lats) * math.radians(d - b) / steps
        assert math.isclose(earth[str(k)], axis ** 2 * (1 - e2) * math.radians(c - a) * strip, rel_tol=1e-6)


def test_geojson_round_trip(spark):
    v = spark.createDataFrame([("r", 1, 0, i, float(i), float(i * i)) for i in range(4)],
                              "region string, level int, ring int, seq int, x double, y double")
    back = rg.read_features(rg.to_features(v)).orderBy("seq").collect()
    assert [(r.x, r.y) for r in back] == [(0.0, 0.0), (1.0, 1.0), (2.0, 4.0), (3.0, 9.0)]


def test_stream_consolidation_equals_batch(spark, tables, tmp_path):
    from panelkit.operators.panel import keep_last
    from panelkit.sources import bridge
    from panelkit.streaming.consolidate import consolidated, publish
    keys = ["provincia", "periodo", "area", "sexo"]
    v = bridge.vintages(tables)
    src = str(tmp_path / "pubs")
    v.write.partitionBy("pub_seq").parquet(src)
    schema = spark.read.parquet(src).schema
    publish(spark, src, schema, str(tmp_path / "table"), str(tmp_path / "ckpt"))
    got = consolidated(spark, str(tmp_path / "table"), schema, keys).select(*keys, "tasa_desempleo")
    exp = keep_last(v, keys).select(*keys, "tasa_desempleo")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "tasa_desempleo" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_resumes_with_new_publications(spark, tables, tmp_path):
    """Two runs over the same checkpoint: the second only sees the newly
    arrived publications and still ends at the batch result."""
    from panelkit.operators.panel import keep_last
    from panelkit.sources import bridge
    from panelkit.streaming.consolidate import consolidated, publish
    keys = ["provincia", "periodo", "area", "sexo"]
    v = bridge.vintages(tables)
    src = str(tmp_path / "pubs")
    cut = 12
    v.where(F.col("pub_seq") < cut).write.partitionBy("pub_seq").parquet(src)
    schema = spark.read.parquet(src).schema
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    publish(spark, src, schema, table, ckpt)
    early = consolidated(spark, table, schema, keys).count()
    v.where(F.col("pub_seq") >= cut).write.mode("append").partitionBy("pub_seq").parquet(src)
    publish(spark, src, schema, table, ckpt)
    publish(spark, src, schema, table, ckpt)  # nothing new: nothing is added
    got = consolidated(spark, table, schema, keys).select(*keys, "tasa_desempleo", "pub_seq")
    assert spark.read.parquet(table).count() == v.count() and early < got.count()
    exp = keep_last(v, keys).select(*keys, "tasa_desempleo", "pub_seq")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def _square(region, level, part, ring, x, y, size):
    return [(region, level, part, ring, i, x + dx * size, y + dy * size) for i, (dx, dy) in enumerate([(0., 0.), (1., 0.), (1., 1.), (0., 1.)])]


def test_holes_parts_and_levels(spark):
    from panelkit.operators import regions as rg
    rows = (_square("a", 1, 0, 0, 0., 0., 4.) + _square("a", 1, 0, 1, 1., 1., 2.) + _square("a", 1, 1, 0, 10., 0., 2.)
            + _square("a", 2, 0, 0, 0., 0., 4.))
    v = spark.createDataFrame(rows, "region string, level int, part int, ring int, seq int, x double, y double")
    back = rg.read_features(rg.to_features(v))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    out = {r.level: r for r in rg.polygon_measures(back).collect()}
    assert out[1].area_grados2 == 16 - 4 + 4 and out[1].vertices == 12 and out[1].xmax == 12
    assert out[1].centro_x == (12 * 2 + 4 * 11) / 16
    assert out[2].area_grados2 == 16


def test_other_geometries_are_an_error(spark):
    import pytest
    from panelkit.operators import regions as rg
    line = '{"type": "Feature", "properties": {"name": "r", "level": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}'
    with pytest.raises(Exception, match="not a polygon layer"):
        rg.read_features(spark.createDataFrame([(line,)], "value string")).collect()


def test_scenario_without_base_row_is_reported(spark, synthetic):
    f = synthetic.withColumn("tasa_desempleo_lag1", F.lit(5.0))
    sc = spark.createDataFrame([(7, "nowhere", "total", "total", "pct_subempleo", 1.0)],
                               "scenario_id int, provincia string, area string, sexo string, variable string, value double")
    r = scn.what_if(f, sc, {"pct_subempleo": 1.0}, 0.0, 6.0, 8.0).collect()
    assert [(x.scenario_id, x.provincia, x.estado, x.prediccion, x.riesgo) for x in r] == [(7, "nowhere", "sin fila base", None, None)]


def test_holes_and_islands_without_a_join(spark):
    """A region per row: a join with the regions' centres would be broadcast, and grow with the table."""
    from panelkit.operators import regions as rg
    v = spark.createDataFrame([(n, lv, 0, 0, i, x, y) for n, lv in (("A", 0), ("B", 1), (None, 2))
                               for i, (x, y) in enumerate([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])],
                              "region string, level int, part int, ring int, seq int, x double, y double")
    out = rg.holes_and_islands(v)
    assert "Join" not in out._jdf.queryExecution().toString()
    got = sorted((r.region, r.part, r.ring, r.seq, r.x, r.y) for r in out.collect())
    assert len(got) == 4 * 3 + 4 * 2 and {r[0] for r in got} == {"A", "B"} and out.columns == v.columns
    assert ("A", 0, 1, 0, 0.5, 0.5) in got and ("A", 1, 0, 2, 12.0, 2.0) in got and ("B", 0, 1, 2, 1.5, 1.5) in got
