"""Feature operator properties (ported from the reference's feature tests)."""

from pyspark.sql import functions as F

from panelkit.operators import features as feat


def test_contrasts_keep_row_count(synthetic):
    out = feat.contrast_features(synthetic)
    assert out.count() == synthetic.count() == 180
    for c in ("brecha_desempleo_urb_rur", "ratio_pea_urbana", "brecha_desempleo_genero"):
        assert c in out.columns


def test_contrast_values(synthetic):
    out = feat.contrast_features(synthetic).where("provincia = 'Coclé' AND periodo = '2021-10'")
    rows = {(r.area, r.sexo): r for r in synthetic.where("provincia = 'Coclé' AND periodo = '2021-10'").collect()}
    got = out.first()
    exp = rows[("urbana", "total")].tasa_desempleo - rows[("rural", "total")].tasa_desempleo
    assert abs(got.brecha_desempleo_urb_rur - exp) < 1e-12
    exp_g = rows[("total", "mujeres")].tasa_desempleo - rows[("total", "hombres")].tasa_desempleo
    assert abs(got.brecha_desempleo_genero - exp_g) < 1e-12
    assert abs(got.ratio_pea_urbana - rows[("urbana", "total")].pea / rows[("total", "total")].pea) < 1e-12


def test_post_covid_flag_and_scaled_year(synthetic):
    out = feat.time_features(synthetic).select("anio", "post_covid", "anio_norm").collect()
    for r in out:
        assert r.post_covid == int(r.anio >= 2021)
        assert 0.0 <= r.anio_norm <= 1.0


def test_lag_null_in_first_period(synthetic):
    out = feat.lag_features(synthetic)
    first = out.where("periodo = '2020-08'")
    assert first.where(F.col("tasa_desempleo_lag1").isNotNull()).count() == 0
    later = out.where("periodo = '2021-10'")
    assert later.where(F.col("tasa_desempleo_lag1").isNull()).count() == 0


def test_lag_is_previous_row_of_series(synthetic):
    out = feat.delta_features(feat.lag_features(synthetic))
    r = out.where("provincia = 'Colón' AND area = 'rural' AND sexo = 'hombres' AND periodo = '2022-08'").first()
    prev = synthetic.where("provincia = 'Colón' AND area = 'rural' AND sexo = 'hombres' AND periodo = '2021-10'").first()
    assert r.tasa_desempleo_lag1 == prev.tasa_desempleo
    assert abs(r.tasa_participacion_delta - (r.tasa_participacion - prev.tasa_participacion)) < 1e-12


def test_interaction_equals_product(synthetic):
    out = feat.interaction_features(feat.lag_features(feat.time_features(synthetic)))
    rows = out.where(F.col("tasa_desempleo_lag1").isNotNull()).collect()
    assert rows
    for r in rows:
        assert r.lag_x_post_covid == r.tasa_desempleo_lag1 * r.post_covid
        assert r.lag_x_sexo_mujeres == r.tasa_desempleo_lag1 * (r.sexo == "mujeres")
        assert r.lag_x_area_urbana == r.tasa_desempleo_lag1 * (r.area == "urbana")


def test_one_hot_drops_first_category(synthetic):
    out = feat.one_hot(synthetic, [("provincia", "prov"), ("area", "area"), ("sexo", "sexo")])
    prov = [c for c in out.columns if c.startswith("prov_")]
    assert len(prov) == 5 - 1
    assert "prov_Bocas del Toro" not in prov  # alphabetically first
    assert sorted(c for c in out.columns if c.startswith("area_")) == ["area_total", "area_urbana"]


def test_fill_never_increases_nulls(synthetic):
    holes = synthetic.withColumn("tasa_desempleo", F.when(F.col("periodo") == "2021-10", None)
                                 .otherwise(F.col("tasa_desempleo")))
    filled = feat.fill_panel(holes)
    before = holes.where(F.col("tasa_desempleo").isNull()).count()
    after = filled.where(F.col("tasa_desempleo").isNull()).count()
    assert before == 45 and after == 0
    # forward fill takes the previous period's value
    r = filled.where("provincia = 'Darién' AND area = 'total' AND sexo = 'total' AND periodo = '2021-10'").first()
    p = holes.where("provincia = 'Darién' AND area = 'total' AND sexo = 'total' AND periodo = '2020-08'").first()
    assert r.tasa_desempleo == p.tasa_desempleo


def test_backward_fill_for_leading_nulls(synthetic):
    holes = synthetic.withColumn("pct_subempleo", F.when(F.col("periodo") == "2020-08", None)
                                 .otherwise(F.col("pct_subempleo")))
    fwd = feat.fill_panel(holes, forward_only=True)
    both = feat.fill_panel(holes)
    assert fwd.where(F.col("pct_subempleo").isNull()).count() == 45
    assert both.where(F.col("pct_subempleo").isNull()).count() == 0


def test_ratio_zero_denominator_is_null(synthetic):
    z = synthetic.withColumn("pct_sector_primario", F.lit(0.0))
    out = feat.ratio_features(z)
    assert out.where(F.col("ratio_terciario_primario").isNotNull()).count() == 0


def test_feature_chain_second_fill_excludes_lags(synthetic):
    out = feat.feature_table(synthetic)
    first = out.where("periodo = '2020-08'")
    assert first.where(F.col("tasa_desempleo_lag1").isNotNull()).count() == 0
    # the interactions are back-filled by the second fill (reference behaviour)
    assert first.where(F.col("lag_x_area_urbana").isNull()).count() == 0
    strict = feat.feature_table(synthetic, refill_interactions=False).where("periodo = '2020-08'")
    assert strict.where(F.col("lag_x_area_urbana").isNotNull()).count() == 0
