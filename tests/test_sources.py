"""Sources: indicator payloads, report location, manifests, quality checks."""

from pyspark.sql import functions as F

from panelkit.operators import quality as qa
from panelkit.operators.panel import keep_last, macro_by_year, vintage_latest
from panelkit.operators.regions import name_map
from panelkit.sources import files as fl
from panelkit.sources import indicators as ind


def test_indicator_payloads(spark):
    bodies = [
        ("a", '[{"page":1},[{"indicator":{"id":"X","value":"Ind X"},"country":{"id":"PA","value":"Panamá"},'
              '"date":"2020","value":0},{"indicator":{"id":"X","value":"Ind X"},"country":{"id":"PA","value":"Panamá"},'
              '"date":"2021","value":2.5},{"indicator":{"id":"X","value":"Ind X"},"country":{"id":"PA","value":"Panamá"},'
              '"date":"2022","value":null}]]'),
        ("b", '[{"page":1,"total":0},[]]'),
        ("c", '[{"message":[{"id":"120"}]}]'),
    ]
    r = ind.indicator_records(spark.createDataFrame(bodies, "code string, body string"))
    rows = sorted((x.anio, x.valor) for x in r.collect())
    assert rows == [(2020, None), (2021, 2.5), (2022, None)]   # 0 is falsy -> null
    wide = ind.indicator_wide(r)
    assert [c for c in wide.columns if c.isdigit()] == ["2021"]  # all-null years vanish
    cov = ind.indicator_coverage(r).first()
    assert cov.anios_con_dato == 1 and cov.anios_total == 3 and not cov.completo


def test_locate_report_priorities(spark):
    listing = spark.createDataFrame([
        ("f", "P0011441-02.xls"), ("f", "cuadro 2. minúsculas.xlsx"), ("f", "Cuadro 2 . espacio.xls"),
        ("f", "Cuadro 21. otro.xlsx"), ("f", "Cuadro 2. notas.pdf"),
        ("g", "P0011441-04.xls"), ("g", "Cuadro 4. b.xlsx"), ("g", "Cuadro 4. a.xlsx"),
        ("h", "P0021441-06.XLS")], "folder string, file string")
    wanted = spark.createDataFrame([("f", "2", "02"), ("g", "4", "04"), ("h", "6", "06"), ("h", "9", None)],
                                   "folder string, cuadro string, numero string")
    got = {(r.folder, r.cuadro): (r.archivo, r.prioridad) for r in fl.locate_reports(listing, wanted).collect()}
    assert got[("f", "2")] == ("Cuadro 2 . espacio.xls", 2)
    assert got[("g", "4")] == ("Cuadro 4. a.xlsx", 1)        # tie inside a priority: smallest name
    assert got[("h", "6")] == ("P0021441-06.XLS", 4)
    assert ("h", "9") not in got


def test_macro_by_year_missing_code_and_first_duplicate(spark):
    wide = spark.createDataFrame([("A", 0, 1.0, 2.0), ("A", 1, 9.0, 9.0), ("B", 2, None, 4.0)],
                                 "codigo_indicador string, _row int, `2014` double, `2015` double")
    out = {r.anio: r for r in macro_by_year(wide, {"A": "a", "B": "b", "C": "c"}).collect()}
    assert out[2014].a == 1.0 and out[2015].a == 2.0
    assert out[2014].b is None and out[2015].b == 4.0 and out[2015].c is None


def test_keep_last_keeps_nulls_of_the_latest_vintage(spark):
    a = spark.createDataFrame([("e", "p", 1, 0, 5.0)], "k string, p string, pub_seq int, row int, v double")
    b = spark.createDataFrame([("e", "p", 2, 0, None)], "k string, p string, pub_seq int, row int, v double")
    out = vintage_latest([a, b], key=["k", "p"]).first()
    assert out.v is None
    assert keep_last(a.unionByName(b), ["k", "p"]).first().pub_seq == 2


def test_panel_quality_flags(spark, synthetic):
    rep = {r.check: r.passed for r in qa.panel_quality(synthetic, min_entities=10).collect()}
    assert rep["min_entidades"] is False and rep["min_periodos"] is False
    assert rep["tasa_en_rango"] and rep["clave_unica"] and rep["areas_presentes"] and rep["columnas_requeridas"]
    dup = synthetic.unionByName(synthetic.limit(1))
    assert {r.check: r.passed for r in qa.panel_quality(dup).collect()}["clave_unica"] is False


def test_name_map_identity_default(spark):
    to_e, to_r = name_map({"Nation 3": "NATION_3"})
    df = spark.createDataFrame([("Nation 3",), ("NATION_0",)], "r string")
    assert [x[0] for x in df.select(to_e(F.col("r"))).collect()] == ["NATION_3", "NATION_0"]
    assert df.select(to_r(to_e(F.col("r")))).first()[0] == "Nation 3"


def test_file_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 2048)
    m = fl.file_manifest(spark, str(tmp_path)).first()
    assert m.nombre == "a.bin" and m.tamano_mb == 0.0 and m.carpeta == tmp_path.name


def test_indicator_files_round_trip_with_a_byte_order_mark(spark, tmp_path):
    from panelkit.sources import indicators as ind
    rows = [("PA", "A.1", 'Inflación, "precios" (% anual)', 2014, 2.5), ("PA", "A.1", 'Inflación, "precios" (% anual)', 2016, None),
            ("PA", "B", "Población", 2014, -0.125), ("PA", "B", "Población", 2015, 1e9)]
    records = spark.createDataFrame(rows, "pais string, codigo string, indicador string, anio int, valor double")
    long, wide = str(tmp_path / "long"), str(tmp_path / "wide")
    ind.write_csv(records.coalesce(1), long)
    ind.write_csv(ind.indicator_wide(records).coalesce(1), wide)
    for folder, first in ((long, "pais"), (wide, "codigo")):
        raw = next((tmp_path / folder).glob("part-*.csv")).read_bytes()
        assert raw.startswith(b"\xef\xbb\xbf" + first.encode())
    assert sorted(map(str, ind.read_long_csv(spark, long).collect())) == sorted(map(str, records.collect()))
    back = ind.read_wide_csv(spark, wide)
    assert [c for c in back.columns if c.isdigit()] == ["2014", "2015"]
    cells = {(r.codigo, r.anio): r.valor for r in ind.wide_to_long(back, "codigo").collect()}
    assert cells == {("A.1", 2014): 2.5, ("A.1", 2015): None, ("B", 2014): -0.125, ("B", 2015): 1e9}


def test_wide_file_without_a_mark_and_with_texts_for_numbers(spark, tmp_path):
    from panelkit.operators.panel import macro_by_year
    from panelkit.sources import indicators as ind
    path = tmp_path / "ancho.csv"
    path.write_text("codigo_indicador,nombre_indicador,2019,2020\nFP.CPI.TOTL.ZG,a,\"1,000.5\",..\nFP.CPI.TOTL.ZG,again,7,7\nSP.POP.TOTL,b,-,3e2\n")
    out = {r.anio: r for r in macro_by_year(ind.read_wide_csv(spark, str(path))).collect()}
    assert (out[2019].inflacion, out[2019].poblacion_total_nacional) == (1000.5, None)
    assert (out[2020].poblacion_total_nacional, out[2020].indice_gini) == (300.0, None)


def test_null_profile_and_explanation(spark):
    from panelkit.operators import explain as xp
    from panelkit.operators import stats as st
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.0, "b")], "k int, v double, s string")
    rows = st.null_profile(df).orderBy("puesto").collect()
    assert [(r.columna, r.nulos, r.pct_nulos) for r in rows] == [("v", 2, 66.7), ("s", 1, 33.3)]
    assert {(r.celdas_nulas, r.pct_celdas) for r in rows} == {(3, 33.3)}
    phi = spark.createDataFrame([(1, "f", 2.0, 1.5, 10.0), (1, "g", 0.0, -3.25, 10.0), (1, "h", 0.0, 0.0, 10.0)],
                                "k int, feature string, valor double, phi double, base double")
    assert xp.explain_text(phi, ["k"], top=2).first().explicacion.split("\n") == [
        "Prediccion: 8.25%", "Valor base (promedio): 10.00%", "", "Top 2 factores que influyen en esta prediccion:",
        "  1. g: disminuye la prediccion en 3.25 pp", "  2. f: aumenta la prediccion en 1.50 pp"]
