"""Text cell functions and grid extraction."""

import pytest
from pyspark.sql import functions as F

from panelkit.functions import text as tx
from panelkit.operators import grid as gr
from panelkit.operators import report_rows as rr
from panelkit.sources import bridge
from panelkit.sources.links import harvest_links


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw,clean", [(None, ""), ("  Coclé ....... ", "Coclé"), ("Darién…", "Darién"),
                                       ("Herrera ··", "Herrera"), ("Los ... Santos", "Los  Santos"),
                                       (" Colón ", "Colón")])
def test_clean_label(spark, raw, clean):
    assert _one(spark, tx.clean_label, raw) == clean


PATS = [("Panamá Oeste", "Panamá Oeste"), ("Panamá", "Panamá"), ("Dari", "Darién"), ("Ng", "Comarca Ngäbe Buglé")]


@pytest.mark.parametrize("raw,ent", [("Panamá Oeste....", "Panamá Oeste"), ("PANAMÁ", "Panamá"),
                                     ("Secundaria", "Darién"), ("Ningún grado", "Comarca Ngäbe Buglé"),
                                     ("República de Panamá y sus provincias y comarcas", None), ("", None)])
def test_canonical_entity_order_and_overmatch(spark, raw, ent):
    assert _one(spark, lambda c: tx.canonical_entity(c, PATS), raw) == ent


@pytest.mark.parametrize("raw,val", [("1,234.5", 1234.5), ("..", None), ("-", None), ("", None), ("1_000", 1000.0),
                                     ("1d", None), (" 2.5 ", 2.5), ("abc", None), ("1e3", 1000.0), ("nan", None),
                                     ("3..5", 35.0)])
def test_safe_double_python_semantics(spark, raw, val):
    assert _one(spark, tx.safe_double, raw) == val


@pytest.mark.parametrize("raw,ok", [("Urbana", False), ("TOTAL", False), ("Total Coclé", False), ("No indicado", False),
                                    ("15-19", False), ("Coclé", True)])
def test_is_entity_row(spark, raw, ok):
    assert _one(spark, tx.is_entity_row, raw) is ok


@pytest.mark.parametrize("raw,period", [("2021 (octubre)", "2021-10"), ("2022 (abril)", "2022-04"), ("2011 (R)", "2011-08"),
                                        ("sin año", None)])
def test_period_from_label(spark, raw, period):
    assert _one(spark, lambda c: tx.period_from_label(c)[1], raw) == period


def test_short_label(spark):
    assert _one(spark, tx.short_label, "Comarca Ngäbe Buglé") == "Comarca Ngäb..."
    assert _one(spark, tx.short_label, "Coclé") == "Coclé"


def test_greedy_anchor_skip(spark):
    # candidates at rows 0, 3, 5, 12; skip 5 -> accept 0 (next 5), reject 3, accept 5 (next 10), accept 12
    c = spark.createDataFrame([("f", r, "E") for r in (0, 3, 5, 12)], "file_id string, row int, entity string")
    kept = [r.row for r in gr.greedy_anchors(c, F.lit(5)).orderBy("row").collect()]
    assert kept == [0, 5, 12]


def test_page_breaks_renumber(spark):
    g = spark.createDataFrame([("f", 0, 0, "a"), ("f", 1, 0, "(Continuación)"), ("f", 2, 0, "b"), ("f", 2, 3, "x")],
                              "file_id string, row int, col int, text string")
    out = sorted((r.row, r.col, r.text) for r in gr.drop_page_breaks(g).collect())
    assert out == [(0, 0, "a"), (1, 0, "b"), (1, 3, "x")]


def test_core_grid_round_trip(spark, tables):
    """Grid written from the panel at the layout offsets and read back gives
    the panel values of the current publication."""
    pats = bridge.entity_patterns([r[0] for r in tables.nation.select("n_name").collect()])
    total_only = [f"NATION_{k}" for k in range(22, 25)]
    core = gr.core_blocks(bridge.core_grid(tables), bridge.grid_registry(tables), pats, total_only)
    panel = bridge.build_panel(tables)
    seq = bridge.publication_seq(F.col("periodo"))
    cur = core.where(F.col("pub_seq") == bridge.publication_seq(F.col("periodo")))
    j = cur.join(panel.select("provincia", "periodo", "area", "sexo", F.col("pea").alias("pea0"),
                              F.col("tasa_desempleo").alias("t0")), ["provincia", "periodo", "area", "sexo"])
    assert j.count() > 0
    assert j.where(F.col("pea") != F.col("pea0")).count() == 0
    assert j.where(F.abs(F.col("tasa_desempleo") - F.col("t0") - 0.5) > 1e-9).count() == 0
    assert seq is not None


def test_harvest_links_url_forms(spark):
    html = ('<a href="../data/a.xls">  Tabla A </a><a title="T" href="/x/b.XLSX"></a>'
            '<a href="c.xls"><b>C</b></a><a href="http://o.org/d.xls"></a><a href="/e.pdf">E</a><a name="z">z</a>')
    pages = spark.createDataFrame([(1, "https://site.test/pub/1", html)], "page_id long, url string, html string")
    got = [(r.nombre, r.url_completa) for r in harvest_links(pages, ".xls").orderBy("pos").collect()]
    assert got == [("Tabla A", "https://site.test/data/a.xls"), ("T", "https://site.test/x/b.XLSX"),
                   ("C", "https://site.test/c.xls"), ("d.xls", "http://o.org/d.xls")]


def _greedy_python(rows, skip):
    """The reference's sequential scan: accept a candidate at or past the
    next allowed row, then jump."""
    out, nxt = [], 0
    for r in sorted(rows):
        if r >= nxt:
            out.append(r)
            nxt = r + skip[r]
    return out


def test_greedy_anchors_match_sequential_scan(spark):
    import random
    rnd = random.Random(7)
    data, expected = [], {}
    for f in range(6):
        rows = sorted(rnd.sample(range(300), 40))
        skip = {r: rnd.choice([1, 5, 10, 22, 66]) for r in rows}
        data += [(f"f{f}", r, "E", skip[r]) for r in rows]
        expected[f"f{f}"] = _greedy_python(rows, skip)
    c = spark.createDataFrame(data, "file_id string, row int, entity string, s int")
    got = {}
    for r in gr.greedy_anchors(c, F.col("s")).collect():
        got.setdefault(r.file_id, []).append(r.row)
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_linked_anchors_match_the_scan_on_a_long_file(spark):
    """A file of 10**6 rows, far more than are scanned at once, equals the sequential scan; so do small files beside it."""
    import random
    rnd = random.Random(8)
    rows = sorted(rnd.sample(range(10**6), 30_000))
    skip = {r: rnd.choice([1, 22, 66, 9000]) if rnd.random() < 0.99 else 60_000 for r in rows}
    data = [("long", r, "E", skip[r]) for r in rows] + [("short", r, "F", 5) for r in (0, 3, 5, 6, 12)] + [("long", rows[7], "A", skip[rows[7]])]
    c = spark.createDataFrame(data, "file_id string, row int, entity string, s int")
    got = {}
    for r in gr.greedy_anchors(c, F.col("s")).collect():
        got.setdefault(r.file_id, []).append(r.row)
    assert {k: sorted(v) for k, v in got.items()} == {"long": _greedy_python(rows, skip), "short": [0, 5, 12]}


def test_page_breaks_over_many_runs(spark):
    rows = [("f", r, 0, "(Continuación)" if r % 7 == 3 else f"t{r}") for r in range(400)]
    g = spark.createDataFrame(rows, "file_id string, row int, col int, text string")
    want = [t for _, r, _, t in rows if r % 7 != 3]
    for run in (4096, 16):
        assert [r.text for r in gr.drop_page_breaks(g, run=run).orderBy("row").collect()] == want
        assert [r.row for r in gr.drop_page_breaks(g, run=run).orderBy("row").collect()] == list(range(len(want)))


PATTERNS = [("Colón", "Colón"), ("Darién", "Darién"), ("Coclé", "Coclé")]
REGISTRY = [("f", 1, "2020-08", 2020), ("g", 2, "2021-08", 2021)]


def _grid_of(spark, files):
    """files: file -> {row: [cells]}."""
    cells = [(f, r, c, str(v)) for f, rows in files.items() for r, vs in rows.items() for c, v in enumerate(vs) if v is not None]
    return spark.createDataFrame(cells, "file_id string, row int, col int, text string")


def _registry_of(spark):
    return spark.createDataFrame(REGISTRY, "file_id string, pub_seq int, periodo string, anio int")


def test_row_tables_choose_the_first_valid_row(spark):
    grid = _grid_of(spark, {
        "f": {14: ["Colón", None, None, 50, 1, 1, 1, 1, 1, 1, 1],        # above the first data row
              15: ["Colón ...", None, None, "-", 1, 1, 1, 1, 1, 1, 1],   # no total
              16: ["Colón", None, None, 0, 1, 1, 1, 1, 1, 1, 1],         # zero total
              17: ["  colón…", None, None, "1,000", 100, 50, 150, 100, 100, 50, 250],
              18: ["Colón", None, None, 10, 9, 9, 9, 9, 9, 9, 9],        # later: does not count
              19: ["Total Darién", None, None, 10, 1, 1, 1, 1, 1, 1, 1],
              20: ["Darién", None, None, 200, 20, 10, "..", 30, 10, 20, 50]},
        "g": {20: ["Darién", None, None, 100, 10, 10, 10, 10, 10, 10, 10], 21: ["Coclé", None, None, "n/d", 1]}})
    got = {(r.periodo, r.provincia): r for r in rr.row_table(grid, _registry_of(spark), PATTERNS, rr.ROW_TABLES["cuadro16"]).collect()}
    assert set(got) == {("2020-08", "Colón"), ("2020-08", "Darién"), ("2021-08", "Darién")}
    colon, darien = got["2020-08", "Colón"], got["2020-08", "Darién"]
    assert (colon.row, colon.pct_sin_educacion, colon.pct_primaria, colon.pct_secundaria, colon.pct_universitaria) == (17, 10.0, 20.0, 25.0, 25.0)
    assert (darien.pct_sin_educacion, darien.pct_primaria, darien.pct_secundaria) == (10.0, None, 30.0)


def test_row_tables_of_plain_values(spark):
    grid = _grid_of(spark, {"f": {9: ["Colón", 1, 1, 1], 10: ["Colón", "..", 5, 5], 11: ["Colón", 0, 61.5, "-"], 12: ["Colón", 60, 1, 1],
                                  15: ["Urbana Colón", 1, 2, 3], 16: ["Darién", 59.5, None, 58]}})
    got = {r.provincia: r for r in rr.row_table(grid, _registry_of(spark), PATTERNS, rr.ROW_TABLES["cuadro6"]).collect()}
    assert (got["Colón"].row, got["Colón"].tasa_actividad_total, got["Colón"].tasa_actividad_urbana, got["Colón"].tasa_actividad_rural) == (11, 0.0, 61.5, None)
    assert (got["Darién"].tasa_actividad_total, got["Darién"].tasa_actividad_urbana) == (59.5, None)


def test_age_blocks(spark):
    grid = _grid_of(spark, {"f": {
        4: ["Colón", 1, 200], 5: ["Colón (cont.)", 1, 7], 6: ["15-19", 1, 10], 7: ["20-24", 1, 30], 12: ["60-69", 1, 20], 13: ["70 y más", 1, "-"],
        33: ["Darién", 1, 50],                                      # within the block: passed over
        34: ["Darién", 1, "0"], 36: ["15-19", 1, 1], 37: ["20-24", 1, 1],
        64: ["Darién", 1, 100], 66: ["15-19", 1, 5], 67: ["20-24", 1, 5], 72: ["60-69", 1, 1], 73: ["70 y más", 1, 2], 95: ["Coclé", None, 5]}})
    got = {r.row: (r.provincia, r.pct_jovenes_pea, r.pct_mayores_pea) for r in rr.age_table(grid, _registry_of(spark), PATTERNS).collect()}
    assert got == {4: ("Colón", 20.0, None), 34: ("Darién", None, None), 64: ("Darién", 10.0, 3.0)}


@pytest.mark.parametrize("raw,ent", [("Panamá Oeste", "Panamá Oeste"), ("Panama", "Panamá"), ("Com. Kuna Yala ....", "Comarca Kuna Yala"),
                                     ("Agrícola", "Colón"), ("Total", None)])
def test_default_entity_patterns(spark, raw, ent):
    assert _one(spark, tx.canonical_entity, raw) == ent


def test_harvest_links_quoting_and_references(spark):
    html = ("<a href='s.xls'>Regi&oacute;n &amp;lt; &#209;&#xE1;&#0;&bogus;</a><A class=x HREF=u.xls title='T &quot;1&quot;'></A>"
            '<a data-href="no.xls">n</a><a href="a.xls?x=1&amp;y=2">&nbsp;A & B&nbsp;</a>')
    pages = spark.createDataFrame([(1, "https://site.test/pub/1", html)], "page_id long, url string, html string")
    got = [(r.nombre, r.url_completa) for r in harvest_links(pages, ".xls").orderBy("pos").collect()]
    assert got == [("Región &lt; Ñá&#0;&bogus;", "https://site.test/s.xls"), ('T "1"', "https://site.test/u.xls"),
                   ("A & B", "https://site.test/a.xls?x=1&y=2")]
