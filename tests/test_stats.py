"""Statistics operators against brute force."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.operators import quantiles, stats
from panelkit.operators.quantiles import exact_quantiles


def _q(vals, p):
    return float(np.quantile(np.array(vals, dtype=float), p))


@pytest.mark.parametrize("at_once,cuts", [(10_000, 64), (40, 5)])
def test_exact_quantiles_match_numpy(spark, monkeypatch, at_once, cuts):
    monkeypatch.setattr(quantiles, "AT_ONCE", at_once)
    monkeypatch.setattr(quantiles, "CUTS", cuts)
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("a", 1), ("b", 2), ("c", 7), ("d", 2000), (None, 9)):
        vals = np.round(rng.normal(size=n) * 10, 1)  # many ties
        rows += [(g, float(v)) for v in vals]
    rows += [("e", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert "e" not in got
    for g in ("a", "b", "c", "d", None):
        vals = [v for k, v in rows if k == g]
        for name, p in probs.items():
            assert abs(getattr(got[g], name) - _q(vals, p)) < 1e-9, (g, name)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_global_median_property(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = exact_quantiles(df, [], "v", {"m": 0.5}).first().m
    assert abs(got - float(np.median(xs))) < 1e-12


def _mann_whitney(a, b):
    allv = sorted(a + b)
    ranks = {}
    i = 0
    while i < len(allv):
        j = i
        while j < len(allv) and allv[j] == allv[i]:
            j += 1
        ranks[allv[i]] = (i + 1 + j) / 2
        i = j
    n1, n2 = len(a), len(b)
    u1 = sum(ranks[v] for v in a) - n1 * (n1 + 1) / 2
    t = {}
    for v in allv:
        t[v] = t.get(v, 0) + 1
    tie = sum(c ** 3 - c for c in t.values())
    n = n1 + n2
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1))))
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sigma
    return u1, z


@pytest.mark.parametrize("ranges", [None, 3])
def test_rank_sum_matches_brute_force(spark, ranges):
    rng = np.random.default_rng(5)
    a = [float(x) for x in rng.integers(0, 30, 60)]
    b = [float(x) for x in rng.integers(5, 40, 45)]
    df = spark.createDataFrame([(v, True) for v in a] + [(v, False) for v in b], "v double, g boolean")
    r = stats.rank_sum_test(df, "v", F.col("g"), ranges=ranges).first()
    u1, z = _mann_whitney(a, b)
    assert abs(r.u1 - u1) < 1e-9 and abs(r.z - z) < 1e-9


def test_prefix_counts_brute_force(spark):
    vals = [(float(v), c) for v, c in [(1, 2), (3, 1), (2, 5), (10, 1), (7, 3), (4, 4)]]
    df = spark.createDataFrame(vals, "v double, c long")
    got = {r.v: r.below_c for r in stats.prefix_counts(df, "v", ["c"], ranges=2).collect()}
    for v, _ in vals:
        assert got[v] == sum(c for w, c in vals if w < v)


def test_histogram_counts_and_closed_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 10]], "v double")
    h = stats.histogram(df, "v", bins=5).orderBy("bin").collect()
    assert [r.n for r in h] == [2, 2, 2, 0, 1]
    assert sum(r.n for r in h) == 7


def test_box_stats_whiskers(spark):
    vals = [1, 2, 3, 4, 5, 6, 100]
    df = spark.createDataFrame([("g", float(v)) for v in vals], "k string, v double")
    r = stats.box_stats(df, ["k"], "v").first()
    q1, q3 = _q(vals, .25), _q(vals, .75)
    assert r.bigote_sup == max(v for v in vals if v <= q3 + 1.5 * (q3 - q1))
    assert r.n_atipicos == 1


def test_corr_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 6.2, 2.0), (4.0, 7.9, 2.5)], "a double, b double, c double")
    r = {(x.var_a, x.var_b): x for x in stats.corr_long(df, ["a", "b", "c"]).collect()}
    assert abs(r[("b", "a")].r - np.corrcoef([1, 2, 3, 4], [2, 4.1, 6.2, 7.9])[0, 1]) < 1e-12
    assert r[("c", "a")].n == 3


def test_qq_positions_filliben(spark):
    df = spark.createDataFrame([(float(v),) for v in [3, 1, 2, 2]], "v double")
    pts = stats.qq_points(df, "v").orderBy("i").collect()
    n = 4
    assert [p.valor for p in pts] == [1.0, 2.0, 2.0, 3.0]
    assert abs(pts[0].p - (1 - 0.5 ** (1 / n))) < 1e-12 and abs(pts[-1].p - 0.5 ** (1 / n)) < 1e-12
    assert abs(pts[1].p - (2 - 0.3175) / (n + 0.365)) < 1e-12
    assert pts[0].teorico < 0 < pts[-1].teorico


def test_kde_integrates_to_about_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=400)], "v double")
    k = stats.kde_grid(df, "v", points=200).orderBy("k").collect()
    step = k[1].x - k[0].x
    assert 0.85 < sum(r.densidad for r in k) * step < 1.0


def test_exact_quantiles_hot_group_and_hot_value(spark):
    """One group holds most rows, more than are sorted at once, and one value a third of that group."""
    rng = np.random.default_rng(9)
    hot = list(rng.normal(50, 10, 20000).round(3)) + [50.0] * 10000
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in rng.normal(size=50)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"q01": 0.01, "q33": 0.33, "q50": 0.5, "q67": 0.67, "q99": 0.99}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in ("hot", "cold"):
        vals = [v for k, v in rows if k == g]
        for name, p in probs.items():
            assert abs(getattr(got[g], name) - _q(vals, p)) < 1e-9, (g, name)


def test_rank_sum_with_a_hot_tied_value(spark):
    rng = np.random.default_rng(13)
    a = [float(x) for x in rng.integers(0, 50, 300)] + [25.0] * 200
    b = [float(x) for x in rng.integers(10, 60, 250)] + [25.0] * 150
    df = spark.createDataFrame([(v, True) for v in a] + [(v, False) for v in b], "v double, g boolean")
    r = stats.rank_sum_test(df, "v", F.col("g"), ranges=8).first()
    u1, z = _mann_whitney(a, b)
    assert abs(r.u1 - u1) < 1e-6 and abs(r.z - z) < 1e-9


def test_exact_quantiles_with_infinities_and_empty_input(spark):
    inf = math.inf
    rows = [("a", -inf), ("a", 1.0), ("a", 3.0), ("a", inf), ("b", inf), ("b", inf), ("b", inf), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.lo, r.mid, r.hi) for r in exact_quantiles(df, ["g"], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).collect()}
    assert got == {"a": (-inf, 2.0, inf), "b": (inf, inf, inf)}
    whole = exact_quantiles(df.where("g = 'a'"), [], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).first()
    assert tuple(whole) == (-inf, 2.0, inf)
    assert exact_quantiles(df.where("g = 'c'"), ["g"], "v", {"mid": 0.5}).count() == 0


def test_medians_without_a_part(spark, monkeypatch):
    """Medians of all parts but one equal those over the remaining rows, also when the cells are cut."""
    rng = np.random.default_rng(4)
    rows = [(f"p{rng.integers(0, 6)}", f, None if rng.random() < 0.1 else float(rng.integers(0, 40 if f == "ties" else 10**6)))
            for f in ("ties", "wide") for _ in range(700)] + [("p9", "alone", 1.0), (None, "ties", 5.0)]
    df = spark.createDataFrame(rows, "p string, f string, v double")
    parts = [f"p{k}" for k in range(6)] + ["p9", "none"]
    want = {(f, p): float(np.median([v for q, g, v in rows if g == f and q != p and v is not None])) for f in ("ties", "wide") for p in parts}
    want |= {("alone", p): 1.0 for p in parts if p != "p9"}
    for at_once, cuts in ((10_000, 64), (60, 6)):
        monkeypatch.setattr(quantiles, "AT_ONCE", at_once)
        monkeypatch.setattr(quantiles, "CUTS", cuts)
        assert {(r.f, r.p): r.median for r in quantiles.medians_without(df, ["f"], "v", "p", parts).collect()} == want


def test_normal_functions(spark):
    from statistics import NormalDist

    from panelkit.functions.normal import erfc, normal_quantile
    xs = [x / 8 for x in range(-60, 61)] + [0.46875, 4.0, 9.0, 20.0, 26.0, 30.0, None]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(erfc(F.col("x")).alias("y")).collect()
    for x, r in zip(xs, got):
        assert (x is None and r.y is None) or math.isclose(r.y, math.erfc(x), rel_tol=1e-12, abs_tol=1e-300)
    ps = [k / 200 for k in range(1, 200)] + [1e-12, 1e-300, 0.02425, 0.97575, 1 - 1e-9, 0.0, 1.0, -0.1, 1.1, None]
    got = [r.y for r in spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("y")).collect()]
    assert got[-5:] == [-math.inf, math.inf, None, None, None]
    for p, y in zip(ps[:-5], got):
        assert math.isclose(y, NormalDist().inv_cdf(p), rel_tol=1e-9, abs_tol=1e-12)


def test_tied_values_make_rows_in_runs(spark, monkeypatch):
    monkeypatch.setattr(stats, "TIED", 7)
    vals = [1.0] * 20 + [2.0] + [3.0] * 14
    got = stats.qq_positions(spark.createDataFrame([(v,) for v in vals], "v double"), "v").orderBy("i").collect()
    assert [r.i for r in got] == list(range(1, 36)) and [r.valor for r in got] == vals


def test_describe_rounds_half_to_even_as_the_panels_do(spark):
    df = spark.createDataFrame([(0.125,), (0.125,)], "v double")
    assert stats.describe(df, ["v"]).first().q50 == 0.12
