"""Risk bands, evaluation and scoring properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.functions.bands import risk_band, risk_band_nullsafe
from panelkit.operators import evaluate as ev
from panelkit.operators import tuning as tn


@pytest.mark.parametrize("rate,band", [(5.99, "bajo"), (6.0, "moderado"), (7.99, "moderado"), (8.0, "critico"),
                                       (0.0, "bajo"), (None, "critico")])
def test_risk_boundaries(spark, rate, band):
    df = spark.createDataFrame([(rate,)], "t double")
    assert df.select(risk_band(F.col("t"))).first()[0] == band


def test_nullsafe_band(spark):
    df = spark.createDataFrame([(None,), (9.0,)], "t double")
    assert [r[0] for r in df.select(risk_band_nullsafe(F.col("t"))).collect()] == ["sin datos", "critico"]


def _design(n=300, f=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, f)) * [1, 5, 0.1, 2] + [0, 10, 3, -1]
    y = x @ np.array([1.5, -0.2, 4.0, 0.7]) + 3 + rng.normal(scale=0.5, size=n)
    return x, y


def test_ridge_matches_closed_form(spark):
    x, y = _design()
    cols = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(float(v), *map(float, r), "p") for r, v in zip(x, y)],
                               "y double, " + ", ".join(f"{c} double" for c in cols) + ", periodo string")
    st = ev.fold_gram_by_period(df, cols, "y", "periodo", ["b"], None)["b"]  # fold 'b' trains on all rows
    b0, beta = ev.ridge_from_gram(st, alpha=1.0)
    mu, sd = x.mean(0), x.std(0)
    xs = (x - mu) / sd
    w = np.linalg.solve(xs.T @ xs + np.eye(4), xs.T @ (y - y.mean()))
    assert np.allclose(beta, w / sd, atol=1e-9)
    assert abs(b0 - (y.mean() - (w / sd) @ mu)) < 1e-9


def test_lasso_matches_coordinate_descent(spark):
    x, y = _design(seed=2)
    n = len(y)
    st = {"n": n, "sy": y.sum(), "syy": (y * y).sum(), "sx": x.sum(0), "sxy": x.T @ y, "sxx": x.T @ x, "cx": np.zeros(4), "cy": 0.0}
    b0, beta = ev.lasso_from_gram(st, alpha=0.1)
    # brute-force check of the optimality (KKT) conditions on standardised data
    mu, sd = x.mean(0), x.std(0)
    xs = (x - mu) / sd
    w = beta * sd
    grad = xs.T @ (y - y.mean() - xs @ w) / n
    for g, wj in zip(grad, w):
        if wj != 0:
            assert abs(g - 0.1 * np.sign(wj)) < 1e-6
        else:
            assert abs(g) <= 0.1 + 1e-6


def test_cv_metrics_rules(spark):
    df = spark.createDataFrame([("a", 1.0, 1.5), ("b", 2.0, 2.0), ("b", 2.0, 2.0), ("c", 2.0, 3.0), ("c", 2.0, 2.0),
                                ("d", 1.0, 2.0), ("d", 3.0, 2.0)], "fold string, real double, predicho double")
    m = {r.fold: r for r in ev.cv_metrics(df, ["fold"]).collect()}
    assert m["a"].r2 == 0.0            # one test row
    assert m["b"].r2 == 1.0            # constant target, exact fit
    assert m["c"].r2 == 0.0            # constant target, errors
    assert abs(m["d"].r2 - 0.0) < 1e-12 and abs(m["d"].rmse - 1.0) < 1e-12


def test_fold_medians_exclude_own_period(spark):
    df = spark.createDataFrame([("p1", 1.0), ("p1", 2.0), ("p2", 10.0), ("p3", 20.0), ("p3", None)],
                               "periodo string, x double")
    med = {r.fold: r.median for r in ev.fold_medians(df, ["x"], "periodo", ["p1", "p2", "p3"]).collect()}
    assert med == {"p1": 15.0, "p2": 2.0, "p3": 2.0}


def test_persistence_uses_fold_train_mean(spark):
    df = spark.createDataFrame([("e", "p1", 10.0, None), ("e", "p2", 20.0, 10.0), ("e", "p3", 30.0, 20.0)],
                               "provincia string, periodo string, t double, t_lag1 double")
    p = {r.fold: r.predicho for r in ev.lopo_persistence(df, "t", "t_lag1", "periodo", ["provincia", "periodo"]).collect()}
    assert p == {"p1": 25.0, "p2": 10.0, "p3": 20.0}


def test_search_is_pinned_by_its_seed(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    x, y = _design(n=80)
    df = spark.createDataFrame([(i, float(v), *map(float, r)) for i, (r, v) in enumerate(zip(x, y))],
                               "id int, label double, a double, b double, c double, d double")
    data = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    grid = {"maxDepth": [1, 2, 4], "minInstancesPerNode": [1, 5]}
    runs = [tn.search(d, DecisionTreeRegressor(seed=1), grid, ["id"], "label", draws=4, folds=3, parallelism=2)
            for d in (data, data.repartition(7))]
    (best, chosen, tried), (_, again, tried_again) = runs
    assert len(tried) == 4 and len({tuple(m.items()) for m, _ in tried}) == 4
    assert chosen == again and np.allclose([s for _, s in tried], [s for _, s in tried_again])
    assert chosen == min(tried, key=lambda t: t[1])[0] and best.getOrDefault("maxDepth") == chosen["maxDepth"]
    assert tn.draw(grid, 99) != tn.draw(grid, 99, seed=1) and len(tn.draw(grid, 99)) == 6
    assert [len(list(g)) for g in tn.GRIDS.values()] == [5, 6]


def test_nested_search_predicts_every_row_from_other_periods(spark):
    df, rows = _panel(spark, 0.0)
    df = df.withColumn("id", F.monotonically_increasing_id()).cache()
    grid = {"maxIter": [2, 3], "maxDepth": [1, 2], "stepSize": [0.3]}
    pred, trials = tn.lopo_tuned(df, ["a", "b", "c"], "y", "periodo", ["id"], grid=grid, draws=2, inner=2, folds=["p1", "p3"])
    got = pred.join(df.select("id", "periodo"), "id").collect()
    assert len(got) == sum(r[0] in ("p1", "p3") for r in rows) and all(r.fold == r.periodo and r.predicho >= 0 for r in got)
    t = trials.collect()
    assert len(t) == 4 and sum(r.elegido for r in t) == 2
    for fold in {r.fold for r in t}:
        assert min((r for r in t if r.fold == fold), key=lambda r: r.rmse).elegido


def test_linear_importances(spark):
    x, y = _design()
    df = spark.createDataFrame([(float(v), *map(float, r)) for r, v in zip(x, y)], "y double, a double, b double, c double, d double")
    xs = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(xs.T @ xs + np.eye(4), xs.T @ (y - y.mean()))
    got = tn.linear_importances(df, ["a", "b", "c", "d"], "y")
    assert np.allclose([got[f] for f in "abcd"], np.abs(w), atol=1e-9)
    table = tn.importance_table(spark, {"Ridge": got}).orderBy("puesto").collect()
    assert [r.importancia for r in table] == sorted(got.values(), reverse=True)


def _panel(spark, shift, seed=11):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(150):
        x = rng.normal(size=3)
        a = None if rng.random() < 0.2 else float(x[0]) + shift
        b = None if rng.random() < 0.3 else float(x[1]) - shift
        rows.append((f"p{i % 5}", float(x @ [1, 2, 3] + rng.normal()) + shift, a, b, float(x[2])))
    return spark.createDataFrame(rows, "periodo string, y double, a double, b double, c double"), rows


def _train(rows, fold):
    """Training rows of a fold, imputed with their medians."""
    x = np.array([[np.nan if v is None else v for v in r[2:]] for r in rows if r[0] != fold])
    med = np.nanmedian(x, axis=0)
    return np.where(np.isnan(x), med, x), np.array([r[1] for r in rows if r[0] != fold]), med


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_fold_statistics_keep_their_digits(spark, shift):
    """Scales, ridge and one-feature least squares over folds, also for values near 1e9 with a spread of 1."""
    df, rows = _panel(spark, shift)
    feats, folds = ["a", "b", "c"], [f"p{i}" for i in range(5)]
    med = ev.fold_medians(df, feats, "periodo", folds)
    scale = {(r.fold, r.feature): r for r in ev.fold_scaler(df, feats, "periodo", folds, med).collect()}
    stats = ev.fold_gram_by_period(df, feats, "y", "periodo", folds, med)
    for k in folds:
        x, y, _ = _train(rows, k)
        for i, f in enumerate(feats):
            assert np.isclose(scale[k, f].media, x[:, i].mean(), rtol=1e-14) and np.isclose(scale[k, f].escala, x[:, i].std(), rtol=1e-6)
        xs = (x - x.mean(0)) / x.std(0)
        w = np.linalg.solve(xs.T @ xs + np.eye(3), xs.T @ (y - y.mean()))
        b0, beta = ev.ridge_from_gram(stats[k])
        assert np.allclose(beta, w / x.std(0), rtol=1e-6)
        assert np.allclose(b0 + x @ beta, y.mean() + xs @ w, rtol=1e-12, atol=1e-6)
    got = {r.c: r.predicho for r in ev.lopo_ols1(df, "y", "c", "periodo", ["c"]).collect()}
    for k in folds:
        x, y, _ = _train(rows, k)
        slope, cut = np.polyfit(x[:, 2], y - y.mean(), 1)
        for r in rows:
            if r[0] == k:
                assert np.isclose(got[r[4]], max(0.0, cut + slope * r[4] + y.mean()), rtol=1e-12, atol=1e-8)


@pytest.mark.parametrize("partitions", [1, 3])
def test_boosting_of_all_folds_is_that_of_each_fold(spark, partitions, monkeypatch):
    from pyspark.ml.regression import GBTRegressor
    monkeypatch.setattr(ev, "gathered", lambda rows: ev.materialize(rows.repartition(partitions)))
    df, _ = _panel(spark, 0.0)
    df = df.withColumn("id", F.monotonically_increasing_id()).localCheckpoint()
    x, folds = ["a", "b", "c"], ["p0", "p3"]
    make = lambda **kw: GBTRegressor(maxIter=12, maxDepth=3, minInstancesPerNode=4, stepSize=0.2, seed=42, **kw)
    jobs = spark.sparkContext.statusTracker()
    want = {(r.id, r.fold): (r.real, r.predicho) for r in ev.lopo_spark_ml(df, x, "y", "periodo", ["id"], make, folds).collect()}
    spark.sparkContext.setJobGroup("folds", "boosting of all folds")
    rows = ev.lopo_boosted(df, x, "y", "periodo", ["id"], folds, rounds=12, step=0.2).collect()
    spark.sparkContext.setJobGroup("", "")
    got = {(r.id, r.fold): (r.real, r.predicho) for r in rows}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], rtol=1e-9, atol=1e-9) for k in want)
    if partitions == 1:
        assert len(jobs.getJobIdsForGroup("folds")) < 80  # 36 levels, not times the folds


def test_sampled_boosting_does_not_depend_on_the_layout(spark, monkeypatch):
    df, _ = _panel(spark, 0.0)
    df = df.withColumn("id", F.monotonically_increasing_id()).localCheckpoint()
    runs = []
    for n in (1, 4):
        monkeypatch.setattr(ev, "gathered", lambda rows, n=n: ev.materialize(rows.repartition(n)))
        p = ev.lopo_boosted(df, ["a", "b", "c"], "y", "periodo", ["id"], ["p1", "p2"], rounds=4, step=0.3, share_rows=0.8, share_features=0.6)
        runs.append({r.id: r.predicho for r in p.collect()})
    assert len(runs[0]) == 60 and runs[0].keys() == runs[1].keys() and all(np.isclose(runs[0][k], runs[1][k]) for k in runs[0])


def test_a_small_table_is_boosted_in_one_job_whatever_the_rounds(spark, monkeypatch):
    from panelkit.operators import boosting
    df, _ = _panel(spark, 0.0)
    df = df.withColumn("id", F.monotonically_increasing_id()).localCheckpoint()
    jobs, runs = [], []
    for rounds, most in ((2, 50_000), (12, 50_000), (12, 100)):  # the last by levels, as a table over the bound
        monkeypatch.setattr(boosting, "BLOCK_ROWS", most, raising=False)
        spark.sparkContext.setJobGroup(f"boosting-{rounds}-{most}", "boosting")
        p = ev.lopo_boosted(df, ["a", "b", "c"], "y", "periodo", ["id"], ["p0", "p1", "p4"], rounds=rounds, step=0.2, share_rows=0.8, share_features=0.6)
        runs.append({r.id: r.predicho for r in p.collect()})
        spark.sparkContext.setJobGroup("", "")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosting-{rounds}-{most}")))
    assert jobs[0] == jobs[1] < jobs[2] - 30
    assert len(runs[1]) == 90 and runs[1].keys() == runs[2].keys() and all(np.isclose(runs[1][k], runs[2][k]) for k in runs[1])


def test_contest_models_are_fitted_at_the_same_time(spark, monkeypatch):
    from threading import Barrier

    from panelkit.plans import catalog
    keys = "provincia string, periodo string, area string, sexo string"
    f = spark.createDataFrame([("e", p, "total", "total", y, lag) for p, y, lag in (("p1", 1.0, None), ("p2", 2.0, 1.0), ("p3", 4.0, 2.0))],
                              keys + ", tasa_desempleo double, tasa_desempleo_lag1 double")
    both = Barrier(2, timeout=60)

    def model(value):
        def fit(f, features):
            both.wait()  # for the other model
            return f.select(*catalog.KEY, F.col("periodo").alias(ev.FOLD), F.col("tasa_desempleo").alias("real"), F.lit(value).alias("predicho"))
        return fit

    monkeypatch.setattr(catalog, "_ft", lambda spark, sf_dir: f)
    monkeypatch.setattr(catalog, "stored", lambda t, name, build: build())
    monkeypatch.setattr(catalog, "MODELS", {"A": model(1.0), "B": model(2.0)})
    got = {(r.modelo, r.periodo): r.predicho for r in catalog.all_predictions(spark, "unused").collect()}
    assert {k: v for k, v in got.items() if k[0] in "AB"} == {(m, p): v for m, v in (("A", 1.0), ("B", 2.0)) for p in ("p1", "p2", "p3")}
    assert sum(k[0] == "Persistencia" for k in got) == 3 and sum(k[0] == "MCO1" for k in got) == 2


def test_numbers_and_names_as_sql_text(spark):
    values = [0.1 + 0.2, -1e-300, 1.7976931348623157e308, 5.0, float("inf"), float("nan"), None]
    row = spark.range(1).selectExpr(*[f"{ev.literal(v)} AS {ev.quoted(f'a`{i}')}" for i, v in enumerate(values)]).first()
    assert row.__fields__ == [f"a`{i}" for i in range(7)] and all(a is b or a == b or (a != a and b != b) for a, b in zip(row, values))
