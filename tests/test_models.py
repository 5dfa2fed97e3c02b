"""Matrix fitting, regressors, metrics and tree attributions against direct computations."""

import threading
import time
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesforge.config import ModelConfig
from seriesforge.operators import explain, forests, matrix, models, trees
from seriesforge.plans import catalog, pipelines


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 5, n).astype(float), "c": rng.random(n)})
    pdf[matrix.TARGET] = 3 * pdf.a - pdf.b + np.where(pdf.c > 0.5, 4, 0) + rng.normal(size=n) * 0.1
    return pdf, matrix.assemble(spark.createDataFrame(pdf), ("a", "b", "c")).cache()


def test_ridge_closed_form(data):
    pdf, df = data
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf[matrix.TARGET].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(3), xc.T @ yc)
    model = models.fit_ridge(df, 7.0)
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-8)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want)


def test_a_ridge_with_an_indicator_a_series_equals_the_wide_one(spark):
    rng = np.random.default_rng(3)
    rows = [(f"c{i % 7}" if i % 11 else None, float(i % 5), float(rng.normal()), float(rng.normal() + i % 7)) for i in range(400)]
    frame = spark.createDataFrame(rows, "city string, a double, b double, aqi double")
    x = np.array([[a, b, *[float(c == f"c{k}") for k in range(7)]] for c, a, b, _ in rows])
    y = np.array([r[3] for r in rows])
    xc = x - x.mean(0)
    want = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(9), xc.T @ (y - y.mean()))
    got = models.fit_series_ridge(frame, ("a", "b"), target="aqi", alpha=2.0)
    np.testing.assert_allclose(got.coefficients, want[:2], atol=1e-10)
    np.testing.assert_allclose([r.weight for r in got.series.orderBy("city").collect()], want[2:], atol=1e-10)
    assert got.intercept == pytest.approx(y.mean() - x.mean(0) @ want)


def test_twenty_thousand_series_need_no_vector_of_their_indicators(spark, monkeypatch):
    monkeypatch.setattr(models, "LinearRegression", None)
    rows = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("city"), (F.col("id") % 20_000 + F.col("id") % 3).cast("double").alias("aqi"))
    found = models.fit_series_ridge(rows, target="aqi")
    assert found.series.count() == 20_000 and found.intercept == pytest.approx(10_000.5)


def test_models_beat_the_mean_and_metrics_agree(data):
    pdf, df = data
    fitted = models.train_all(df, ModelConfig.small())
    table = {r.model: r for r in models.compare(fitted, df).collect()}
    assert set(table) == {"ridge", "random_forest", "boosted_trees"}
    assert all(r.rmse < pdf[matrix.TARGET].std() for r in table.values())
    p = np.array([r[0] for r in fitted["ridge"].transform(df).select("prediction").collect()])
    y = np.array([r[0] for r in df.select(matrix.TARGET).collect()])
    assert table["ridge"].rmse == pytest.approx(np.sqrt(np.mean((p - y) ** 2)))
    assert table["ridge"].mae == pytest.approx(np.mean(np.abs(p - y)))
    assert table["ridge"].r2 == pytest.approx(1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))


def test_constant_target_r2(spark):
    df = spark.createDataFrame([("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("miss", 2.0, 3.0)], "g string, y double, p double")
    assert {r.g: r.r2 for r in models.error_metrics(df, ["g"]).collect()} == {"hit": 1.0, "miss": 0.0}


def brute_force_shapley(nodes, x):
    """Shapley values by enumerating feature subsets of the cover game."""
    used = sorted(set(nodes.feature[nodes.feature >= 0]))

    def value(known):
        def walk(node):
            f = nodes.feature[node]
            if f < 0:
                return nodes.value[node]
            left, right = nodes.left[node], nodes.right[node]
            if f in known:
                return walk(left if x[f] <= nodes.threshold[node] else right)
            return (nodes.cover[left] * walk(left) + nodes.cover[right] * walk(right)) / nodes.cover[node]
        return sum(w * walk(r) for w, r in zip(nodes.weights, nodes.roots))

    phi = np.zeros(len(x))
    for f in used:
        rest = [g for g in used if g != f]
        for size in range(len(rest) + 1):
            share = factorial(size) * factorial(len(rest) - size) / factorial(len(used))
            phi[f] += share * sum(value({*s, f}) - value(set(s)) for s in combinations(rest, size))
    return phi, value(set())


@pytest.mark.parametrize("kind", ["random_forest", "boosted_trees"])
def test_tree_prediction_and_attribution(spark, data, kind):
    pdf, df = data
    cfg = ModelConfig(forest_trees=4, forest_depth=4, boost_rounds=4, boost_depth=3)
    model = models.fit_forest(df, cfg) if kind == "random_forest" else models.fit_boosted(df, cfg)
    nodes = trees.nodes_of(spark, model, ("a", "b", "c"), averaged=kind == "random_forest")
    x = pdf[["a", "b", "c"]].to_numpy()
    want = np.array([r[0] for r in model.transform(df).select("prediction").collect()])
    got_order = np.array([[r.features[i] for i in range(3)] for r in df.select("features").collect()])
    np.testing.assert_allclose(nodes.predict(got_order), want, rtol=1e-9)
    phi, base = nodes.attribute(x)
    np.testing.assert_allclose(phi.sum(axis=1) + base, nodes.predict(x), rtol=1e-9)
    for i in range(5):
        slow, slow_base = brute_force_shapley(nodes, x[i])
        np.testing.assert_allclose(phi[i], slow, atol=1e-9)
        assert base == pytest.approx(slow_base)


def grown(rng, features, count, depth):
    """Random trees whose covers add up, in node arrays."""
    feature, threshold, left, right, value, cover, roots = [], [], [], [], [], [], []

    def grow(level, rows):
        at = len(feature)
        for part, item in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, float(rng.normal())), (cover, float(rows))):
            part.append(item)
        if level < depth and rows >= 2:
            feature[at], threshold[at] = int(rng.integers(features)), float(rng.normal())
            share = int(rng.integers(1, rows))
            left[at], right[at] = grow(level + 1, share), grow(level + 1, rows - share)
        return at

    for _ in range(count):
        roots.append(grow(0, 4000))
    return trees.TreeNodes(tuple("f%d" % i for i in range(features)), *(np.array(p) for p in (roots, feature, threshold, left, right, value, cover)),
                           rng.random(count))


def test_attributions_by_path_tables_equal_enumeration():
    rng = np.random.default_rng(12)
    nodes = grown(rng, 6, 5, 7)
    x = rng.normal(size=(40, 6))
    phi, base = nodes.attribute(x)
    for i in range(40):
        slow, slow_base = brute_force_shapley(nodes, x[i])
        np.testing.assert_allclose(phi[i], slow, atol=1e-9)
        assert base == pytest.approx(slow_base)
    # Blocks of any size give the same, and so does one row at a time.
    small = np.zeros_like(phi)
    for table in nodes.paths[1]:
        table.add_to(small, x, cells=50)
    np.testing.assert_allclose(small, phi, atol=1e-9)
    np.testing.assert_allclose(np.vstack([nodes.attribute(r[None])[0] for r in x]), phi, atol=1e-9)
    assert nodes.attribute(x[:0])[0].shape == (0, 6)


def test_a_large_forest_is_explained_for_many_rows():
    rng = np.random.default_rng(13)
    nodes = grown(rng, 14, 10, 12)
    x = rng.normal(size=(2000, 14))
    start = time.perf_counter()
    phi, base = nodes.attribute(x)
    took = time.perf_counter() - start
    np.testing.assert_allclose(phi.sum(axis=1) + base, nodes.predict(x), rtol=1e-9, atol=1e-9)
    assert took < 60


def test_feature_matrix_fit_and_replay(spark):
    rows = [("x", 1.0, 10.0, None, True, "5", 1), ("x", 2.0, None, None, False, "bad", 2), ("y", 3.0, 30.0, 1.0, True, "7", 3),
            ("y", None, 99.0, 1.0, True, "9", 4)]
    df = spark.createDataFrame(rows, "city string, aqi double, temp double, humidity double, is_stale boolean, "
                                     "lag_1h_aqi string, ingest_seq bigint")
    fitted = matrix.fit_features(df)
    # humidity misses two of three labelled rows, so it goes; temp misses one and stays.
    assert fitted.columns == ("temp", "is_stale", "lag_1h_aqi", "city_x", "city_y")
    assert fitted.medians == {"temp": 20.0, "is_stale": 1.0, "lag_1h_aqi": 6.0, "city_x": 1.0, "city_y": 0.0}
    other = spark.createDataFrame([("z", 5.0, None)], "city string, aqi double, temp double")
    row = matrix.transform_features(other, fitted).first()
    assert (row.temp, row.is_stale, row.lag_1h_aqi, row.city_x, row.city_y) == (20.0, 0.0, 0.0, 0.0, 0.0)
    assert "pm25" not in matrix.candidate_columns(df.withColumn("pm25", F.lit(1.0)))


def test_explain_dispatch(spark):
    weights = models.LinearWeights(("hour", "lag_1h_aqi", "city_a", "city_b", "odd"), (1.0, 2.0, 5.0, 7.0, -0.5), 0.0)
    medians = {"hour": 10.0, "lag_1h_aqi": 50.0, "city_a": 0.0, "city_b": 0.0, "odd": 0.0}
    rows = spark.createDataFrame([("a", 12.0, 49.0, 1.0, 0.0, 4.0)], "city string, hour double, lag_1h_aqi double, "
                                                                     "city_a double, city_b double, odd double")
    top = explain.explain("ridge", weights, rows, medians, top_n=4).orderBy("rank").collect()
    assert [(r.label, r.attribution) for r in top] == [
        ("Being in a", 5.0), ("Time of day", 2.0), ("AQI an hour ago", -2.0), ("odd", -2.0)]
    assert explain.explain("sequence", None, rows, medians) is None
    with pytest.raises(ValueError):
        explain.explain("oracle", None, rows, medians)


def test_families_are_fitted_at_the_same_time_and_only_those_asked_for(data, monkeypatch):
    meeting = threading.Barrier(2, timeout=20)
    for name in ("fit_forest", "fit_boosted"):
        monkeypatch.setattr(models, name, lambda train, cfg: meeting.wait())
    monkeypatch.setattr(models, "fit_ridge", None)
    assert set(models.train_all(data[1], families=("random_forest", "boosted_trees"))) == {"random_forest", "boosted_trees"}


def test_a_forecast_by_the_forest_fits_no_other_family(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(catalog.MD, "train_all", lambda train, cfg, families: fitted.extend(families) or {n: n for n in families})
    monkeypatch.setattr(catalog.PL, "prepare_training", lambda features: pipelines.Prepared(None, None, None))
    monkeypatch.setattr(catalog.PL, "compared", lambda prepared, found: found)
    monkeypatch.setattr(catalog, "_features_table", lambda spark, sf_dir: None)
    assert set(catalog._trained(spark, "/made-up", "random_forest")) == {"random_forest"} and fitted == ["random_forest"]
    assert set(catalog._trained(spark, "/made-up")) == set(models.FAMILIES) and fitted == ["random_forest", "ridge", "boosted_trees"]


def test_forests_grown_beside_their_rows_equal_those_grown_from_histograms(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "b": rng.integers(0, 5, 3000).astype(float), "c": rng.random(3000).round(2)})
    pdf[matrix.TARGET] = 3 * pdf.a - pdf.b + np.where(pdf.c > 0.5, 4, 0) + 100
    df = matrix.assemble(spark.createDataFrame(pdf), ("a", "b", "c")).cache()
    cfg = ModelConfig(forest_trees=3, forest_depth=6)
    near = trees.nodes_of(spark, forests.fit_forest(df, cfg), ("a", "b", "c"), averaged=True)
    far = trees.nodes_of(spark, forests.fit_forest(df, cfg, local_rows=200), ("a", "b", "c"), averaged=True)
    every = trees.nodes_of(spark, forests.fit_forest(df, cfg, local_rows=1), ("a", "b", "c"), averaged=True)
    for other in (far, every):
        for name in ("feature", "threshold", "left", "right", "cover"):
            np.testing.assert_array_equal(getattr(near, name), getattr(other, name))
        np.testing.assert_allclose(near.value, other.value, rtol=1e-9)
    # Every row is in the bootstrap: as many draws a tree as rows, up to chance.
    assert all(abs(n - 3000) < 300 for n in near.cover[near.roots])


def test_a_tree_splits_where_the_error_falls_most():
    rng = np.random.default_rng(9)
    bins, y, w = rng.integers(0, 6, (3, 80)).astype(np.uint8), rng.normal(size=80), rng.integers(1, 4, 80).astype(float)
    sse = lambda rows: float((w[rows] * (y[rows] - np.average(y[rows], weights=w[rows])) ** 2).sum())
    (path, feature, cut, drop, n, s, q), *below = forests.grown(bins, y, w, 1, 1)
    left = lambda f, c: bins[f] <= c
    drops = {(f, c): sse(w > 0) - sse(left(f, c)) - sse(~left(f, c)) for f in range(3) for c in range(6) if 0 < left(f, c).sum() < 80}
    assert (feature[0], cut[0]) == max(drops, key=drops.get) and drop[0] == pytest.approx(max(drops.values()))
    assert below[0][0].tolist() == [2, 3] and below[0][4].sum() == w.sum() and (below[0][1] < 0).all()


def test_rounds_run_in_whole_waves():
    assert [models.boost_tasks(n, 8) for n in (1000, 240_000, 480_000, 4_800_000)] == [2, 4, 8, 16]
    assert models.boost_tasks(28_800_000, 12) == 60
