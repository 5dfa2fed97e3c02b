"""Forests that stay in their files: scores, copies and explanations without the trees on the driver."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import RandomForestRegressionModel

from seriesforge.config import ModelConfig
from seriesforge.operators import forests, matrix, models, trees
from seriesforge.plans import pipelines
from seriesforge.sources.registry import ModelRegistry

CFG = ModelConfig(forest_trees=7, forest_depth=6)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 2000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 5, n).astype(float), "c": rng.random(n)})
    pdf[matrix.TARGET] = 3 * pdf.a - pdf.b + np.where(pdf.c > 0.5, 4, 0) + 50
    return matrix.assemble(spark.createDataFrame(pdf), ("a", "b", "c")).cache()


@pytest.fixture(scope="module")
def forest(rows):
    return forests.fit_forest(rows, CFG)


@pytest.fixture
def collected(spark, monkeypatch):
    """The numbers of rows brought to the driver."""
    found, kind = [], type(spark.range(0))
    for name in ("collect", "toPandas"):
        def counted(df, way=getattr(kind, name)):
            out = way(df)
            found.append(len(out))
            return out
        monkeypatch.setattr(kind, name, counted)
    return found


def scores(model, df):
    return np.array([r[0] for r in model.transform(df).select("prediction").collect()])


def test_scores_equal_those_of_mllib_and_other_columns_stay(rows, forest):
    theirs = RandomForestRegressionModel.load(forest.path)
    np.testing.assert_allclose(scores(forest, rows), scores(theirs, rows), rtol=1e-12)
    assert forest.transform(rows).columns == [*rows.columns, "prediction"]
    assert scores(forest, rows.limit(0)).shape == (0,)


def test_no_model_of_mllib_and_no_row_a_node_on_the_driver(spark, rows, monkeypatch, tmp_path, collected):
    monkeypatch.setattr(RandomForestRegressionModel, "load", None)
    fitted = models.train_all(rows, CFG, ("random_forest",))
    registry = ModelRegistry(spark, str(tmp_path))
    comparison = models.compare(fitted, rows)
    trained = pipelines.Trained(matrix.FeatureSet(("a", "b", "c")), fitted, comparison, rows, rows)
    assert pipelines.register_all(trained, registry) == {"random_forest": 1}
    nodes = pipelines.predictor_of(registry, registry.pick("aqi_random_forest"))
    assert max(collected) <= 7 and len(nodes.shipped(spark)().feature) > 200
    again = registry.load(registry.pick("aqi_random_forest"))
    np.testing.assert_array_equal(scores(again, rows), scores(fitted["random_forest"], rows))
    with pytest.raises(FileExistsError):
        fitted["random_forest"].write().save(again.path)


def test_nan_goes_where_mllib_sends_it(spark, forest):
    odd = matrix.assemble(spark.createDataFrame([(0.1, 2.0, 0.7), (-2.0, 0.0, 0.1)], "a double, b double, c double"), ("a", "b", "c"))
    bad = matrix.VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(
        spark.createDataFrame([(float("nan"), 2.0, 0.7), (0.3, float("nan"), float("inf"))], "a double, b double, c double")).select("features")
    theirs = RandomForestRegressionModel.load(forest.path)
    for df in (odd, bad):
        np.testing.assert_allclose(scores(forest, df), scores(theirs, df), rtol=1e-12)


def test_trees_are_explained_some_at_a_time(spark, forest):
    whole = trees.nodes_of(spark, forest, ("a", "b", "c"), averaged=True)
    x = np.random.default_rng(6).normal(size=(30, 3))
    want, base = whole.attribute(x)
    assert "paths" in vars(whole)
    parted = trees.replace(whole)
    got, part_base = parted.attribute(x, at_once=100)
    np.testing.assert_allclose(got, want, atol=1e-9)
    assert part_base == pytest.approx(base)
    assert "paths" not in vars(parted)
    assert len(list(parted.path_parts(100))) == 7
    np.testing.assert_allclose(got.sum(axis=1) + part_base, parted.predict(x), rtol=1e-9)


def test_rows_and_trees_go_down_in_blocks_of_any_size(spark, forest, monkeypatch):
    x = np.random.default_rng(7).normal(size=(1000, 3))
    nodes = trees.nodes_of(spark, forest, ("a", "b", "c"), averaged=True)
    want = nodes.predict(x)
    monkeypatch.setattr(trees, "ROWS_AT_ONCE", 33)
    monkeypatch.setattr(trees, "STEPS_AT_ONCE", 70)
    np.testing.assert_allclose(nodes.predict(x), want, rtol=1e-12)


def test_nodes_for_tasks_leave_no_arrays_on_the_driver(spark, forest):
    sent = trees.send_nodes(spark, forest.path, ("a", "b", "c"), averaged=True)
    assert set(vars(sent)) == {"columns", "arrays"} and "_value" not in vars(sent.arrays) and sent.columns == ("a", "b", "c")
    assert not any(isinstance(v, (np.ndarray, trees.TreeNodes)) for v in vars(forest).values())


@pytest.mark.parametrize("kept", [100_000, 40])
def test_only_the_child_of_fewer_rows_is_counted(monkeypatch, kept):
    rng = np.random.default_rng(10)
    bins = np.stack([rng.integers(0, 30, 4000), rng.integers(0, 4, 4000), rng.integers(0, 12, 4000)]).astype(np.uint8)
    y, w = rng.integers(-500, 500, 4000).astype(float), rng.integers(1, 4, 4000).astype(float)  # sums are exact
    counted, way = [], forests._counted
    monkeypatch.setattr(forests, "_counted", lambda bins, at, *rest: counted.append(len(at)) or way(bins, at, *rest))
    monkeypatch.setattr(forests, "WORTH_ROWS", 0)
    monkeypatch.setattr(forests, "KEPT", 0)
    want, each = forests.grown(bins, y, w, 1, 8), sum(counted)
    monkeypatch.setattr(forests, "KEPT", kept)
    counted.clear()
    got = forests.grown(bins, y, w, 1, 8)
    for level, other in zip(want, got, strict=True):
        for a, b in zip(level, other, strict=True):
            np.testing.assert_array_equal(a, b)
    assert counted[0] == 4000 and sum(counted) < (0.7 if kept > 40 else 1) * each


def test_trees_that_fit_a_task_take_no_histograms_of_all_tasks(rows, monkeypatch):
    monkeypatch.setattr(forests, "LOCAL_ROWS", 100)
    monkeypatch.setattr(forests, "_histograms", None)
    assert len(scores(forests.fit_forest(rows, CFG), rows)) == 2000
