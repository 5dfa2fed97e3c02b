"""Levels of series: nothing of a row's own day, nothing of the test rows, and forests over very many series."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.config import ModelConfig
from seriesforge.operators import levels, matrix, models
from seriesforge.plans import pipelines
from seriesforge.sources.registry import ModelRegistry

T0 = datetime(2024, 1, 1)
SCHEMA = "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint"


def table(spark, rows):
    return spark.createDataFrame([(c, None if h is None else T0 + timedelta(hours=h), v, i) for i, (c, h, v) in enumerate(rows)], SCHEMA)


def test_levels_by_hand(spark):
    df = table(spark, [("a", 0, 10.0), ("a", 5, 20.0), ("a", 25, 60.0), ("a", 80, 2.0), ("b", 1, 100.0), ("b", None, 8.0), (None, 2, 4.0)])
    got = {r.ingest_seq: r.series_level for r in levels.ordered_levels(df, 30.0).collect()}
    assert got == pytest.approx({0: 30.0, 1: 30.0, 2: 330 / 12, 3: 390 / 13, 4: 30.0, 5: 30.0, 6: 30.0})
    known = levels.fit_levels(df, 30.0)
    assert {r.city: r.series_level for r in known.collect()} == pytest.approx({"a": 392 / 14, "b": 408 / 12})
    served = levels.with_levels(table(spark, [("a", 999, 1e9), ("new", 0, 1.0)]), known)
    assert {r.city: r.series_level for r in served.collect()} == {"a": pytest.approx(392 / 14), "new": None}


def test_a_row_never_knows_its_own_target(spark):
    rng = np.random.default_rng(1)
    rows = [(f"s{rng.integers(5)}", int(rng.integers(0, 400)), float(rng.gamma(2, 30))) for _ in range(300)]
    base = {r.ingest_seq: r.series_level for r in levels.ordered_levels(table(spark, rows), 50.0).collect()}
    changed = [(c, h, v + 1e6 if i % 3 == 0 else v) for i, (c, h, v) in enumerate(rows)]
    after = {r.ingest_seq: r.series_level for r in levels.ordered_levels(table(spark, changed), 50.0).collect()}
    day = [h // 24 for _, h, _ in rows]
    for i, (c, _, _) in enumerate(rows):
        earlier = any(k % 3 == 0 and rows[k][0] == c and day[k] < day[i] for k in range(300))
        assert (after[i] != base[i]) == earlier


def test_a_forest_takes_a_hundred_thousand_series(spark):
    n = 100_000
    rows = spark.range(3 * n).select(
        F.concat(F.lit("s"), F.col("id") % n).alias("city"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") / n) * 86_400).cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % n % 100 + F.col("id") % 7).cast("double").alias("aqi"), F.col("id").alias("ingest_seq"))
    early = rows.filter(F.col("ingest_seq") < 2 * n)
    prior = levels.prior_of(early)
    train = levels.ordered_levels(early, prior)
    fitted = matrix.fit_features(train, with_cities=False)
    assert fitted.columns == (levels.LEVEL,)
    model = models.fit_forest(matrix.vectorise(train, fitted), ModelConfig(forest_trees=5, forest_depth=6))
    test = matrix.vectorise(levels.with_levels(rows.filter(F.col("ingest_seq") >= 2 * n), levels.fit_levels(early, prior)), fitted)
    errors = models.error_metrics(models.predictions_long({"forest": model}, test), ["model"]).first()
    assert errors["n"] == n and errors["r2"] > 0.3         # series differ, and the level tells them apart


def test_models_with_levels_are_registered_and_served(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(f"s{s}", h, float(20 * s + rng.normal())) for s in range(6) for h in range(0, 120, 2)]
    raw = table(spark, rows)
    features = pipelines.engineer_features(raw)
    trained = pipelines.train_and_compare(pipelines.materialize(features, "features"), ModelConfig(forest_trees=5, forest_depth=5, boost_rounds=3, boost_depth=3),
                                          with_levels=True)
    assert levels.LEVEL in trained.features.columns and not any(c.startswith("city_") for c in trained.features.columns)
    registry = ModelRegistry(spark, str(tmp_path))
    pipelines.register_all(trained, registry)
    for choice in ("Random Forest", "Ridge Regression"):
        served = pipelines.forecast_all(raw, registry, choice, 3).groupBy("city").agg(F.avg("predicted_aqi").alias("p")).collect()
        got = {r.city: r.p for r in served}
        assert len(got) == 6 and all(abs(got[f"s{s}"] - 20 * s) < 25 for s in range(6)), (choice, got)
    assert pipelines.explain_next_hour(raw, registry, "Random Forest").filter(F.col("feature") == levels.LEVEL).count() > 0
