"""Training and serving jobs: many series, stored scalers, refusals, incremental backfill."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge import schema as S
from seriesforge.config import HOUR_US, ModelConfig
from seriesforge.operators import matrix, models, sequences
from seriesforge.operators.features import engineer_features
from seriesforge.plans import pipelines
from seriesforge.sources.registry import ModelRegistry
from seriesforge.sources.tables import KeyedTable

T0 = datetime(2024, 1, 1)


def hourly(spark, cities, hours, value=lambda c, h: float((h * 7 + len(c)) % 50), start=T0):
    rows = [(c, start + timedelta(hours=h), value(c, h), i * hours + h) for i, c in enumerate(cities) for h in range(hours)]
    return spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint")


def test_sparse_indicators_equal_the_wide_matrix(spark):
    rows = hourly(spark, ["a", "b", "c"], 8).withColumn("x", F.col("ingest_seq") * 1.5)
    fitted = matrix.fit_features(rows.filter("city <> 'c'"))
    assert fitted.columns == ("x", "city_a", "city_b")
    wide = matrix.transform_features(rows, fitted, keep=("ingest_seq",)).orderBy("_ingest_seq").collect()
    thin = matrix.vectorise(rows, fitted, keep=("ingest_seq",)).orderBy("_ingest_seq").collect()
    for w, t in zip(wide, thin, strict=True):
        assert list(t[matrix.FEATURES].toArray()) == [w[c] for c in fitted.columns] and t[matrix.TARGET] == w[matrix.TARGET]


def test_training_takes_six_hundred_series(spark):
    cities = [f"s{i:03d}" for i in range(600)]
    rows = hourly(spark, cities, 10, lambda c, h: float(int(c[1:]) % 40 + h))
    cfg = ModelConfig(forest_trees=2, forest_depth=3, boost_rounds=2, boost_depth=2)
    features = rows.withColumn("hour", F.hour("timestamp").cast("double"))
    trained = pipelines.train_and_compare(features, cfg)
    assert len(trained.features.cities) == 600
    ridge = {r.model: r for r in trained.comparison.collect()}["ridge"]
    assert ridge.n == 1200 and ridge.rmse < 6
    without = pipelines.train_and_compare(features, cfg, with_cities=False)
    assert without.features.columns == ("hour",)
    model, scalers, names, metrics = pipelines.train_sequences(rows, length=3)
    assert len(names) == scalers.count() == 600 and metrics.first().rmse < 3


def test_a_sequence_model_keeps_its_scalers_and_refuses_unknown_and_short_series(spark, tmp_path):
    rows = hourly(spark, ["a", "b"], 24 * 8)
    early = rows.filter(F.col("timestamp") < F.lit(T0 + timedelta(days=5)))
    model, scalers, cities, metrics = pipelines.train_sequences(early)
    registry = ModelRegistry(spark, str(tmp_path))
    pipelines.register_sequence(model, cities, scalers, metrics.first().asDict(), registry)
    # Later readings with a new maximum do not change what the model was scaled by.
    late = rows.withColumn("aqi", F.when(F.col("timestamp") == F.lit(T0 + timedelta(days=6)), 900.0).otherwise(F.col("aqi")))
    assert registry.pick("aqi_sequence")["sequence_length"] == 24
    plain, spiked = (pipelines.forecast_all(r, registry, "Sequence").orderBy("city", "step").collect() for r in (rows, late))
    assert len(plain) == 144 and all(r.predicted_aqi <= 50 for r in plain + spiked)
    with pytest.raises(ValueError, match="no scaler for c"):
        pipelines.forecast_all(rows.unionByName(hourly(spark, ["c"], 48, start=T0 + timedelta(days=6))), registry, "Sequence")
    with pytest.raises(ValueError, match="fewer than 24 recent readings for b"):
        pipelines.forecast_all(rows.filter("city = 'a' or hour(timestamp) = 3"), registry, "Sequence")


def test_missing_scalers(spark):
    rows = hourly(spark, ["a", "b", "c"], 3)
    assert [r.city for r in sequences.missing_scalers(rows, sequences.fit_scalers(rows.filter("city = 'b'"))).orderBy("city").collect()] == ["a", "c"]


def test_backfill_in_two_parts_equals_one(spark, tmp_path):
    rows = pipelines.to_raw_schema(hourly(spark, ["a", "b"], 24 * 10))
    made = []
    for name, parts in (("one", [rows]), ("two", [rows.filter(F.dayofmonth("timestamp") != 4), rows.filter(F.dayofmonth("timestamp") == 4)])):
        raw = KeyedTable(spark, str(tmp_path / name / "raw"), S.RAW_READINGS)
        features = KeyedTable(spark, str(tmp_path / name / "features"), engineer_features(spark.createDataFrame([], S.RAW_READINGS)).schema)
        for part in parts:
            assert pipelines.run_feature_refresh(part, raw, features)
        made.append(sorted(map(str, features.scan().collect())))
    assert made[0] == made[1] and len(made[0]) == 480


def test_stored_buckets_narrow_where_readings_are_dense(spark, tmp_path, monkeypatch):
    rows = pipelines.to_raw_schema(hourly(spark, ["a", "b"], 24 * 10))
    made = []
    for name, most in (("usual", 100_000), ("narrow", 20)):
        monkeypatch.setattr(pipelines, "BUCKET_ROWS", most, raising=False)
        raw = KeyedTable(spark, str(tmp_path / name / "raw"), S.RAW_READINGS)
        features = KeyedTable(spark, str(tmp_path / name / "features"), engineer_features(spark.createDataFrame([], S.RAW_READINGS)).schema)
        for part in (rows.filter(F.dayofmonth("timestamp") != 4), rows.filter(F.dayofmonth("timestamp") == 4)):
            assert pipelines.run_feature_refresh(part, raw, features)
        made.append((sorted(map(str, features.scan().collect())), [int(w) // HOUR_US for w in raw.folders("edges")]))
    assert made[0][0] == made[1][0] and len(made[0][0]) == 480
    assert [widths for _, widths in made] == [[96], [12]]


def test_ridge_on_indicators_alone_has_its_closed_form(spark):
    rng = np.random.default_rng(1)
    rows = [(f"c{i % 60}", float(rng.normal() + i % 60), i) for i in range(1200)]
    frame = spark.createDataFrame(rows, "city string, aqi double, ingest_seq bigint")
    fitted = matrix.fit_features(frame)
    w = models.LinearWeights.of(models.fit_ridge(matrix.vectorise(frame, fitted)), fitted.columns)
    n = {c: 20 for c in fitted.cities}
    mean = {c: np.mean([v for k, v, _ in rows if k == c]) for c in fitted.cities}
    b = sum(n[c] / (n[c] + 1) * mean[c] for c in n) / sum(n[c] / (n[c] + 1) for c in n)
    assert w.intercept == pytest.approx(b) and w.city_weights["c7"] == pytest.approx(20 * (mean["c7"] - b) / 21)
