"""Series features on hand-built edges and against pandas on random irregular series."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from seriesforge.config import FeatureConfig, SeriesSpec
from seriesforge.operators import buckets, cells, features
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
SCHEMA = "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint"
MODES = [dict(mode="halo", dense=True), dict(mode="halo", dense=False), dict(mode="window", dense=True),
         dict(mode="cells", cfg=FeatureConfig(cell_rows=3))]
NAMES = features.feature_names(SeriesSpec(), FeatureConfig())


def series(spark, points, city="a"):
    rows = [(city, T0 + timedelta(minutes=m), v, i) for i, (m, v) in enumerate(points)]
    return spark.createDataFrame(rows, SCHEMA)


def by_minute(df):
    return {int((r.timestamp - T0).total_seconds() // 60): r for r in df.collect()}


@pytest.mark.parametrize("opts", MODES)
def test_lag_ties_tolerance_and_null_match(spark, opts):
    df = series(spark, [(0, 1.0), (20, 2.0), (70, 3.0), (100, None), (160, 5.0), (176, 6.0), (191, 7.0)])
    got = by_minute(features.add_lag_features(df, **opts))
    assert got[70].lag_1h_aqi == 1.0          # target 10: rows 0 and 20 tie, the earlier wins
    assert got[160].lag_1h_aqi is None        # exact partner at 100 is null and stays null
    assert got[176].lag_1h_aqi is None        # target 116: partner 100 is 16 min away
    assert got[191].lag_1h_aqi is None and got[0].lag_1h_aqi is None
    edge = by_minute(features.add_lag_features(series(spark, [(0, 1.0), (75, 2.0), (136, 3.0)]), **opts))
    assert edge[75].lag_1h_aqi == 1.0         # 15 min is inside
    assert edge[136].lag_1h_aqi == 2.0


@pytest.mark.parametrize("opts", MODES)
def test_rolling_window_is_left_open_and_std_is_sample(spark, opts):
    df = series(spark, [(0, 10.0), (60, 20.0), (180, 40.0), (181, None)])
    got = by_minute(features.add_rolling_features(df, **opts))
    assert got[0].rolling_3h_mean_aqi == 10.0 and got[0].rolling_3h_std_aqi is None
    assert got[180].rolling_3h_mean_aqi == 30.0          # minute 0 is exactly three hours back
    assert got[180].rolling_3h_std_aqi == pytest.approx(np.std([20, 40], ddof=1))
    assert got[181].rolling_3h_mean_aqi == 30.0          # nulls are skipped


@pytest.mark.parametrize("opts", MODES)
def test_change_rate_zero_null_and_long_gaps(spark, opts):
    month = 60 * 24 * 30
    df = series(spark, [(0, 0.0), (10, 5.0), (20, None), (30, 4.0), (month, 8.0), (3 * month, 2.0)])
    got = by_minute(features.add_change_rate(df, **opts))
    assert got[0].aqi_change_rate is None and got[10].aqi_change_rate is None
    assert got[20].aqi_change_rate is None and got[30].aqi_change_rate is None
    assert got[month].aqi_change_rate == 1.0             # the previous row is many buckets back
    assert got[3 * month].aqi_change_rate == -0.75


def random_series(seed, n=400):
    rng = np.random.default_rng(seed)
    frames = []
    for city in ("a", "b", "c"):
        gaps = rng.choice([1, 7, 15, 30, 60, 61, 75, 240, 60 * 30, 60 * 24 * 6], size=n,
                          p=[.1, .1, .15, .15, .3, .05, .05, .07, .02, .01])
        ts = pd.Timestamp("2023-12-20") + pd.to_timedelta(np.cumsum(gaps), unit="min")
        v = np.round(rng.gamma(2, 25, n), 2)
        v[rng.random(n) < 0.1] = np.nan
        v[rng.random(n) < 0.05] = 0.0
        frames.append(pd.DataFrame({"city": city, "timestamp": ts, "aqi": v}))
    out = pd.concat(frames, ignore_index=True)
    out["ingest_seq"] = np.arange(len(out))
    return out


def pandas_features(pdf):
    pieces = []
    for _, g in pdf.groupby("city"):
        g = g.sort_values("timestamp").reset_index(drop=True)
        for lag in (1, 3, 24):
            q = pd.DataFrame({"at": g.timestamp - pd.Timedelta(hours=lag)})
            hit = pd.merge_asof(q, g[["timestamp", "aqi"]], left_on="at", right_on="timestamp", direction="nearest",
                                tolerance=pd.Timedelta(hours=max(0.2 * lag, 0.25)))
            g[f"lag_{lag}h_aqi"] = hit["aqi"].to_numpy()
        by_time = g.set_index("timestamp")["aqi"]
        for w in (3, 24):
            g[f"rolling_{w}h_mean_aqi"] = by_time.rolling(f"{w}h", min_periods=1).mean().to_numpy()
            g[f"rolling_{w}h_std_aqi"] = by_time.rolling(f"{w}h", min_periods=1).std().to_numpy()
        prev = g.aqi.shift(1)
        g["aqi_change_rate"] = (g.aqi - prev) / prev.replace(0, np.nan)
        pieces.append(g)
    return pd.concat(pieces)


def to_frame(df):
    return df.toPandas().sort_values(["city", "timestamp"], ignore_index=True)


def assert_same(got, want, names=NAMES):
    want = want.sort_values(["city", "timestamp"], ignore_index=True)
    assert len(got) == len(want)
    for c in names:
        a, b = got[c].to_numpy(dtype=float), want[c].to_numpy(dtype=float)
        assert (np.isnan(a) == np.isnan(b)).all(), c
        np.testing.assert_allclose(a, b, atol=2e-6, equal_nan=True, err_msg=c)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("opts", MODES + [dict(cfg=FeatureConfig(bucket_hours=5)), dict(cfg=FeatureConfig(bucket_hours=24))])
def test_matches_pandas(spark, seed, opts):
    pdf = random_series(seed)
    df = spark.createDataFrame(pdf.replace({np.nan: None}), SCHEMA)
    assert_same(to_frame(features.engineer_features(df, **opts)), pandas_features(pdf))


def test_repeats_and_missing_times(spark):
    pdf = random_series(5, 100)
    again = pdf.assign(aqi=pdf.aqi + 1, ingest_seq=pdf.ingest_seq + 1000)
    rows = pd.concat([again, pdf]).replace({np.nan: None})
    df = spark.createDataFrame(rows, SCHEMA).unionByName(
        spark.createDataFrame([("a", None, 3.0, 9999)], SCHEMA))
    assert_same(to_frame(features.engineer_features(df)), pandas_features(again))


def test_empty_in_empty_out(spark):
    out = features.engineer_features(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and set(NAMES) <= set(out.columns)


@pytest.mark.parametrize("late_share", [0.02, 0.3])
def test_refresh_equals_full_recompute(spark, late_share):
    cfg, spec = FeatureConfig(bucket_hours=48), SeriesSpec()
    pdf = random_series(9)
    df = spark.createDataFrame(pdf.replace({np.nan: None}), SCHEMA)
    late = np.random.default_rng(4).random(len(pdf)) < late_share
    new = df.filter(F.col("ingest_seq").isin([int(i) for i in pdf.ingest_seq[late]]))
    old = df.join(new.select("ingest_seq"), "ingest_seq", "left_anti")
    touched = buckets.touched_buckets(buckets.bucket_edges(df, spec, cfg.bucket_us), new, spec, cfg.bucket_us, cfg.reach_us)
    home = buckets.bucket_of(features.times.micros("timestamp"), cfg.bucket_us)
    before = features.engineer_features(old, cfg=cfg).withColumn(buckets.BUCKET, home)
    kept = before.join(touched, ["city", buckets.BUCKET], "left_anti").drop(buckets.BUCKET)
    mixed = kept.unionByName(features.refresh_features(df, new, cfg=cfg))
    assert_same(to_frame(mixed), pandas_features(pdf))


def test_one_hot_series_is_spread_over_buckets(spark):
    """A series of its own for a third of the rows must not end up in one group."""
    pdf = random_series(3, 300)
    df = spark.createDataFrame(pdf.replace({np.nan: None}), SCHEMA)
    cfg = FeatureConfig()
    groups = buckets.with_halo(df, SeriesSpec(), cfg.bucket_us, cfg.reach_us).groupBy("city", buckets.BUCKET).count()
    assert groups.filter("city = 'a'").count() > 5
    plan = features.engineer_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(city" in plan and "_bucket" in plan


def test_bucket_width_follows_density(spark):
    df = series(spark, [(m, 1.0) for m in range(600)])
    assert buckets.fit_bucket_hours(df, max_rows=600) == 10
    assert buckets.fit_bucket_hours(df.limit(0)) == 24 * 28


def test_cells_stay_small_where_a_series_is_a_thousand_times_denser(spark):
    """Hourly readings, and one day with a reading every 3.6 seconds: no group holds more than a few cells' worth."""
    spec, cfg, limit = SeriesSpec(), FeatureConfig(cell_rows=400), 400
    sparse = spark.range(24 * 40).select(F.col("id") * 3600 + F.pmod("id", F.lit(7)) * 60)
    burst = spark.range(24_000).select((F.col("id") * 3.6 + 86_400 * 20 + 1).cast("bigint"))
    at = sparse.union(burst).toDF("s").distinct()
    df = at.select(F.lit("hot").alias("city"), F.timestamp_seconds("s").cast("timestamp_ntz").alias("timestamp"),
                   (F.pmod(F.col("s") * 7919, F.lit(1000)) / 10).alias("aqi"), F.col("s").alias("ingest_seq"))
    us = features.times.micros("timestamp").alias(buckets.US)
    parts = cells.fit_parts(df.select("city", us), "city", cells.slot_us(cfg), limit)
    placed = df.select("city", us).withColumn(cells.SLOT, buckets.bucket_of(F.col(buckets.US), cells.slot_us(cfg))).join(
        parts, ["city", cells.SLOT], "left").withColumn(cells.CELL, cells.cell_at(F.col(buckets.US), cells.slot_us(cfg)))
    sizes = placed.groupBy("city", cells.CELL).count()
    assert sizes.agg(F.max("count")).first()[0] <= limit
    widest = buckets.with_halo(df, spec, cfg.bucket_us, cfg.reach_us).groupBy("city", buckets.BUCKET).count()
    assert widest.agg(F.max("count")).first()[0] > 50 * limit
    got = to_frame(features.add_series_features(df, spec, cfg, mode="cells"))
    want = to_frame(features.add_series_features(df, spec, cfg, mode="window"))
    assert_same(got, want)


def test_a_reading_is_sent_about_once_a_feature(spark):
    """In a dense stretch, copies follow the rows, not the cells a look-back spans."""
    cfg, slot = FeatureConfig(cell_rows=100), cells.slot_us(FeatureConfig())
    base = spark.range(20_000).select(F.lit("a").alias("city"), (F.col("id") * 10_000_000).alias(buckets.US), F.col("id").cast("double").alias("_v"),
                                      F.struct(F.lit(1)).alias("_row"))
    parts = cells.fit_parts(base.select("city", buckets.US), "city", slot, cfg.cell_rows)
    rows, held = cells._home(base, parts, "city", slot)
    day = 24 * 3_600_000_000
    at, tolerance = F.col(buckets.US) + day, cfg.tolerance_us(24)
    low = F.greatest(F.coalesce(F.col("_before") + day, at - tolerance), at - tolerance)
    high = F.least(F.coalesce(F.col("_after") + day, at + tolerance), at + tolerance)
    sent = cells._sent(rows.select("city", buckets.US, "_v", "_before", "_after"), low, high, at, parts, held, "city", slot)
    assert held.count() > 150 and sent.count() < 1.1 * rows.count() + 5 * held.count()


def test_a_task_is_given_a_bounded_number_of_readings(spark, monkeypatch):
    """Many small series: the planner alone merges all of their buckets into one task, as they are few bytes."""
    monkeypatch.setattr(features, "ROWS_PER_TASK", 200)
    rows = spark.range(2000).select(
        (F.col("id") % 100).cast("string").alias("city"), (F.lit(T0) + F.make_dt_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 17).cast("double").alias("aqi"), F.col("id").alias("ingest_seq"))
    split, plain = features.engineer_features(rows), features.engineer_features(rows, mode="window")
    held = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 2000 and max(held) <= 600
    order = lambda df: [tuple(r) for r in df.orderBy("ingest_seq").collect()]
    for g, w in zip(order(split), order(plain.select(split.columns)), strict=True):
        assert g == pytest.approx(w, nan_ok=True) if None not in g else [v is None for v in g] == [v is None for v in w]
