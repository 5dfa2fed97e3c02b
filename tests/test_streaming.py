import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge import schema as S
from seriesforge.operators.features import engineer_features
from seriesforge.operators.quality import keep_last
from seriesforge.plans import pipelines
from seriesforge.sources import landing
from seriesforge.sources.tables import KeyedTable
from seriesforge.streaming import streams

T0 = datetime(2024, 1, 1)


def drop_files(folder, docs, per_file):
    folder.mkdir(exist_ok=True)
    for i in range(0, len(docs), per_file):
        (folder / f"{i:05d}.json").write_text("\n".join(json.dumps(d) for d in docs[i:i + per_file]))


def documents(n, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        at = T0 + timedelta(minutes=int(rng.integers(0, 60 * 24 * 20)))       # out of order, some repeats
        out.append({"city": str(rng.choice(["a", "b"])), "poll_id": i, "ingested_at": "2024-02-01T00:00:00", "status": "ok",
                    "data": {"aqi": str(round(float(rng.gamma(2, 30)), 1)), "time": {"iso": at.isoformat() + "Z"}}})
    return out


def test_ingest_and_refresh_equal_batch(spark, tmp_path):
    drop_files(tmp_path / "in", documents(300), 60)
    raw = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS).create()
    feature_schema = engineer_features(spark.createDataFrame([], S.RAW_READINGS)).schema
    feats = KeyedTable(spark, str(tmp_path / "features"), feature_schema).create()
    stream = streams.current_readings(streams.read_landing_stream(spark, str(tmp_path / "in"), S.CURRENT_PAYLOAD, 2))
    streams.refresh_into(stream, raw, feats, str(tmp_path / "progress")).awaitTermination()

    all_rows = streams.current_readings(landing.read_landing(spark, str(tmp_path / "in"), S.CURRENT_PAYLOAD))
    batch = keep_last(all_rows)
    assert sorted(map(str, raw.scan().collect())) == sorted(map(str, batch.collect()))
    want = engineer_features(batch, unique=True)
    names = ["city", "timestamp", "lag_1h_aqi", "lag_24h_aqi", "rolling_24h_mean_aqi", "aqi_change_rate"]
    view = lambda df: sorted(map(str, df.select(*names[:2], *[F.round(c, 6) for c in names[2:]]).collect()))
    assert view(feats.scan()) == view(want)
    # Nothing new has arrived: running again changes nothing.
    streams.refresh_into(stream, raw, feats, str(tmp_path / "progress")).awaitTermination()
    assert raw.scan().count() == batch.count()


def test_replayed_batch_merges_to_the_same_table(spark, tmp_path):
    drop_files(tmp_path / "in", documents(50), 50)
    raw = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS).create()
    stream = streams.current_readings(streams.read_landing_stream(spark, str(tmp_path / "in"), S.CURRENT_PAYLOAD))
    for attempt in ("one", "two"):
        streams.ingest_into(stream, raw, str(tmp_path / attempt)).awaitTermination()
    assert raw.scan().count() == raw.scan().select("city", "timestamp").distinct().count()


def test_hourly_means_equal_batch_for_on_time_data(spark, tmp_path):
    rows = [("a", T0 + timedelta(minutes=7 * i), float(i % 40), i) for i in range(400)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = streams.read_parquet_stream(spark, str(tmp_path / "in"), df.schema, "*.parquet")
    means = streams.hourly_means(stream)
    streams.write_available(means, str(tmp_path / "out"), str(tmp_path / "progress"))
    got = {(r.city, r.hour): (r.aqi, r.n) for r in spark.read.schema(means.schema).parquet(str(tmp_path / "out")).collect()}
    batch = {(r.city, r.hour): (r.aqi, r.n) for r in streams.hourly_means(df).collect()}
    closed = max(t for _, t, _, _ in rows) - timedelta(hours=3)
    assert got == {k: v for k, v in batch.items() if k[1] + timedelta(hours=1) <= closed} and len(got) > 30


def test_readings_days_late_correct_their_hour_and_replays_add_nothing(spark, tmp_path):
    schema = "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint"
    rows = [("ab"[i % 2], T0 + timedelta(minutes=17 * i), float(i % 40) if i % 9 else None, i) for i in range(500)]
    hours = KeyedTable(spark, str(tmp_path / "hours"), streams.HOURS, streams.HOURS_SPEC).create()
    # The second file holds the oldest readings.
    for part in (rows[200:], rows[:200]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.read_parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "*.parquet")
        streams.hourly_means_into(stream, hours, str(tmp_path / "progress")).awaitTermination()
    whole = spark.createDataFrame(rows, schema)
    read = lambda df: {(r.city, r.hour): (r.aqi and round(r.aqi, 9), r.n) for r in df.collect()}
    want = read(streams.hourly_means(whole))
    assert read(streams.stored_means(hours)) == want and len(want) > 100
    for number, part in ((0, rows[200:]), (1, rows[:200])):
        streams.add_hourly(spark.createDataFrame(part, schema), number, hours)
    assert read(streams.stored_means(hours)) == want


def test_backfill_pipeline(spark, tmp_path):
    docs = [{"city": "Lahore", "poll_id": i, "list": [
        {"dt": 1704067200 + 3600 * (2 * i + j), "components": {"pm2_5": v, "pm10": 1.0}} for j, v in enumerate(pair)]}
        for i, pair in enumerate([(10.0, 12.05), (20.0, 40.0), (600.0, -1.0)])]
    drop_files(tmp_path / "in", docs, 2)
    history = landing.read_landing(spark, str(tmp_path / "in"), S.HISTORY_PAYLOAD)
    rows = {r.timestamp.hour: r for r in pipelines.backfill_readings(history).collect()}
    assert {h: r.aqi for h, r in rows.items()} == {0: 41.7, 2: 67.6, 3: 112.1, 4: 500.0}   # a gap value and a negative drop out
    assert rows[0].matched_station == "Lahore (OpenWeather historical)" and rows[0].is_stale is False
    in_range = landing.explode_history(history, F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"),
                                       F.lit("2024-01-01 04:00:00").cast("timestamp_ntz"))
    assert sorted(r.timestamp.hour for r in in_range.collect()) == [1, 2, 3, 4]
    assert landing.explode_history(history.limit(0)).count() == 0


@pytest.mark.parametrize("city,rows", [(None, 24), ("a", 24), ("nobody", 0)])
def test_pattern_spine(spark, city, rows):
    from seriesforge.operators import insights
    df = spark.createDataFrame([("a", T0, 4.0, 1)], "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint")
    got = insights.hourly_pattern(df, city).collect()
    assert len(got) == rows and [r.aqi for r in got if r.aqi is not None] == ([4.0] if rows else [])
