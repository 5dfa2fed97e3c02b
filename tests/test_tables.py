from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seriesforge import schema as S
from seriesforge.config import FeatureConfig
from seriesforge.operators import buckets, matrix, models
from seriesforge.plans import pipelines
from seriesforge.sources import landing, registry as RG
from seriesforge.sources.edges import EdgeTable
from seriesforge.sources.tables import KeyedTable

T0 = datetime(2024, 1, 1)


def reading(spark, rows):
    data = [(c, T0 + timedelta(hours=h), v, i) for c, h, v, i in rows]
    df = spark.createDataFrame(data, "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint")
    return pipelines.to_raw_schema(df)


def content(table):
    return sorted((r.city, r.timestamp, r.aqi) for r in table.scan().collect())


def test_upsert_is_idempotent_and_latest_wins(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS)
    assert not table.exists() and table.scan().count() == 0
    table.create().create()
    first = reading(spark, [("a", 0, 1.0, 1), ("a", 30, 2.0, 2), ("b", 0, 3.0, 3)])
    table.upsert(first)
    table.upsert(first)
    assert len(content(table)) == 3
    table.upsert(reading(spark, [("a", 0, 9.0, 7), ("a", 0, 8.0, 6), ("b", 0, 5.0, 0)]))
    assert content(table) == [("a", T0, 9.0), ("a", T0 + timedelta(hours=30), 2.0), ("b", T0, 3.0)]
    table.upsert(first.limit(0))
    assert len(content(table)) == 3
    assert table.scan_days(first="2024-01-02").count() == 1
    assert all("date=2024-01-02" in f for f in table.scan_days(first="2024-01-02").inputFiles())


def test_an_interrupted_upsert_changes_nothing_and_its_rerun_completes_it(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS)
    table.upsert(reading(spark, [("a", h, float(h), 1) for h in range(0, 72, 6)]))
    before = content(table)
    batch = reading(spark, [("a", 0, 100.0, 2), ("b", 30, 5.0, 3), ("c", 90, 6.0, 4)])
    publish = KeyedTable._publish

    def fail(*_):
        raise OSError("lost between write and publication")

    monkeypatch.setattr(KeyedTable, "_publish", fail)
    with pytest.raises(OSError):
        table.upsert(batch)
    assert content(table) == before
    monkeypatch.setattr(KeyedTable, "_publish", publish)
    table.upsert(batch)
    assert len(content(table)) == len(before) + 2 and ("a", T0, 100.0) in content(table)


def test_a_second_writer_of_one_version_is_refused(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS).create()
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(1, {})


def test_old_day_folders_are_retired(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS)
    for n in range(5):
        table.upsert(reading(spark, [("a", 0, float(n), n)]))
    assert len(list((tmp_path / "raw" / "manifests").glob("[0-9]*.json"))) == 2
    assert len(list((tmp_path / "raw" / "data").glob("*/date=*"))) == 2
    assert content(table) == [("a", T0, 4.0)]


def test_recomputed_row_replaces_the_stored_one(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS)
    for value in (1.0, 5.0, 3.0):
        table.upsert(reading(spark, [("a", 0, value, 7)]))
        assert content(table) == [("a", T0, value)]


def test_feature_refresh_job(spark, tmp_path):
    raw = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS)
    from seriesforge.operators.features import engineer_features
    feature_schema = engineer_features(spark.createDataFrame([], S.RAW_READINGS)).schema
    feats = KeyedTable(spark, str(tmp_path / "features"), feature_schema).create()
    assert not pipelines.run_feature_refresh(reading(spark, []), raw, feats)
    assert pipelines.run_feature_refresh(reading(spark, [("a", 0, 1.0, 1), ("a", 1, 2.0, 2)]), raw, feats)
    pipelines.run_feature_refresh(reading(spark, [("a", 2, 4.0, 3)]), raw, feats)
    rows = {r.timestamp.hour: r for r in feats.scan().collect()}
    assert rows[2].lag_1h_aqi == 2.0 and rows[2].aqi_change_rate == 1.0 and len(rows) == 3
    # A late correction, stored incrementally, also reaches the next reading weeks later.
    far = 24 * 40 + 5
    pipelines.run_feature_refresh(reading(spark, [("a", far, 6.0, 4)]), raw, feats, full=False)
    pipelines.run_feature_refresh(reading(spark, [("a", 2, 12.0, 5)]), raw, feats, full=False)
    last = {r.timestamp: r for r in feats.scan().collect()}[T0 + timedelta(hours=far)]
    assert last.aqi_change_rate == -0.5
    full = engineer_features(raw.scan(), unique=True).select(*feature_schema.names)
    assert sorted(map(str, feats.scan().collect())) == sorted(map(str, full.collect()))


def test_edges_are_kept_by_upserts_and_read_around_the_batch(spark, tmp_path, monkeypatch):
    cfg = FeatureConfig(bucket_hours=24)
    raw = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS).create()
    # Months of readings every twelve hours, one series silent for long, one that begins late.
    hours = [("a", h) for h in range(0, 24 * 150, 12)] + [("quiet", h) for h in (0, 5, 24 * 100)] + [("late", 24 * 120)]
    raw.upsert(reading(spark, [(c, h, float(h % 50), i) for i, (c, h) in enumerate(hours)]))
    edges = EdgeTable(raw, cfg.bucket_us).create()
    more = reading(spark, [("a", 24 * 80 + 3, 7.0, 9000), ("quiet", 24 * 100 + 2, 8.0, 9001), ("a", 24 * 80, 1.0, 9002)])
    raw.upsert(more)
    spec = raw.spec

    def expected(keys):
        found = buckets.bucket_edges(raw.scan(), spec, cfg.bucket_us).filter(F.col("city").isin(keys))
        return {(r.city, r._bucket): (r._prev and tuple(r._prev), r._prev_bucket) for r in found.collect()}

    seen = []
    plain = KeyedTable.scan_days
    monkeypatch.setattr(KeyedTable, "scan_days", lambda self, first=None, last=None: seen.append((first, last)) or plain(self, first, last))

    def around(rows):
        seen.clear()
        hits = buckets.reached_buckets(rows, spec, cfg.bucket_us, cfg.reach_us)
        found = {(r.city, r._bucket): (r._prev and tuple(r._prev), r._prev_bucket) for r in edges.around(hits).collect()}
        want = expected([k for k, in {(r.city,) for r in rows.collect()}])
        for r in buckets.touched_buckets(buckets.bucket_edges(raw.scan(), spec, cfg.bucket_us), rows, spec, cfg.bucket_us, cfg.reach_us).collect():
            key = (r.city, r._bucket)
            assert found.get(key) == want.get(key), key
        return list(seen)

    assert len(around(more.filter("city = 'a'"))) == 1      # neighbours lie next to the batch
    first, last = seen[0]
    assert (datetime.fromisoformat(last) - datetime.fromisoformat(first)).days <= 8
    assert len(around(more.filter("city = 'quiet'"))) > 1   # after a silence it looks further
    around(reading(spark, [("late", 24 * 120, 1.0, 1)]))
    around(reading(spark, [("a", 24 * 149 + 12, 1.0, 1)]))
    # Replays change nothing.
    before = sorted(map(str, edges.stored.scan().collect()))
    raw.upsert(more)
    assert sorted(map(str, edges.stored.scan().collect())) == before


def test_a_replayed_batch_is_no_change(spark, tmp_path):
    raw = KeyedTable(spark, str(tmp_path / "raw"), S.RAW_READINGS).create()
    rows = reading(spark, [("a", 0, 1.0, 5), ("a", 1, None, 6), ("b", 0, 3.0, 7)])
    raw.upsert(rows)
    assert raw.changes(rows).isEmpty()
    mixed = reading(spark, [("a", 0, 9.0, 4), ("a", 1, 2.0, 6), ("b", 0, 3.0, 8), ("c", 0, 3.0, 9)])
    assert sorted((r.city, r.ingest_seq) for r in raw.changes(mixed).collect()) == [("a", 6), ("b", 8), ("c", 9)]


def test_landing_files(spark, tmp_path):
    folder = tmp_path / "current"
    folder.mkdir()
    lines = [
        '{"city":"Quetta","poll_id":1,"ingested_at":"2024-01-01T10:00:00","status":"ok","data":{"aqi":"-","dominentpol":"pm25",'
        '"city":{"name":"Irrigation Directorate"},"time":{"iso":"2024-01-01T14:00:00+05:00"},"iaqi":{"pm25":{"v":77.5},"t":{"v":3}}}}',
        '{"city":"Lahore","poll_id":2,"ingested_at":"2024-01-01T10:00:00","status":"ok","data":{"aqi":120,"iaqi":{}}}',
        '{"city":"Karachi","poll_id":3,"ingested_at":"2024-01-01T10:00:00","status":"error"}',
        '{"city":"Nowhere","poll_id":4,"ingested_at":"2024-01-01T10:00:00","status":"ok","data":{"aqi":5}}',
    ]
    (folder / "a.json").write_text("\n".join(lines))
    weather_dir = tmp_path / "weather"
    weather_dir.mkdir()
    (weather_dir / "w.json").write_text('{"city":"Quetta","poll_id":1,"main":{"humidity":40.5},"wind":{"speed":2.5,"deg":10}}')
    current = landing.read_landing(spark, str(folder), S.CURRENT_PAYLOAD)
    weather = landing.read_landing(spark, str(weather_dir), S.WEATHER_PAYLOAD)
    as_of = F.lit(1704103200000000)  # 2024-01-01 10:00 UTC
    rows = {r.city: r for r in landing.snapshot(current, weather, as_of, S.city_dim(spark)).collect()}
    assert set(rows) == {"Quetta", "Lahore"}
    q, l = rows["Quetta"], rows["Lahore"]
    assert (q.aqi, q.temp, q.humidity, q.wind_speed, q.pressure) == (77.5, 3.0, 40.5, 2.5, None)
    assert q.timestamp == datetime(2024, 1, 1, 9) and q.station_ok and not q.is_stale
    assert l.aqi == 120.0 and l.timestamp == datetime(2024, 1, 1, 10) and not l.station_ok
    accepted, rejected = landing.split_by_status(current)
    assert [r.city for r in rejected.collect()] == ["Karachi"] and accepted.count() == 3


def test_landing_days_outside_the_range_are_not_listed_and_broken_lines_are_kept(spark, tmp_path):
    for day in range(1, 6):
        folder = tmp_path / "in" / f"date=2024-01-0{day}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text('{"city":"Lahore","poll_id":%d,"ingested_at":"2024-01-0%dT01:00:00","list":[]}\nno json %d\n{"city":"x","poll_id":1,"ingested_at":"2024-01-01T00:00:00","list":[' % (day, day, day))
    landed = landing.read_landing_days(spark, str(tmp_path / "in"), S.HISTORY_PAYLOAD, "2024-01-02", "2024-01-03", earlier=1)
    assert sorted(f.split("date=")[1][:10] for f in landed.inputFiles()) == ["2024-01-02", "2024-01-03", "2024-01-04"]
    good, broken = landing.split_broken(landed)
    assert sorted(r.poll_id for r in good.collect()) == [2, 3, 4] and "_broken" not in good.columns
    assert sorted(r.line for r in broken.collect()) == ["no json 2", "no json 3", "no json 4", *['{"city":"x","poll_id":1,"ingested_at":"2024-01-01T00:00:00","list":['] * 3]
    nothing = landing.read_landing_days(spark, str(tmp_path / "in"), S.HISTORY_PAYLOAD, "2025-01-01")
    assert nothing.count() == 0 and landing.read_landing_days(spark, str(tmp_path / "none"), S.HISTORY_PAYLOAD).count() == 0


def test_registry_versions_choice_and_leak_guard(spark, tmp_path):
    rows = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], f"x double, {matrix.TARGET} double")
    model = models.fit_ridge(matrix.assemble(rows, ("x",)))
    reg = RG.ModelRegistry(spark, str(tmp_path))
    with pytest.raises(LookupError):
        reg.pick()
    fs = matrix.FeatureSet(("x",), {"x": 9.5})
    assert reg.register("aqi_a", "ridge", model, fs, {"rmse": 1.0}) == 1
    assert reg.register("aqi_a", "ridge", model, fs, {"rmse": 5.0}) == 2
    assert reg.register("aqi_b", "ridge", model, fs, {"rmse": 3.0}) == 1
    assert reg.register("aqi_c", "ridge", model, fs, {}) == 1
    assert reg.register("aqi_sequence", "sequence", model, fs, {"rmse": 0.1}) == 1
    best = reg.pick()
    assert (best["name"], best["version"], best["medians"]) == ("aqi_b", 1, {"x": 9.5})
    assert reg.pick("aqi_a")["version"] == 2
    assert reg.load(best).coefficients[0] == pytest.approx(model.coefficients[0])
    reg.register("aqi_leaky", "ridge", model, matrix.FeatureSet(("x", "pm25")), {"rmse": 0.0})
    with pytest.raises(ValueError, match="pm25"):
        reg.pick()
    with pytest.raises(ValueError, match="unknown model choice"):
        pipelines.forecast_all(rows, reg, "Oracle")


def test_writers_at_the_same_time_get_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    rows = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], f"x double, {matrix.TARGET} double")
    model = models.fit_ridge(matrix.assemble(rows, ("x",)))

    def write(k):
        registry = RG.ModelRegistry(spark, str(tmp_path))
        return registry.register("aqi_a", "ridge", model, matrix.FeatureSet(("x",), {"x": float(k)}), {"rmse": float(k)})

    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(write, range(6)))
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    stored = {r.version: r for r in RG.ModelRegistry(spark, str(tmp_path)).rows().collect()}
    assert sorted(stored) == sorted(got) and len({r.path for r in stored.values()}) == 6
    for k, version in enumerate(got):
        assert (stored[version].rmse, stored[version].medians) == (float(k), {"x": float(k)})
        assert RG.ModelRegistry(spark, str(tmp_path)).load(stored[version]).coefficients[0] == pytest.approx(model.coefficients[0])
