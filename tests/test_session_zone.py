"""Every time computation gives the same in a zone with clock changes as in UTC."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seriesforge.functions import times
from seriesforge.operators import features, insights, selection
from seriesforge.streaming import streams

ZONES = ["UTC", "America/New_York", "Asia/Kathmandu"]
CHANGES = (datetime(2024, 3, 9, 20), datetime(2024, 11, 2, 20))


@pytest.fixture
def in_zones(spark):
    before = spark.conf.get("spark.sql.session.timeZone")

    def run(make):
        out = []
        for zone in ZONES:
            spark.conf.set("spark.sql.session.timeZone", zone)
            out.append(sorted(tuple(r) for r in make().collect()))
        return out

    yield run
    spark.conf.set("spark.sql.session.timeZone", before)


def readings(spark):
    rows = [("a", start + timedelta(minutes=30 * i), float(i * i % 17), 100 * n + i) for n, start in enumerate(CHANGES) for i in range(40)]
    text = [(c, str(t), v, i) for c, t, v, i in rows]
    frame = spark.createDataFrame(text, "city string, t string, aqi double, ingest_seq bigint")
    return frame.select("city", F.col("t").cast("timestamp_ntz").alias("timestamp"), "aqi", "ingest_seq")


def as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def test_features(spark, in_zones):
    utc, *others = in_zones(lambda: as_text(features.engineer_features(readings(spark)).orderBy("ingest_seq")))
    assert all(o == utc for o in others)
    lag = features.add_lag_features(readings(spark)).orderBy("ingest_seq").collect()
    assert [r.lag_1h_aqi for r in lag[2:40]] == [r.aqi for r in lag[:38]]


def test_split_hours_days_and_means(spark, in_zones):
    for make in (
        lambda: as_text(selection.chronological_cut(readings(spark), [], times.micros("timestamp"), ["ingest_seq"], 0.3)),
        lambda: as_text(readings(spark).select(times.hour_floor(F.col("timestamp")).alias("h"), times.day_floor(F.col("timestamp")).alias("d"))),
        lambda: as_text(streams.hourly_means(readings(spark))),
        lambda: as_text(insights.daily_trend(readings(spark))),
    ):
        utc, *others = in_zones(make)
        assert utc and all(o == utc for o in others)


def test_parsing(spark, in_zones):
    want = {
        "2024-03-10T02:30:00.123456": datetime(2024, 3, 10, 2, 30, 0, 123456), "2024-11-03T06:30:00+00:00": datetime(2024, 11, 3, 6, 30),
        "2024-11-03T06:30:00": datetime(2024, 11, 3, 6, 30), "2024-11-03 01:30:00Z": datetime(2024, 11, 3, 1, 30),
        "2024-03-10T07:30:00+05:00": datetime(2024, 3, 10, 2, 30), "2024-01-05": datetime(2024, 1, 5), "soon": None,
    }
    frame = spark.createDataFrame([(t,) for t in want], "t string")
    for found in in_zones(lambda: frame.select("t", times.parse_utc(F.col("t")).alias("p"))):
        assert dict(found) == want


def test_micros_round_trip(spark, in_zones):
    values = [-500_000, 0, 1_710_037_800_123_456, 1_730_597_400_000_000]
    frame = spark.createDataFrame([(v,) for v in values], "us bigint")
    for found in in_zones(lambda: frame.select("us", times.micros_of(times.from_micros(F.col("us"))).alias("back"))):
        assert all(a == b for a, b in found)
