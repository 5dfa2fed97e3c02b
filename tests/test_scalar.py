import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seriesforge.functions import scalar, times
from seriesforge.operators import quality


def col_values(spark, values, fn, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_index_segments_gaps_and_bounds(spark):
    got = col_values(spark, [0.0, 12.0, 12.05, 12.1, 35.4, 35.45, 500.4, 500.41, 900.0, -0.1, None], scalar.pm25_index)
    assert got == [0.0, 50.0, None, 51.0, 100.0, None, 500.0, 500.0, 500.0, None, None]


def test_index_of_unreadable_text(spark):
    assert col_values(spark, ["x", "", "12", "nan", None], scalar.pm25_index, "string") == [None, None, 50.0, None, None]


def test_tenths_round_like_exact_half_even(spark):
    random.seed(3)
    values = [0.25, 0.35, 0.05, 0.15, 0.45, 2.675, 12.25, 499.95, -0.25, -0.35]
    values += [random.randint(0, 100_000) / 100 for _ in range(3000)] + [random.uniform(0, 500) for _ in range(3000)]
    assert col_values(spark, values, scalar.half_even_tenths) == [round(v, 1) for v in values]


def test_categories_at_limits(spark):
    values = [50.0, 50.01, 100.0, 150.0, 200.0, 300.0, 300.1, float("nan"), None]
    assert col_values(spark, values, scalar.forecast_category) == [
        "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy",
        "Hazardous", "Unknown", "Unknown"]
    assert col_values(spark, [float("nan"), 2e6, 150.0], scalar.category_key) == ["hazardous", "hazardous", "sensitive"]


def test_resolve_prefers_published_index(spark):
    df = spark.createDataFrame([("55", "1"), ("-", "2.5"), ("", "3"), (None, "4"), ("n/a", "5"), ("-", "bad"), ("-", None)],
                               "a string, p string")
    got = [r[0] for r in df.select(scalar.resolve_index(F.col("a"), F.col("p"))).collect()]
    assert got == [55.0, 2.5, 3.0, 4.0, 5.0, None, None]


def test_stale_is_strict_and_null_is_stale(spark):
    hour = 3_600_000_000
    got = col_values(spark, [7 * hour, 7 * hour - 1, None, 12 * hour], lambda c: scalar.is_stale(c, F.lit(10 * hour)),
                     "bigint")
    assert got == [False, True, True, False]


def test_station_aliases(spark):
    rows = [("Quetta", "Irrigation Directorate, QTA"), ("Lahore", "Irrigation Directorate"), ("Lahore", "US LAHORE"),
            ("Faisalabad", "FDA-01"), ("Karachi", None)]
    df = spark.createDataFrame(rows, "city string, matched_station string")
    assert [r.station_ok for r in quality.flag_station(df).collect()] == [True, False, True, True, False]


def test_parse_utc_is_independent_of_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-06-01T05:00:00+05:00",), ("junk",), ("2024-06-01T05:00:00Z",)], "v string")
        out = df.select(times.parse_utc(F.col("v")).alias("t")).select("t", times.micros("t").alias("us")).collect()
        assert [r.t for r in out] == [datetime(2024, 6, 1), None, datetime(2024, 6, 1, 5)]
        assert out[0].us == 1717200000000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_micros_round_trip(spark):
    values = [0, 1, 1717200000000001, -1]
    back = col_values(spark, values, lambda c: times.from_micros(c).cast("string"), "bigint")
    assert back[2].endswith(".000001") and back[0] == "1970-01-01 00:00:00"


def test_driver_phrase(spark):
    assert col_values(spark, [2.5, -3.5, 0.0], scalar.driver_phrase) == ["Adds about 2", "Cuts about 4", "Cuts about 0"]


def test_keep_last_uses_input_order(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 1.0, 2), ("a", t, None, 5), ("a", t, 3.0, 4), ("a", None, 9.0, 9)],
                               "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint")
    rows = quality.keep_last(df).collect()
    assert len(rows) == 1 and rows[0].ingest_seq == 5 and rows[0].aqi is None
    counts = quality.dedupe_counts(df).first()
    assert (counts.rows_in, counts.rows_kept, counts.rows_dropped) == (3, 1, 2)


def test_observe_counts_rows(spark):
    df, seen = quality.observe_rows(spark.range(7), "seven")
    df.collect()
    assert seen.get["rows"] == 7


@pytest.mark.parametrize("value,expected", [("1e2", 100.0), ("abc", None), (" 7 ", 7.0)])
def test_to_double(spark, value, expected):
    got = col_values(spark, [value], scalar.to_double, "string")[0]
    assert got == expected or (got is None and expected is None) or math.isclose(got, expected)
