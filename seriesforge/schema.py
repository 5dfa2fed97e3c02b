"""Fixed schemas of the landing payloads and the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from seriesforge import config as C


def _doubles(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _measure(names: list[str]) -> T.StructType:
    # Landing numbers are read as text so that a bad one becomes null, not a failed record.
    return T.StructType([T.StructField(n, T.StructType([T.StructField("v", T.StringType())])) for n in names])


CURRENT_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("aqi", T.StringType()),
        T.StructField("dominentpol", T.StringType()),
        T.StructField("city", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("time", T.StructType([T.StructField("iso", T.StringType())])),
        T.StructField("iaqi", _measure(["pm25", "pm10", "no2", "o3", "so2", "co", "t", "h", "p", "w"])),
    ])),
])

WEATHER_PAYLOAD = T.StructType([
    T.StructField("main", T.StructType(_doubles(["temp", "humidity", "pressure"]))),
    T.StructField("wind", T.StructType(_doubles(["speed", "deg"]))),
])

HISTORY_PAYLOAD = T.StructType([
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("dt", T.LongType()),
        T.StructField("components", T.StructType(_doubles(["pm2_5", "pm10", "no2", "o3", "so2", "co"]))),
    ]))),
])


def landed(payload: T.StructType) -> T.StructType:
    """A landing line: who was polled, in which poll, when it arrived, plus the payload."""
    return T.StructType([
        T.StructField("city", T.StringType()),
        T.StructField("poll_id", T.LongType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        *payload.fields,
    ])


RAW_READINGS = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("matched_station", T.StringType()),
    T.StructField("dominant_pollutant", T.StringType()),
    *_doubles(["aqi", *C.POLLUTANTS, *C.INLINE_WEATHER, *C.WEATHER]),
    T.StructField("is_stale", T.BooleanType()),
    T.StructField("ingest_seq", T.LongType()),
])

NUMERIC_READINGS = ["aqi", *C.POLLUTANTS, *C.WEATHER, *C.INLINE_WEATHER]

REGISTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("medians", T.MapType(T.StringType(), T.DoubleType())),
    # Of sequence models: the window's length and where the scalers they were trained with are stored.
    T.StructField("sequence_length", T.IntegerType()),
    T.StructField("scalers_path", T.StringType()),
])


def city_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.CITIES, "city string, station string, lat double, lon double")


def breakpoint_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, lo, hi, float(a), float(b)) for i, (lo, hi, a, b) in enumerate(C.PM25_BREAKPOINTS)]
    return spark.createDataFrame(
        rows, "segment int, conc_low double, conc_high double, index_low double, index_high double")


def category_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(float(c[0]), *c[1:]) for c in C.DISPLAY_CATEGORIES],
        "upper_limit double, category_key string, category_label string, category_phrase string, "
        "color string, guidance string")


def label_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(C.FEATURE_LABELS.items()), "feature string, label string")
