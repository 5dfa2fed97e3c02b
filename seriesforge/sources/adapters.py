"""Maps the test tables onto the reading tables the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesforge.functions import times
from seriesforge.schema import RAW_READINGS


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def readings(events: DataFrame, key: str = "event_type", hourly: bool = False) -> DataFrame:
    """events -> (city, timestamp, aqi, pm25, k, ingest_seq); hourly truncation makes repeats."""
    ts = times.hour_floor(F.col("ts")) if hourly else F.col("ts")
    return events.select(
        F.col(key).cast("string").alias("city"),
        ts.alias("timestamp"),
        F.col("value").alias("aqi"),
        F.col("value").alias("pm25"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_id").alias("ingest_seq"),
    )


def raw_readings(events: DataFrame, hourly: bool = False) -> DataFrame:
    """Full raw schema: some weather missing, some readings stale, a mix of stations."""
    base = readings(events, hourly=hourly)
    null = F.lit(None).cast("double")
    columns = {
        "matched_station": F.concat(F.initcap("city"), F.lit(" station")),
        "dominant_pollutant": F.lit("pm25"),
        "pm10": F.col("pm25") * 2,
        "no2": null, "o3": null, "so2": null, "co": null,
        "aqicn_temp": F.col("k").cast("double"), "aqicn_humidity": null,
        "aqicn_pressure": null, "aqicn_wind": null,
        "temp": F.when(F.col("k") % 3 == 0, F.col("k") / 2.0),
        "humidity": F.when(F.col("k") % 4 == 0, F.col("k").cast("double")),
        "pressure": F.when(F.col("k") % 3 != 0, 1000.0 + F.col("k")),
        "wind_speed": F.lit(3.5),
        "is_stale": F.col("k") < 10,
    }
    return base.withColumns(columns).select(*RAW_READINGS.fieldNames())


def current_payloads(events: DataFrame) -> DataFrame:
    """One nested current-reading document (JSON text) per event, some rejected or incomplete."""
    k = F.get_json_object("props", "$.k").cast("int")
    v = lambda c: F.struct(c.alias("v"))
    iaqi = F.struct(
        v(F.col("value").cast("string")).alias("pm25"), v((F.col("value") * 2).cast("string")).alias("pm10"),
        v(F.when(k % 2 == 0, (k / 2).cast("string"))).alias("t"), v(k.cast("string")).alias("h"))
    data = F.struct(
        F.when(k % 10 == 0, "-").otherwise(F.col("value").cast("string")).alias("aqi"),
        F.lit("pm25").alias("dominentpol"),
        F.struct(F.concat(F.col("event_type"), F.lit(" station")).alias("name")).alias("city"),
        F.struct(F.when(k % 25 != 7, times.iso_utc(F.col("ts"))).alias("iso")).alias("time"),
        iaqi.alias("iaqi"))
    return events.select(
        F.col("event_type").alias("city"), F.col("event_id").alias("poll_id"),
        F.col("ts").alias("ingested_at"),
        F.to_json(F.struct(F.when(k % 17 == 3, "error").otherwise("ok").alias("status"),
                           data.alias("data"))).alias("body"))


def weather_payloads(events: DataFrame) -> DataFrame:
    """A weather document for two polls in three; its fields are partly missing."""
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.struct(
        F.struct(F.when(k % 4 == 0, k.cast("double")).alias("temp"),
                 F.when(k % 5 != 0, (k * 1.5)).alias("humidity"),
                 F.lit(1013.0).alias("pressure")).alias("main"),
        F.struct((k / 10.0).alias("speed"), (k * 3.0).alias("deg")).alias("wind"))
    return events.filter(F.col("event_id") % 3 != 0).select(
        F.col("event_type").alias("city"), F.col("event_id").alias("poll_id"),
        F.col("ts").alias("ingested_at"), F.to_json(body).alias("body"))


def history_payloads(events: DataFrame) -> DataFrame:
    """One history document per event: a list with its reading and the one an hour earlier."""
    second = F.floor(times.micros("ts") / 1_000_000).cast("bigint")

    def item(dt, pm25):
        return F.struct(dt.alias("dt"), F.struct(
            pm25.alias("pm2_5"), (pm25 * 2).alias("pm10"), F.lit(None).cast("double").alias("no2"),
        ).alias("components"))

    entries = F.array(item(second, F.col("value")), item(second - 3600, F.col("value") / 2))
    return events.select(
        F.col("event_type").alias("city"), F.col("event_id").alias("poll_id"),
        F.col("ts").alias("ingested_at"),
        F.to_json(F.struct(entries.alias("list"))).alias("body"))
