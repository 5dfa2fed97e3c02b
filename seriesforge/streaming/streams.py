"""Incremental ingest, feature refresh, alerts and hourly means on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from seriesforge import schema as S
from seriesforge.config import FeatureConfig, SeriesSpec
from seriesforge.functions import scalar, times
from seriesforge.plans.pipelines import refresh_stored_features
from seriesforge.session import materialize
from seriesforge.sources.landing import flatten_current
from seriesforge.sources.tables import KeyedTable

_SPEC = SeriesSpec()


def read_landing_stream(spark: SparkSession, path: str, payload: StructType, files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.schema(S.landed(payload)).option("maxFilesPerTrigger", files_per_trigger).json(path))


def read_parquet_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str) -> DataFrame:
    reader: DataStreamReader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def ingest_into(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch by (key, time).

    There is no watermark on purpose: late readings are kept. A batch that is replayed after a
    failure merges to the same table.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        table.upsert(batch)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_readings(stream: DataFrame) -> DataFrame:
    """Landing documents of the current-reading source as raw-table rows; poll order is input order."""
    flat = flatten_current(stream).withColumn("ingest_seq", F.col("poll_id"))
    missing = [f for f in S.RAW_READINGS.fields if f.name not in flat.columns]
    return (flat.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
            .select(*S.RAW_READINGS.fieldNames()))


def refresh_into(stream: DataFrame, raw: KeyedTable, features: KeyedTable, checkpoint: str,
                 cfg: FeatureConfig = FeatureConfig()) -> StreamingQuery:
    """Upsert new readings, then recompute only the time buckets they can affect."""
    def merge(batch: DataFrame, _batch_id: int) -> None:
        raw.upsert(batch)
        refresh_stored_features(batch, raw, features, cfg)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def alerts(stream: DataFrame, as_of_us: Column, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Readings that are hazardous or stale, with the reason. Stateless."""
    hazardous = F.coalesce(scalar.is_hazardous(F.col(spec.value)), F.lit(False))
    stale = scalar.is_stale(times.micros(spec.ts), as_of_us)
    return (stream.withColumn("hazardous", hazardous).withColumn("stale", stale)
            .filter(F.col("hazardous") | F.col("stale")))


def hourly_means(stream: DataFrame, late: str = "3 hours", spec: SeriesSpec = _SPEC) -> DataFrame:
    """Mean per key and hour. The watermark bounds the state; hours close once it has passed."""
    # The instant that shows this time in UTC: windows then are UTC hours whatever the session zone.
    timed = stream.withColumn("_event", F.timestamp_micros(times.micros(spec.ts)))
    if stream.isStreaming:
        timed = timed.withWatermark("_event", late)
    hour = F.window("_event", "1 hour")
    return (timed.groupBy(hour.alias("_w"), spec.key)
            .agg(F.avg(spec.value).alias(spec.value), F.count(spec.value).alias("n"))
            .select(spec.key, times.from_micros(F.unix_micros("_w.start")).alias("hour"), spec.value, "n"))


# Sums of an hour that later readings can still be added to. ``batch`` is the last micro-batch in them.
HOURS = StructType([StructField("city", StringType()), StructField("hour", TimestampNTZType()), StructField("total", DoubleType()),
                    StructField("n", LongType()), StructField("batch", LongType())])
HOURS_SPEC = SeriesSpec(key="city", ts="hour", value="total", seq="batch")


def add_hourly(batch: DataFrame, number: int, hours: KeyedTable, spec: SeriesSpec = _SPEC) -> None:
    """Add one micro-batch to the stored hours. Only the days its readings fall on are read and rewritten.

    A batch becomes visible as a whole, so an hour that already holds ``number`` or a later batch holds
    this one: a replay adds nothing. The table belongs to one stream and its checkpoint.
    """
    start = times.from_micros(F.unix_micros(F.window(F.timestamp_micros(times.micros(spec.ts)), "1 hour")["start"]))
    parts = materialize(batch.dropna(subset=[spec.key, spec.ts]).groupBy(F.col(spec.key).alias("city"), start.alias("hour")).agg(
        F.coalesce(F.sum(spec.value), F.lit(0.0)).alias("total"), F.count(spec.value).alias("n")), "hours")
    days = [r[0] for r in parts.select(F.to_date("hour")).distinct().collect()]  # one value per calendar day
    known = hours.scan_on(days).select("city", "hour", *[F.col(c).alias(f"_{c}") for c in ("total", "n", "batch")])
    fresh = parts.join(known, ["city", "hour"], "left").filter(F.col("_batch").isNull() | (F.col("_batch") < number))
    hours.upsert(fresh.select(
        "city", "hour", (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total"),
        (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"), F.lit(number).cast("bigint").alias("batch")))


def hourly_means_into(stream: DataFrame, hours: KeyedTable, checkpoint: str, spec: SeriesSpec = _SPEC) -> StreamingQuery:
    """Keep hourly sums in a table. There is no watermark: a reading that is days late corrects its hour."""
    return (stream.writeStream.foreachBatch(lambda batch, number: add_hourly(batch, number, hours, spec))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stored_means(hours: KeyedTable, value: str = "aqi") -> DataFrame:
    """(city, hour, mean, n) of the hours stored so far, as ``hourly_means`` gives them for all readings at once."""
    return hours.scan().select("city", "hour", (F.col("total") / F.nullif(F.col("n"), F.lit(0))).alias(value), "n")


def write_available(result: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that has arrived into a parquet folder, then stop. The sink only appends."""
    (result.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start(path).awaitTermination())
