"""Landing-directory readers for the nested JSON payloads, and their flattening."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from seriesforge import config as C, schema as S
from seriesforge.functions import scalar, times
from seriesforge.operators.lookups import merge_weather, with_pm25_index
from seriesforge.operators.quality import flag_stale, flag_station
from seriesforge.session import file_system

_META = ["city", "poll_id", "ingested_at"]
DAY, BROKEN = "date", "_broken"


def read_landing(spark: SparkSession, path: str, payload: StructType) -> DataFrame:
    """JSON lines with a fixed schema: (city, poll_id, ingested_at) plus the payload fields."""
    return spark.read.schema(S.landed(payload)).json(path)


def day_folders(spark: SparkSession, path: str, first=None, last=None) -> list[str]:
    """The ``date=`` folders of a landing directory from the first to the last day; others are not even listed."""
    fs, root = file_system(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []
    low, high = f"{DAY}={first or ''}", f"{DAY}={last or '9999-12-31'}"
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if n.startswith(f"{DAY}=") and low <= n <= high]


def read_landing_days(spark: SparkSession, path: str, payload: StructType, first=None, last=None,
                      earlier: int = 0) -> DataFrame:
    """JSON lines of the days that can hold events of the range, with the text of lines that can't be read.

    Folders are days of arrival. A document may hold events of up to ``earlier`` days before it arrived,
    so that many more days are read behind the range; rows outside it are filtered by the caller.
    """
    schema = S.landed(payload)
    until = last and str(date.fromisoformat(str(last)) + timedelta(days=earlier))
    folders = day_folders(spark, path, first, until)
    if not folders:
        return spark.createDataFrame([], S.landed(payload).add(BROKEN, "string"))
    # Parsed from text: a line that can't be read keeps it, and is found without any of its fields.
    marked = S.landed(payload).add(BROKEN, "string")
    doc = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    lines = spark.read.text(folders).filter(F.trim("value") != "").select("value", doc.alias("_doc"))
    return lines.select(*[F.col(f"_doc.{c}").alias(c) for c in schema.fieldNames()],
                        F.when(F.col(f"_doc.{BROKEN}").isNotNull(), F.col("value")).alias(BROKEN))


def split_broken(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that could be read, and (line) the text of those that could not."""
    bad = F.col(BROKEN).isNotNull()
    return landed.filter(~bad).drop(BROKEN), landed.filter(bad).select(F.col(BROKEN).alias("line"))


def parse_bodies(bodies: DataFrame, payload: StructType) -> DataFrame:
    """Payloads kept as one JSON text column ``body``."""
    doc = F.from_json("body", payload)
    return bodies.select(*_META, doc.alias("_doc")).select(*_META, "_doc.*")


def split_by_status(current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted documents, and those a source did not answer with 'ok'."""
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    return current.filter(ok), current.filter(~ok)


def flatten_current(current: DataFrame) -> DataFrame:
    """One flat reading per accepted document; nested nulls stay null, no time means arrival time."""
    accepted, _ = split_by_status(current)
    measure = {c: F.col(f"data.iaqi.{c}.v") for c in C.POLLUTANTS}
    inline = dict(zip(C.INLINE_WEATHER, ["t", "h", "p", "w"]))
    iso = F.col("data.time.iso")
    return accepted.select(
        "city", "poll_id",
        F.col("data.city.name").alias("matched_station"),
        F.when(iso.isNull(), F.col("ingested_at")).otherwise(times.parse_utc(iso)).alias("timestamp"),
        scalar.resolve_index(F.col("data.aqi"), measure["pm25"]).alias("aqi"),
        F.col("data.dominentpol").alias("dominant_pollutant"),
        *[scalar.to_double(m).alias(c) for c, m in measure.items()],
        *[scalar.to_double(F.col(f"data.iaqi.{f}.v")).alias(c) for c, f in inline.items()])


def flatten_weather(weather: DataFrame) -> DataFrame:
    return weather.select(
        "city", "poll_id", F.col("main.temp").alias("temp"), F.col("main.humidity").alias("humidity"),
        F.col("main.pressure").alias("pressure"), F.col("wind.speed").alias("wind_speed"),
        F.col("wind.deg").alias("wind_deg"))


def snapshot(current: DataFrame, weather: DataFrame, as_of_us: Column,
             cities: DataFrame | None = None) -> DataFrame:
    """Readings of all configured cities in one job: flatten, add weather, flag quality."""
    flat = flatten_current(current)
    if cities is not None:
        flat = flat.join(cities.select("city"), "city", "left_semi")
    merged = merge_weather(flat, flatten_weather(weather))
    return flag_station(flag_stale(merged, as_of_us))


def explode_history(history: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """One row per history entry, epoch seconds to UTC, both range ends included."""
    entry = history.select("city", "poll_id", F.explode("list").alias("e"))
    rows = entry.select(
        "city", "poll_id", times.epoch_seconds_to_utc(F.col("e.dt")).alias("timestamp"),
        *[F.col(f"e.components.{'pm2_5' if c == 'pm25' else c}").alias(c) for c in C.POLLUTANTS])
    if start is not None:
        rows = rows.filter(F.col("timestamp") >= start)
    return rows if end is None else rows.filter(F.col("timestamp") <= end)


def backfill_rows(history: DataFrame) -> DataFrame:
    """History entries as raw readings: index from PM2.5, constants, no weather."""
    empty = [*C.WEATHER, *C.INLINE_WEATHER]
    return with_pm25_index(history).withColumns({
        "dominant_pollutant": F.lit("pm25"),
        "matched_station": F.concat(F.col("city"), F.lit(" (OpenWeather historical)")),
        "is_stale": F.lit(False),
        **{c: F.lit(None).cast("double") for c in empty},
    })
