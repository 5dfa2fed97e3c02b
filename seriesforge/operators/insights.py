"""Trend, pattern, freshness and alert tables over cleaned readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge import config as C
from seriesforge.config import SeriesSpec
from seriesforge.functions import scalar, times
from seriesforge.operators import quality
from seriesforge.operators.lookups import with_spine, with_spine_per_key
from seriesforge.operators.selection import exact_median
from seriesforge.session import settle

_SPEC = SeriesSpec()


def summary_stats(clean: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Mean, exact median, min, max, sample deviation and count per key."""
    v = F.col(spec.value)
    stats = clean.groupBy(spec.key).agg(
        F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.stddev_samp(v).alias("std"), F.count(v).alias("count"))
    joined = stats.join(exact_median(clean, [spec.key], spec.value), spec.key, "left")
    return joined.select(spec.key, "mean", "median", "min", "max", "std", "count").orderBy(F.desc("mean"))


def daily_trend(clean: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    return (clean.groupBy(spec.key, times.day_floor(F.col(spec.ts)).alias("day"))
            .agg(F.avg(spec.value).alias(spec.value)).orderBy(spec.key, "day"))


def _only(clean: DataFrame, key: str, wanted: str | None) -> DataFrame:
    return clean if wanted is None else clean.filter(F.col(key) == wanted)


def _pattern(clean: DataFrame, spec: SeriesSpec, part: Column, name: str, size: int,
             key: str | None, per_key: bool) -> DataFrame:
    rows = _only(clean, spec.key, key)
    groups = [spec.key] if per_key else []
    means = rows.groupBy(*groups, part.alias(name)).agg(F.avg(spec.value).alias(spec.value))
    full = with_spine_per_key(means, spec.key, name, size) if per_key else with_spine(means, name, size)
    return full.orderBy(*groups, name)


def hourly_pattern(clean: DataFrame, key: str | None = None, spec: SeriesSpec = _SPEC,
                   per_key: bool = False) -> DataFrame:
    return _pattern(clean, spec, F.hour(spec.ts), "hour", 24, key, per_key)


def weekday_pattern(clean: DataFrame, key: str | None = None, spec: SeriesSpec = _SPEC,
                    per_key: bool = False) -> DataFrame:
    return _pattern(clean, spec, F.weekday(spec.ts), "day_of_week", 7, key, per_key)


def freshness(clean: DataFrame, now_us: Column, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Reading count, latest reading and its age in hours; the freshest key first."""
    found = clean.groupBy(spec.key).agg(F.count(spec.ts).alias("reading_count"),
                                        F.max(spec.ts).alias("latest_reading"))
    age = times.hours_between(now_us, times.micros("latest_reading"))
    return found.withColumn("hours_since_latest", age).orderBy("hours_since_latest")


def freshness_view(fresh: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    """The freshness table as it is shown."""
    return fresh.select(
        F.col(spec.key).alias("City"), F.col("reading_count").alias("Readings collected"),
        times.reading_text(F.col("latest_reading")).alias("Latest reading"),
        scalar.half_even_tenths(F.col("hours_since_latest")).alias("Hours ago"))


def latest_reading(clean: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    last = F.max_by(F.struct(F.col(spec.ts), F.col(spec.value)), F.col(spec.ts)).alias("_last")
    return clean.groupBy(spec.key).agg(last).select(
        spec.key, F.col(f"_last.{spec.ts}").alias(spec.ts), F.col(f"_last.{spec.value}").alias(spec.value))


def recent_history(clean: DataFrame, hours_back: int = C.HISTORY_HOURS, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Rows no older than ``hours_back`` before the newest row of their key, bounds included."""
    oldest = F.max(spec.ts) - F.make_dt_interval(hours=F.lit(hours_back))
    cut = settle(clean.groupBy(spec.key).agg(oldest.alias("_from")), "newest")
    return clean.join(cut, spec.key).filter(F.col(spec.ts) >= F.col("_from")).drop("_from")


def recent_clean(raw: DataFrame, hours_back: int = C.HISTORY_HOURS, spec: SeriesSpec = _SPEC) -> DataFrame:
    """The clean rows of the last hours of each key. Old rows are cut off before repeats are looked for."""
    return quality.keep_last(recent_history(quality.valid_rows(raw, spec), hours_back, spec), spec)


def daily_means(frame: DataFrame, spec: SeriesSpec = _SPEC, zone: str | None = C.DISPLAY_ZONE) -> DataFrame:
    """Mean per local day, rounded half-even to a whole number."""
    ts = F.col(spec.ts) if zone is None else times.local_time(F.col(spec.ts), zone)
    return (frame.groupBy(spec.key, times.day_floor(ts).alias("day"))
            .agg(scalar.half_even(F.avg(spec.value)).alias(spec.value)))


def forecast_peak(forecast: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Highest forecast per key; the earliest of equal ones."""
    top = F.max_by(F.struct(F.col(spec.ts), F.col(spec.value)),
                   F.struct(F.col(spec.value), -times.micros(spec.ts))).alias("_top")
    return forecast.groupBy(spec.key).agg(top).select(
        spec.key, F.col(f"_top.{spec.ts}").alias("peak_time"), F.col(f"_top.{spec.value}").alias("peak"))


def peak_alert(forecast: DataFrame, spec: SeriesSpec = _SPEC, threshold: float = C.HAZARD_THRESHOLD) -> DataFrame:
    """Alert rows: the rounded peak reaches the hazard threshold."""
    rounded = scalar.half_even(F.col("peak")).cast("bigint")
    return (forecast_peak(forecast, spec).withColumn("peak_index", rounded)
            .filter(F.col("peak_index") >= threshold)
            .withColumn("category_label", F.lower(scalar.category_label(F.col("peak_index")))))


def measured_and_forecast(history: DataFrame, forecast: DataFrame, spec: SeriesSpec = _SPEC,
                          zone: str | None = C.DISPLAY_ZONE) -> DataFrame:
    """Daily panel: measured days, and the forecast line starting at the last measured day."""
    measured = daily_means(history, spec, zone)
    last = measured.groupBy(spec.key).agg(F.max(F.struct("day", spec.value)).alias("_l")).select(
        spec.key, F.col("_l.day").alias("day"), F.col(f"_l.{spec.value}").alias(spec.value))
    line = last.unionByName(daily_means(forecast, spec, zone))
    return (measured.withColumn("kind", F.lit("measured"))
            .unionByName(line.withColumn("kind", F.lit("forecast"))))


def driver_panel(explained: DataFrame, key: str = "city") -> DataFrame:
    """Bar width relative to the strongest driver of the key, arrow and wording."""
    size = F.abs("attribution")
    # At most one row per model feature and key, so the window stays small.
    strongest = F.max(size).over(Window.partitionBy(key))
    scale = F.when(strongest == 0, 1.0).otherwise(strongest)
    return explained.select(
        key, "rank", "label",
        F.least(F.lit(100.0), 100 * size / scale).alias("width_pct"),
        F.when(F.col("attribution") > 0, "▲").otherwise("▼").alias("arrow"),
        scalar.driver_phrase(F.col("attribution")).alias("phrase"))


def hourly_table(forecast: DataFrame, spec: SeriesSpec = _SPEC, zone: str = C.DISPLAY_ZONE) -> DataFrame:
    """Hour-by-hour forecast table in local time."""
    local, index = times.local_time(F.col(spec.ts), zone), scalar.half_even(F.col(spec.value)).cast("bigint")
    return forecast.select(
        spec.key, local.alias("local_time"), times.day_text(local).alias("Day"), times.clock_text(local).alias("Time"),
        index.alias("AQI"), scalar.category_label(index).alias("How it feels"))




def forecast_view(forecast: DataFrame, horizon: int = C.FORECAST_HORIZON, zone: str = C.DISPLAY_ZONE) -> DataFrame:
    """Local time and value of the first ``horizon`` steps."""
    return forecast.filter(F.col("step") <= horizon).select(
        "city", times.local_time(F.col("timestamp"), zone).alias("time"), F.col("predicted_aqi").alias("aqi"))


def series_counts(df: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Rows and distinct keys of a table."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(spec.key).alias("series"))
