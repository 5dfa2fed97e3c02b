"""Joins against small dimensions and calendar spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge import config as C
from seriesforge.functions import scalar
from seriesforge.schema import breakpoint_dim, category_dim, label_dim


def merge_weather(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of the same poll where there is one, else the reading's inline values, per field."""
    names = dict(zip(C.WEATHER, C.INLINE_WEATHER))
    observed = weather.select("city", "poll_id", *[F.col(c).alias(f"_{c}") for c in names])
    return (readings.join(observed, ["city", "poll_id"], "left")
            .withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(inline)) for c, inline in names.items()})
            .drop(*[f"_{c}" for c in names]))


def with_pm25_index(df: DataFrame, pm25: str = "pm25", name: str = "aqi") -> DataFrame:
    """Index of a PM2.5 column, in two projections so that rounding reads a computed value.

    As one expression the CASE would be generated once per use in the rounding, which grows
    the generated method beyond what the JIT compiles.
    """
    linear = df.withColumn("_linear", scalar.pm25_segment_value(F.col(pm25)))
    return linear.withColumn(name, scalar.half_even_tenths(F.col("_linear"))).drop("_linear")


def range_lookup_index(df: DataFrame, pm25: str = "pm25", name: str = "index") -> DataFrame:
    """Table-driven index conversion: the breakpoint row whose closed range holds the value.

    The breakpoint table has a fixed handful of rows, hence the broadcast. ``pm25_index`` is
    the codegen form of the same rule.
    """
    points = breakpoint_dim(df.sparkSession)
    value = F.col(pm25)
    hit = df.join(F.broadcast(points), value.between(F.col("conc_low"), F.col("conc_high")), "left")
    slope = (F.col("index_high") - F.col("index_low")) / (F.col("conc_high") - F.col("conc_low"))
    top = C.PM25_BREAKPOINTS[-1][1]
    linear = F.when(value > top, C.PM25_OVER_RANGE_INDEX).otherwise(
        slope * (value - F.col("conc_low")) + F.col("index_low"))
    return (hit.withColumn("_linear", linear).withColumn(name, scalar.half_even_tenths(F.col("_linear")))
            .select(*df.columns, "segment", name))


def category_attributes(df: DataFrame, index: Column) -> DataFrame:
    """Attach key, label, phrase, colour and guidance of the display category."""
    dim = category_dim(df.sparkSession).drop("upper_limit")
    return df.withColumn("category_key", scalar.category_key(index)).join(F.broadcast(dim), "category_key", "left")


def feature_labels(df: DataFrame, city: str = "city") -> DataFrame:
    """Readable feature names; the indicator of another city is dropped, unknown names stay."""
    named = df.join(F.broadcast(label_dim(df.sparkSession)), "feature", "left")
    dummy = F.startswith(F.col("feature"), F.lit("city_"))
    own = F.col("feature") == F.concat(F.lit("city_"), F.col(city))
    return named.filter(~dummy | own).withColumn(
        "label", F.when(dummy, F.concat(F.lit("Being in "), F.col(city)))
        .otherwise(F.coalesce(F.col("label"), F.col("feature"))))


def with_spine(pattern: DataFrame, column: str, size: int) -> DataFrame:
    """All values 0..size-1 of a calendar column; absent ones get null, an empty pattern stays empty."""
    spine = pattern.sparkSession.range(size).select(F.col("id").cast("int").alias(column))
    full = spine.join(pattern.withColumn("_found", F.lit(1)), column, "left")
    # The window sees the ``size`` spine rows, never the readings.
    some = F.max("_found").over(Window.partitionBy(F.lit(0)))
    return full.withColumn("_some", some).filter(F.col("_some") == 1).drop("_found", "_some")


def with_spine_per_key(pattern: DataFrame, key: str, column: str, size: int) -> DataFrame:
    """The same spine for every key that has data."""
    spine = (pattern.select(key).distinct()
             .withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(size - 1)))))
    return spine.join(pattern, [key, column], "left")
