"""Coercion, keep-last dedupe, quality flags and row-count metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from seriesforge.config import SeriesSpec
from seriesforge.functions import scalar, times
from seriesforge.schema import NUMERIC_READINGS

DERIVED_PREFIXES = ("lag_", "rolling_", "aqi_change_rate")


def coerce_numeric(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Reading and derived columns to double; unreadable values become null."""
    wanted = [c for c in df.columns
              if c in NUMERIC_READINGS or c in extra or c.startswith(DERIVED_PREFIXES)]
    return df.withColumns({c: scalar.to_double(F.col(c)) for c in wanted})


def normalize_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text event time to naive UTC; unreadable becomes null."""
    return df.withColumn(column, times.parse_utc(F.col(column)))


def keep_last(df: DataFrame, spec: SeriesSpec = SeriesSpec(), ties: str | None = None) -> DataFrame:
    """One row per (key, time): the one that came last in input order.

    The rank filter is planned as a group limit on both sides of the exchange: every map task
    keeps one row per (key, time), so a pile of copies of one reading never meets in one task.
    ``ties`` names a column whose greatest value decides between equal input positions.
    """
    order = [F.col(c).desc() for c in (spec.seq, ties) if c]
    latest = Window.partitionBy(spec.key, spec.ts).orderBy(*order)
    return (df.dropna(subset=[spec.ts]).withColumn("_rank", F.row_number().over(latest))
            .filter(F.col("_rank") == 1).drop("_rank"))


def valid_rows(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Numeric value, no missing key, time or value."""
    checked = df.withColumn(spec.value, scalar.to_double(F.col(spec.value)))
    return checked.dropna(subset=[spec.key, spec.ts, spec.value])


def clean_series(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Valid rows, one per (key, time)."""
    return keep_last(valid_rows(df, spec), spec)


def flag_stale(df: DataFrame, as_of_us: Column, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    return df.withColumn("is_stale", scalar.is_stale(times.micros(spec.ts), as_of_us))


def flag_station(df: DataFrame) -> DataFrame:
    return df.withColumn("station_ok", scalar.station_matches(F.col("matched_station"), F.col("city")))


def dedupe_counts(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Rows, distinct (key, time) and dropped rows per key, in two map-side-combined steps."""
    per_time = df.dropna(subset=[spec.ts]).groupBy(spec.key, spec.ts).agg(F.count(F.lit(1)).alias("n"))
    return per_time.groupBy(spec.key).agg(
        F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("rows_kept"),
        (F.sum("n") - F.count(F.lit(1))).alias("rows_dropped"))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side product of whatever action runs on the result."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def null_fractions(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its share of missing values, from a single pass."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return shares.unpivot([], columns, "column_name", "null_fraction")
