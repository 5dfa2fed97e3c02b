"""Per-city scaling and gap-checked windows of past values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge.config import MINUTE_US, SEQUENCE_LENGTH, SeriesSpec
from seriesforge.functions import times
from seriesforge.operators import buckets as B
from seriesforge.operators.selection import chronological_cut

STEP_MINUTES, JITTER_MINUTES = 60, 15
_SPEC = SeriesSpec()


def fit_scalers(df: DataFrame, spec: SeriesSpec = _SPEC) -> DataFrame:
    """Lowest and highest value per key."""
    return df.groupBy(spec.key).agg(F.min(spec.value).alias("lo"), F.max(spec.value).alias("hi"))


def _span() -> Column:
    return F.when(F.col("hi") == F.col("lo"), 1.0).otherwise(F.col("hi") - F.col("lo"))


def scale(df: DataFrame, scalers: DataFrame, column: str, out: str, key: str = "city") -> DataFrame:
    """To 0..1 within the key; a constant series maps to 0."""
    return (df.join(scalers, key).withColumn(out, (F.col(column) - F.col("lo")) / _span()).drop("lo", "hi"))


def unscale(df: DataFrame, scalers: DataFrame, column: str, out: str, key: str = "city") -> DataFrame:
    return (df.join(scalers, key).withColumn(out, F.col(column) * _span() + F.col("lo")).drop("lo", "hi"))


def missing_scalers(df: DataFrame, scalers: DataFrame, key: str = "city") -> DataFrame:
    return df.select(key).distinct().join(scalers, key, "left_anti")


def build_sequences(df: DataFrame, length: int = SEQUENCE_LENGTH, spec: SeriesSpec = _SPEC,
                    bucket_hours: int = 96) -> DataFrame:
    """(key, target time, x: the ``length`` values before, y: the target value).

    Every step inside the window must be an hour within the jitter, so a valid window reaches
    back a bounded time. Bucketed halos of that reach give exactly the windows a scan of the
    whole series would, without one task per series.
    """
    longest_step = (STEP_MINUTES + JITTER_MINUTES + 1) * MINUTE_US
    rows = B.with_halo(df.select(spec.key, spec.ts, spec.value).dropna(), spec,
                       bucket_hours * 60 * MINUTE_US, length * longest_step)
    order = Window.partitionBy(spec.key, B.BUCKET).orderBy(B.US)
    minutes = F.floor((F.col(B.US) - F.lag(B.US).over(order)) / MINUTE_US)
    regular = (F.abs(minutes - STEP_MINUTES) <= JITTER_MINUTES).cast("int")
    steps = rows.withColumn("_regular", regular)
    return (steps.withColumn("_valid", F.sum("_regular").over(order.rowsBetween(1 - length, 0)))
            .withColumn("x", F.collect_list("_v").over(order.rowsBetween(-length, -1)))
            .filter(F.col(B.HOME) & (F.col("_valid") == length))
            .select(spec.key, F.col(f"{B.PAYLOAD}.{spec.ts}").alias("target_ts"), "x", F.col("_v").alias("y")))


def split_sequences(sequences: DataFrame, test_fraction: float = 0.2, key: str = "city") -> DataFrame:
    """Chronological split inside every key, as an ``is_train`` column."""
    return chronological_cut(sequences, [key], times.micros("target_ts"), [], test_fraction)


def seed_windows(clean: DataFrame, length: int = SEQUENCE_LENGTH, spec: SeriesSpec = _SPEC) -> DataFrame:
    """The last ``length`` readings per key, whatever their spacing; keys with fewer are left out.

    The rank filter becomes a map-side group limit, so only ``length`` rows per key and task
    are shuffled.
    """
    newest = Window.partitionBy(spec.key).orderBy(F.col(spec.ts).desc())
    point = F.struct(times.micros(spec.ts).alias("us"), F.col(spec.value).alias("v"))
    windows = (clean.select(spec.key, spec.ts, spec.value).withColumn("_rank", F.row_number().over(newest))
               .filter(F.col("_rank") <= length)
               .groupBy(spec.key).agg(F.sort_array(F.collect_list(point)).alias("_points")))
    ordered = F.transform("_points", lambda p: p["v"])
    longest = F.array_max(F.transform(F.sequence(F.lit(1), F.lit(length - 1)), lambda i: F.abs(
        F.floor((F.col("_points")[i]["us"] - F.col("_points")[i - 1]["us"]) / MINUTE_US) - STEP_MINUTES)))
    return windows.filter(F.size("_points") == length).select(
        spec.key, F.col("_points")[length - 1]["us"].alias("last_us"), ordered.alias("x"),
        (longest > JITTER_MINUTES).alias("seed_has_gap"))
