"""Time buckets with a halo: split a long series without losing look-back.

``Window.partitionBy(key)`` puts a whole series into one task. Here every row is grouped by
(key, time bucket) instead, and is also copied into the later buckets whose rows can still
look back at it. A hot series then spreads over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge.config import HOUR_US, SeriesSpec
from seriesforge.functions import times

BUCKET, US, HOME, PAYLOAD = "_bucket", "_us", "_home", "_payload"


def bucket_of(us: Column, width_us: int) -> Column:
    # The remainder goes first, so the quotient is a whole number and exact.
    return ((us - F.pmod(us, F.lit(width_us))) / F.lit(width_us)).cast("bigint")


def measured(spec: SeriesSpec) -> Column:
    """The value as a double, NaN counting as missing."""
    v = F.col(spec.value).cast("double")
    return F.when(~F.isnan(v), v)


def with_halo(df: DataFrame, spec: SeriesSpec, width_us: int, reach_us: int) -> DataFrame:
    """(key, bucket, us, value, home, payload): home rows keep all columns, copies only the value."""
    us = times.micros(spec.ts)
    whole_row = F.struct(*df.columns)
    return (df.select(F.col(spec.key), us.alias(US), measured(spec).alias("_v"), whole_row.alias(PAYLOAD))
            .withColumn(BUCKET, F.explode(F.sequence(bucket_of(F.col(US), width_us),
                                                     bucket_of(F.col(US) + reach_us, width_us))))
            .withColumn(HOME, F.col(BUCKET) == bucket_of(F.col(US), width_us))
            .withColumn(PAYLOAD, F.when(F.col(HOME), F.col(PAYLOAD))))


def bucket_edges(df: DataFrame, spec: SeriesSpec, width_us: int) -> DataFrame:
    """For each non-empty bucket: the last (us, value) of the previous non-empty one.

    Repeats of a time need no dedupe first: the greatest (us, seq) is the row keep-last keeps.
    The window sees one row per bucket, not the readings.
    """
    us = times.micros(spec.ts)
    last = F.max(F.struct(us.alias("us"), F.col(spec.seq).alias("seq"), measured(spec).alias("v")))
    edges = (df.dropna(subset=[spec.ts])
             .groupBy(F.col(spec.key), bucket_of(us, width_us).alias(BUCKET))
             .agg(last.alias("_edge")))
    order = Window.partitionBy(spec.key).orderBy(BUCKET)
    return edges.select(spec.key, BUCKET,
                        F.lag("_edge").over(order).alias("_prev"),
                        F.lag(BUCKET).over(order).alias("_prev_bucket"))


def carried_rows(edges: DataFrame, spec: SeriesSpec, width_us: int, reach_us: int, payload_type) -> DataFrame:
    """The previous reading of a bucket whose halo is empty, shaped like a halo copy."""
    beyond = F.col("_prev.us") + reach_us < F.col(BUCKET) * F.lit(width_us)
    return edges.filter(beyond).select(
        F.col(spec.key), F.col("_prev.us").alias(US), F.col("_prev.v").alias("_v"),
        F.lit(None).cast(payload_type).alias(PAYLOAD), F.col(BUCKET), F.lit(False).alias(HOME))


def reached_buckets(changed: DataFrame, spec: SeriesSpec, width_us: int, reach_us: int) -> DataFrame:
    """The buckets of the rows of ``changed`` and the later ones within look-back."""
    us = times.micros(spec.ts)
    return changed.dropna(subset=[spec.ts]).select(
        F.col(spec.key), F.explode(F.sequence(bucket_of(us, width_us), bucket_of(us + reach_us, width_us))).alias(BUCKET)).distinct()


def touched_buckets(edges: DataFrame, changed: DataFrame, spec: SeriesSpec,
                    width_us: int, reach_us: int) -> DataFrame:
    """Buckets whose features can change when the rows of ``changed`` arrive.

    Their own buckets, the later ones within look-back, and the next non-empty bucket, whose
    first row takes its previous reading from here.
    """
    hit = reached_buckets(changed, spec, width_us, reach_us)
    following = (edges.select(spec.key, BUCKET, "_prev_bucket")
                 .join(hit.withColumnRenamed(BUCKET, "_prev_bucket"), [spec.key, "_prev_bucket"], "left_semi")
                 .select(spec.key, BUCKET))
    return hit.unionByName(following).distinct()


def fit_bucket_hours(df: DataFrame, spec: SeriesSpec = SeriesSpec(), max_rows: int = 2_000_000,
                     shortest: int = 6, longest: int = 24 * 28) -> int:
    """Bucket width at which the densest series stays near ``max_rows`` readings per bucket.

    One pass over (key, time) that returns a single number. Narrow buckets copy more halo
    rows, wide ones run fewer tasks.
    """
    peak = (df.dropna(subset=[spec.ts]).groupBy(spec.key, bucket_of(times.micros(spec.ts), HOUR_US).alias("_hour"))
            .agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0])
    return longest if not peak else max(shortest, min(longest, max_rows // peak))
