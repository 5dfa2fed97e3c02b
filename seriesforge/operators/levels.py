"""One number a series instead of one column a series: its level, the mean target seen so far.

Trees given an indicator for every series scan as many columns as there are series. The level is fitted on
training rows alone. A training row only knows the rows of earlier days (ordered target statistics), so
its own target is not in it; other rows get the level of all training rows. Both lean to the mean of the
training rows the fewer rows a series has, and a series not trained on has no level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge.config import HOUR_US
from seriesforge.functions import times
from seriesforge.operators.buckets import bucket_of
from seriesforge.session import settle

LEVEL = "series_level"
# Rows of the general mean that a series' own rows are weighed against.
PRIOR_ROWS = 10.0


def _leaning(total: Column, n: Column, prior: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + F.lit(PRIOR_ROWS * prior)) / (F.coalesce(n, F.lit(0)) + F.lit(PRIOR_ROWS))


def prior_of(train: DataFrame, target: str = "aqi") -> float:
    """Mean target of all training rows; one number."""
    return float(train.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0)


def fit_levels(train: DataFrame, prior: float, target: str = "aqi", key: str = "city") -> DataFrame:
    """(key, level) from all training rows: one row a series, never collected."""
    y = F.col(target).cast("double")
    sums = train.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    return settle(sums.select(key, _leaning(F.col("_s"), F.col("_n"), prior).alias(LEVEL)), "levels")


def ordered_levels(train: DataFrame, prior: float, target: str = "aqi", key: str = "city", ts: str = "timestamp") -> DataFrame:
    """``train`` with each row's level from its series' rows of earlier days.

    Sums per series and day are combined in the map tasks; only they, one row a day, are put in order,
    so a series of any size is no task of its own. Rows without a time know nothing but the general mean.
    """
    y, day = F.col(target).cast("double"), bucket_of(times.micros(ts), 24 * HOUR_US)
    days = train.dropna(subset=[key, ts]).groupBy(F.col(key).alias("_key"), day.alias("_of")).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    level = _leaning(F.sum("_s").over(earlier), F.sum("_n").over(earlier), prior)
    known = settle(days.select("_key", "_of", level.alias(LEVEL)), "levels-by-day")
    rows = train.withColumn("_day", day)
    joined = rows.join(known, (rows[key] == known["_key"]) & (rows["_day"] == known["_of"]), "left")
    return joined.withColumn(LEVEL, F.coalesce(LEVEL, F.lit(prior))).drop("_day", "_key", "_of")


def with_levels(df: DataFrame, levels: DataFrame, key: str = "city") -> DataFrame:
    """``df`` with the level of each row's series, null where the series was not trained on."""
    return df.join(levels, key, "left")
