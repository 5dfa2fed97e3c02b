"""Ranks within groups of any size: one range shuffle instead of a window per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.session import materialize, settle


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with each row's rank from 0 within ``group`` by ``order``, ascending, nulls first.

    The rows are range-sorted, so a group that holds a third of them lies in many tasks; a rank is the
    place in the task plus what earlier tasks hold of the group. Rows that agree in ``group`` and
    ``order`` are told apart by their place in ``df``, so repeated rows are dealt out as well, and swap
    ranks only among themselves. ``df`` must be a stored table: it is read once for the borders.
    """
    keys = [group, *order, "__salt"]
    ranged = df.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialize(ranged.withColumn("__at", F.monotonically_increasing_id()).drop("__salt"), "ordered")
    task = F.shiftright("__at", 33).alias("__task")  # the id's upper bits number the task
    held = stored.groupBy(group, task).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    # One row a group and task that holds it: a group has at most as many as there are tasks.
    shifts = settle(held.select(
        F.col(group).alias("__group"), "__task", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")), "shifts")
    rows = stored.withColumn("__of", task)
    met = rows[group].eqNullSafe(shifts["__group"]) & (rows["__of"] == shifts["__task"])
    return rows.join(shifts, met).withColumn(name, F.col("__at") + F.col("__shift")).drop("__at", "__of", "__group", "__task", "__shift")
