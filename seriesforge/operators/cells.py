"""Series features over cells of bounded rows, however dense a series gets.

Time buckets with look-back copies hold all readings of a day and more, so a burst that is a thousand
times denser than the rest ends up in one task, and narrower buckets would copy it many times. Here a
series is cut into cells: slots as wide as the shortest rolling window, and the slots with more than
``max_rows`` readings into ever finer parts. A reading leaves its cell only as what other cells ask for:

* for a lag, its value goes to the time one lag later, into the one cell that lies there (and on to the
  neighbours that would otherwise find nothing up to the next reading, within the tolerance);
* for a rolling window, the moments from this reading to the end of its cell go to the time at which the
  window leaves it, already joined with those of the whole cells in between.

A row is thus copied about once a feature whatever the density, a group holds a few times ``max_rows``,
and between cells only one row of moments a cell is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesforge.config import HOUR_US, FeatureConfig, SeriesSpec
from seriesforge.functions import times
from seriesforge.operators.buckets import US, bucket_of, measured
from seriesforge.session import materialize, settle

CELL, SLOT, PARTS = "_cell", "_slot", "_parts"
FINER = 8
_MOMENTS = ("n", "mean", "m2")
_UPTO = (Window.unboundedPreceding, 0)


def slot_us(cfg: FeatureConfig) -> int:
    """No cell may be wider than a rolling window: then a window that begins in a cell holds all of it."""
    return min(cfg.rolling_hours) * HOUR_US


def _width(slot: int) -> Column:
    return F.greatest(F.floor(F.lit(slot) / F.coalesce(PARTS, F.lit(1))).cast("bigint"), F.lit(1))


def cell_at(us: Column, slot: int) -> Column:
    """Start of the cell of a time inside the row's slot, cut into ``_parts``; the last part takes the rest."""
    begin = F.col(SLOT) * F.lit(slot)
    part = F.least(F.floor((us - begin) / _width(slot)).cast("bigint"), F.coalesce(PARTS, F.lit(1)) - 1)
    return begin + part * _width(slot)


def fit_parts(thin: DataFrame, key: str, slot: int, max_rows: int) -> DataFrame:
    """(key, slot, parts) of the slots that are too full: cut ever finer until no part is.

    ``thin`` (key, us) is a stored table; after the first count only the full slots are looked at.
    """
    slots = thin.groupBy(key, bucket_of(F.col(US), slot).alias(SLOT)).agg(F.count(F.lit(1)).alias("_n"))
    full = settle(slots.filter(F.col("_n") > max_rows).select(key, SLOT, F.lit(FINER).cast("bigint").alias(PARTS)), "full-slots")
    if full.isEmpty():
        return full
    done, inside = [], thin.withColumn(SLOT, bucket_of(F.col(US), slot))
    while True:
        counted = inside.join(full, [key, SLOT]).groupBy(key, SLOT, PARTS, cell_at(F.col(US), slot).alias(CELL)).agg(F.count(F.lit(1)).alias("_n"))
        # Parts of one microsecond can't be cut; there is one reading a time.
        tight = F.max("_n") <= max_rows
        fitted = settle(counted.groupBy(key, SLOT, PARTS).agg((tight | (F.max(_width(slot)) <= 1)).alias("_tight")), "fitted-slots")
        done.append(fitted.filter("_tight").drop("_tight"))
        full = fitted.filter("NOT _tight").select(key, SLOT, (F.col(PARTS) * FINER).alias(PARTS))
        if full.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return settle(out, "parts")


def _running(v: Column, window) -> list[Column]:
    return [F.count(v).over(window), F.avg(v).over(window), F.var_pop(v).over(window) * F.count(v).over(window)]


def _home(base: DataFrame, parts: DataFrame, key: str, slot: int) -> tuple[DataFrame, DataFrame]:
    """Readings in their cells with moments from both ends and their neighbours' times, and one row a cell."""
    v = F.col("_v")
    placed = base.withColumn(SLOT, bucket_of(F.col(US), slot)).join(parts, [key, SLOT], "left")
    placed = placed.withColumn(CELL, cell_at(F.col(US), slot)).drop(SLOT, PARTS)
    asc = Window.partitionBy(key, CELL).orderBy(US)
    desc = Window.partitionBy(key, CELL).orderBy(F.col(US).desc())
    rows = placed.withColumns({
        **dict(zip([f"_head_{m}" for m in _MOMENTS], _running(v, asc.rowsBetween(*_UPTO)))),
        **dict(zip([f"_tail_{m}" for m in _MOMENTS], _running(v, desc.rowsBetween(*_UPTO)))),
        "_before": F.lag(US).over(asc), "_before_v": F.lag("_v").over(asc), "_after": F.lead(US).over(asc)})
    rows = materialize(rows, "cell-rows")
    cells = rows.groupBy(key, CELL).agg(
        F.count("_v").alias("n"), F.avg("_v").alias("mean"), (F.var_pop("_v") * F.count("_v")).alias("m2"),
        F.min(US).alias("_first"), F.max(F.struct(US, "_v")).alias("_last"))
    # One row a cell, not the readings.
    order = Window.partitionBy(key).orderBy(CELL)
    cells = settle(cells.withColumns({
        "_prior": F.lag("_last").over(order), "_next": F.lead("_first").over(order),
        "_centre": F.coalesce(F.avg("mean").over(Window.partitionBy(key)), F.lit(0.0))}), "cells")
    ends = cells.select(key, CELL, "_prior", "_next")
    first = F.col("_before").isNull()
    rows = rows.join(ends, [key, CELL]).withColumns({
        "_before_v": F.when(first, F.col("_prior._v")).otherwise(F.col("_before_v")),
        "_before": F.when(first, F.col(f"_prior.{US}")).otherwise(F.col("_before")),
        "_after": F.coalesce("_after", "_next")}).drop("_prior", "_next")
    return rows, cells


def _between(cells: DataFrame, key: str, slot: int, widest: int) -> DataFrame:
    """(key, from cell, to cell, n, mean, m2) of the whole cells between two cells at most a window apart.

    Sums are taken around the series' mean, so little is lost when they are put together.
    """
    d = F.coalesce(F.col("mean") - F.col("_centre"), F.lit(0.0))
    own = cells.select(key, CELL, bucket_of(F.col(CELL), slot).alias(SLOT), "n", "_centre", (F.col("n") * d).alias("_s"),
                       (F.coalesce("m2", F.lit(0.0)) + F.col("n") * d * d).alias("_q"))
    reach = -(-widest // slot) + 1
    # Cells, not readings: a cell meets those of the slots its windows reach back to.
    asking = own.select(key, F.col(CELL).alias("_to"), F.explode(F.sequence(F.col(SLOT) - reach, F.col(SLOT))).alias(SLOT))
    met = asking.join(own, [key, SLOT]).filter(F.col(CELL) < F.col("_to"))
    nearer = Window.partitionBy(key, "_to").orderBy(F.col(CELL).desc()).rowsBetween(Window.unboundedPreceding, -1)
    n, s, q = (F.coalesce(F.sum(c).over(nearer), F.lit(0)) for c in ("n", "_s", "_q"))
    sums = met.select(key, F.col(CELL).alias("_from"), "_to", n.alias("n"), s.alias("_s"), q.alias("_q"), "_centre").filter("n > 0")
    return settle(sums.select(
        key, "_from", "_to", F.col("n").alias("_n_mid"), (F.col("_centre") + F.col("_s") / F.col("n")).alias("_mean_mid"),
        F.greatest(F.col("_q") - F.col("_s") * F.col("_s") / F.col("n"), F.lit(0.0)).alias("_m2_mid")), "between")


def _sent(rows: DataFrame, low: Column, high: Column, at: Column, parts: DataFrame, cells: DataFrame, key: str, slot: int) -> DataFrame:
    """``rows`` once for each non-empty cell that has times from ``low`` to ``high``; ``_at`` is the time they stand for."""
    wide = rows.withColumns({"_low": low, "_high": high, "_at": at}).filter("_low <= _high").withColumn(
        SLOT, F.explode(F.sequence(bucket_of(F.col("_low"), slot), bucket_of(F.col("_high"), slot))))
    wide = wide.join(parts, [key, SLOT], "left")
    begin = F.col(SLOT) * F.lit(slot)
    first, last = cell_at(F.greatest("_low", begin), slot), cell_at(F.least(F.col("_high"), begin + (slot - 1)), slot)
    out = wide.withColumn("_to", F.explode(F.sequence(first, last, _width(slot)))).drop("_low", "_high", SLOT, PARTS)
    held = cells.select(key, F.col(CELL).alias("_to"))
    return out.join(held, [key, "_to"], "left_semi")


def cell_features(df: DataFrame, spec: SeriesSpec, cfg: FeatureConfig, max_rows: int) -> DataFrame:
    """All lag, rolling and change-rate columns of a table with one row per (key, time)."""
    from seriesforge.operators.features import change_rate, merged_moments

    key, slot = spec.key, slot_us(cfg)
    base = materialize(df.dropna(subset=[spec.ts]).filter(F.col(key).isNotNull()).select(
        key, times.micros(spec.ts).alias(US), measured(spec).alias("_v"), F.struct(*df.columns).alias("_row")), "cell-base")
    parts = fit_parts(base.select(key, US), key, slot, max_rows)
    rows, cells = _home(base, parts, key, slot)
    between = _between(cells, key, slot, max(cfg.rolling_hours) * HOUR_US)
    rows = materialize(rows, "cell-home")
    us = F.col(US)
    head = [f"_head_{m}" for m in _MOMENTS]
    asked = rows.select(key, CELL, us.alias("_at"), F.lit(1).alias("_turn"), "_row", "_v", "_before_v", *head)
    every = asked
    # At one time the lagged values come first, then who asks, then what is just leaving the window.
    for lag in cfg.lag_hours:
        at, tolerance = us + lag * HOUR_US, cfg.tolerance_us(lag)
        low = F.greatest(F.coalesce(F.col("_before") + lag * HOUR_US, at - tolerance), at - tolerance)
        high = F.least(F.coalesce(F.col("_after") + lag * HOUR_US, at + tolerance), at + tolerance)
        sent = _sent(rows.select(key, US, "_v", "_before", "_after"), low, high, at, parts, cells, key, slot)
        every = every.unionByName(sent.select(
            key, F.col("_to").alias(CELL), "_at", F.lit(0).alias("_turn"), F.struct(F.col("_at").alias("at"), F.col("_v").alias("v")).alias(f"_lag_{lag}")),
            allowMissingColumns=True)
    for w in cfg.rolling_hours:
        at = us + w * HOUR_US
        low = F.greatest(F.coalesce(F.col("_before") + w * HOUR_US, us), us)
        tails = [f"_tail_{m}" for m in _MOMENTS]
        sent = _sent(rows.select(key, CELL, US, "_before", *tails), low, at - 1, at, parts, cells, key, slot)
        sent = sent.withColumnRenamed(CELL, "_from").join(between, [key, "_from", "_to"], "left")
        zero = F.lit(0).cast("bigint")
        n, mean, m2 = merged_moments(*[F.col(c) for c in tails], F.coalesce("_n_mid", zero), F.col("_mean_mid"), F.col("_m2_mid"))
        same = F.col("_from") == F.col("_to")
        every = every.unionByName(sent.select(
            key, F.col("_to").alias(CELL), "_at", F.lit(2).alias("_turn"),
            F.struct(F.when(same, zero).otherwise(n).alias("n"), F.when(~same, mean).alias("mean"), F.when(~same, m2).alias("m2")).alias(f"_window_{w}")),
            allowMissingColumns=True)
    asc = Window.partitionBy(key, CELL).orderBy("_at", "_turn").rowsBetween(*_UPTO)
    desc = Window.partitionBy(key, CELL).orderBy(F.col("_at").desc(), "_turn").rowsBetween(*_UPTO)
    found = every.withColumns({
        **{f"_back_{lag}": F.last(f"_lag_{lag}", ignorenulls=True).over(asc) for lag in cfg.lag_hours},
        **{f"_ahead_{lag}": F.last(f"_lag_{lag}", ignorenulls=True).over(desc) for lag in cfg.lag_hours},
        **{f"_earlier_{w}": F.last(f"_window_{w}", ignorenulls=True).over(desc) for w in cfg.rolling_hours}}).filter("_turn = 1")
    columns = {f"{spec.value}_change_rate": change_rate(F.col("_v"), F.col("_before_v"))}
    for lag in cfg.lag_hours:
        back, ahead = F.col(f"_back_{lag}"), F.col(f"_ahead_{lag}")
        gap_back, gap_ahead = F.col("_at") - back["at"], ahead["at"] - F.col("_at")
        tolerance = cfg.tolerance_us(lag)
        nearer = (gap_back <= tolerance) & (gap_back <= F.coalesce(gap_ahead, F.lit(tolerance + 1)))
        columns[f"lag_{lag}h_{spec.value}"] = F.when(nearer, back["v"]).when(gap_ahead <= tolerance, ahead["v"])
    for w in cfg.rolling_hours:
        before = F.col(f"_earlier_{w}")
        n, mean, m2 = merged_moments(*[F.col(c) for c in head], F.coalesce(before["n"], F.lit(0).cast("bigint")), before["mean"], before["m2"])
        columns[f"rolling_{w}h_mean_{spec.value}"] = mean
        columns[f"rolling_{w}h_std_{spec.value}"] = F.when(n > 1, F.sqrt(m2 / (n - 1)))
    return found.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns], *[c.alias(n) for n, c in columns.items()])
