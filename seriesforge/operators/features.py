"""Calendar, as-of lag, rolling and change-rate features of irregular series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from seriesforge.config import HOUR_US, FeatureConfig, SeriesSpec
from seriesforge.functions import times
from seriesforge.operators import buckets as B, cells as C
from seriesforge.operators.quality import keep_last

_FIRST = Window.unboundedPreceding
_MOMENTS = ("n", "mean", "m2")
# Each of the sorts holds the rows of its task, so there is a task for about this many readings: more tasks
# than large buckets, or else several of those would meet in one.
ROWS_PER_TASK = 25_000


def add_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(times.calendar(F.col(ts)))


def _nearest(asc: WindowSpec, desc: WindowSpec, lag_us: int, tolerance_us: int) -> Column:
    """Value nearest to (now - lag): ties go to the earlier row, a matched null stays null.

    Both sides use frames that only ever grow, so each row costs the same however dense the
    series is: ascending order finds the last row at or before the target, descending order
    the last row (in that order) at or after it. Time and value are looked up as two plain
    columns of one frame; a struct would be copied on every update.
    """
    back, ahead = asc.rangeBetween(_FIRST, -lag_us), desc.rangeBetween(_FIRST, lag_us)
    target = F.col(B.US) - lag_us
    gap_before, gap_after = target - F.last(B.US).over(back), F.last(B.US).over(ahead) - target
    take_before = (gap_before <= tolerance_us) & (gap_before <= gap_after)
    return (F.when(take_before, F.last("_v").over(back))
            .when(gap_after <= tolerance_us, F.last("_v").over(ahead)))


def merged_moments(n1: Column, mean1: Column, m21: Column, n2: Column, mean2: Column, m22: Column):
    """Count, mean and sum of squared deviations of two groups put together."""
    n = n1 + n2
    delta = mean2 - mean1
    mean = F.when(n2 == 0, mean1).when(n1 == 0, mean2).otherwise(mean1 + delta * n2 / F.nullif(n, F.lit(0)))
    m2 = (F.when(n2 == 0, m21).when(n1 == 0, m22)
          .otherwise(m21 + m22 + delta * delta * n1 * n2 / F.nullif(n, F.lit(0))))
    return n, mean, m2


def _block_moments(df: DataFrame, part: list[str], hours: int) -> DataFrame:
    """Running moments from both ends of time blocks as wide as the window.

    A window (t - w, t] is then the tail of one block plus the head of the next, so rolling
    statistics cost the same per row however many readings a window holds.
    """
    block, v = f"_block_{hours}", F.col("_v")
    df = df.withColumn(block, B.bucket_of(F.col(B.US), hours * HOUR_US))
    for side, order in (("head", F.col(B.US)), ("tail", F.col(B.US).desc())):
        frame = Window.partitionBy(*part, block).orderBy(order).rowsBetween(_FIRST, 0)
        df = df.withColumns({f"_{side}_n_{hours}": F.count(v).over(frame),
                             f"_{side}_mean_{hours}": F.avg(v).over(frame),
                             f"_{side}_m2_{hours}": F.var_pop(v).over(frame) * F.count(v).over(frame)})
    return df


def _first_in_window(desc: WindowSpec, hours: int) -> dict[str, Column]:
    """Block and running moments of the oldest reading inside the window."""
    frame = desc.rangeBetween(_FIRST, hours * HOUR_US - 1)
    sources = {"block": f"_block_{hours}", **{m: f"_tail_{m}_{hours}" for m in _MOMENTS}}
    return {f"_first_{name}_{hours}": F.last(column).over(frame) for name, column in sources.items()}


def _joined_moments(hours: int, value: str) -> dict[str, Column]:
    head, first = ({m: F.col(f"_{side}_{m}_{hours}") for m in _MOMENTS} for side in ("head", "first"))
    earlier = F.col(f"_first_block_{hours}") < F.col(f"_block_{hours}")
    n, mean, m2 = merged_moments(head["n"], head["mean"], head["m2"],
                                 F.when(earlier, first["n"]).otherwise(F.lit(0)), first["mean"], first["m2"])
    return {f"rolling_{hours}h_mean_{value}": mean,
            f"rolling_{hours}h_std_{value}": F.when(n > 1, F.sqrt(m2 / (n - 1)))}


def _rolling_by_frames(asc: WindowSpec, hours: int, value: str) -> dict[str, Column]:
    frame = asc.rangeBetween(-hours * HOUR_US + 1, 0)
    return {f"rolling_{hours}h_mean_{value}": F.avg("_v").over(frame),
            f"rolling_{hours}h_std_{value}": F.stddev_samp("_v").over(frame)}


def change_rate(now: Column, before: Column) -> Column:
    """Relative change; undefined when the earlier value is missing or zero."""
    return (now - before) / F.nullif(before, F.lit(0.0))


def _features(df: DataFrame, part: list[str], spec: SeriesSpec, cfg: FeatureConfig, dense: bool,
              lags: bool, rolling: bool, rate: bool) -> DataFrame:
    asc = Window.partitionBy(*part).orderBy(B.US)
    desc = Window.partitionBy(*part).orderBy(F.col(B.US).desc())
    blocks = cfg.rolling_hours if rolling and dense else ()
    for w in blocks:
        df = _block_moments(df, part, w)
    # Everything below shares one ascending and one descending sort.
    columns: dict[str, Column] = {}
    if rate:
        columns[f"{spec.value}_change_rate"] = change_rate(F.col("_v"), F.lag("_v").over(asc))
    if lags:
        for h in cfg.lag_hours:
            columns[f"lag_{h}h_{spec.value}"] = _nearest(asc, desc, h * HOUR_US, cfg.tolerance_us(h))
    if rolling and not dense:
        for w in cfg.rolling_hours:
            columns |= _rolling_by_frames(asc, w, spec.value)
    for w in blocks:
        columns |= _first_in_window(desc, w)
    df = df.withColumns(columns)
    for w in blocks:
        df = df.withColumns(_joined_moments(w, spec.value))
    return df


def feature_names(spec: SeriesSpec, cfg: FeatureConfig, lags=True, rolling=True, rate=True) -> list[str]:
    names = [f"lag_{h}h_{spec.value}" for h in cfg.lag_hours] if lags else []
    if rolling:
        names += [f"rolling_{w}h_{s}_{spec.value}" for w in cfg.rolling_hours for s in ("mean", "std")]
    return names + ([f"{spec.value}_change_rate"] if rate else [])


def add_series_features(df: DataFrame, spec: SeriesSpec = SeriesSpec(), cfg: FeatureConfig = FeatureConfig(),
                        *, lags: bool = True, rolling: bool = True, rate: bool = True,
                        mode: str = "halo", dense: bool = True,
                        only: DataFrame | None = None, edges_from: DataFrame | None = None,
                        edges: DataFrame | None = None) -> DataFrame:
    """Add lag, rolling and change-rate columns to a table with one row per (key, time).

    mode='halo'    time buckets with look-back copies: one exchange on (key, bucket)
    mode='window'  plain windows per key, for tables of many short series
    mode='cells'   cells of at most about ``cfg.cell_rows`` readings, for series with bursts so dense that
                   a day of them does not fit one task (see ``cells``)
    dense          linear-time rolling moments instead of sliding frames
    only           (key, bucket) rows to compute, for an incremental refresh
    edges_from     table to read the bucket edges from (default ``df``); may hold repeats, so
                   the table before the dedupe saves computing the dedupe twice
    edges          the bucket edges themselves, where they are stored
    """
    df = df.dropna(subset=[spec.ts])
    names = feature_names(spec, cfg, lags, rolling, rate)
    if mode == "window":
        framed = df.select("*", times.micros(spec.ts).alias(B.US), B.measured(spec).alias("_v"))
        out = _features(framed, [spec.key], spec, cfg, dense, lags, rolling, rate)
        return out.select(*df.columns, *names)
    if mode == "cells":
        if only is not None:
            raise ValueError("cells are computed for whole series")
        return C.cell_features(df, spec, cfg, cfg.cell_rows).select(*df.columns, *names)
    if mode != "halo":
        raise ValueError(f"unknown mode {mode!r}")

    rows = B.with_halo(df, spec, cfg.bucket_us, cfg.reach_us)
    if rate:
        if edges is None:
            edges = B.bucket_edges(df if edges_from is None else edges_from, spec, cfg.bucket_us)
        rows = rows.unionByName(
            B.carried_rows(edges, spec, cfg.bucket_us, cfg.reach_us, rows.schema[B.PAYLOAD].dataType))
    if only is not None:
        rows = rows.join(only, [spec.key, B.BUCKET], "left_semi")
    # Without a number the planner merges buckets into tasks by their compressed size, of any number of rows.
    tasks = -(-(df if edges_from is None else edges_from).count() // ROWS_PER_TASK)
    if tasks > 1:
        rows = rows.repartition(tasks, spec.key, B.BUCKET)
    out = _features(rows, [spec.key, B.BUCKET], spec, cfg, dense, lags, rolling, rate)
    return out.filter(B.HOME).select(*[F.col(f"{B.PAYLOAD}.{c}").alias(c) for c in df.columns], *names)


def add_lag_features(df: DataFrame, spec: SeriesSpec = SeriesSpec(), cfg: FeatureConfig = FeatureConfig(),
                     **options) -> DataFrame:
    return add_series_features(df, spec, cfg, rolling=False, rate=False, **options)


def add_rolling_features(df: DataFrame, spec: SeriesSpec = SeriesSpec(), cfg: FeatureConfig = FeatureConfig(),
                         **options) -> DataFrame:
    return add_series_features(df, spec, cfg, lags=False, rate=False, **options)


def add_change_rate(df: DataFrame, spec: SeriesSpec = SeriesSpec(), cfg: FeatureConfig = FeatureConfig(),
                    **options) -> DataFrame:
    return add_series_features(df, spec, cfg, lags=False, rolling=False, **options)


def engineer_features(raw: DataFrame, spec: SeriesSpec = SeriesSpec(), cfg: FeatureConfig = FeatureConfig(),
                      *, unique: bool = False, **options) -> DataFrame:
    """Keep-last dedupe, calendar columns, then all series features. Empty in, empty out."""
    base = raw if unique else keep_last(raw, spec)
    if options.get("edges") is None:
        options.setdefault("edges_from", raw)
    return add_series_features(base, spec, cfg, **options).transform(add_time_features, spec.ts)


def refresh_features(raw: DataFrame, changed: DataFrame, spec: SeriesSpec = SeriesSpec(),
                     cfg: FeatureConfig = FeatureConfig(), **options) -> DataFrame:
    """Feature rows of every bucket the ``changed`` rows can affect; ``raw`` already holds them."""
    edges = B.bucket_edges(raw, spec, cfg.bucket_us)
    only = B.touched_buckets(edges, changed, spec, cfg.bucket_us, cfg.reach_us)
    return engineer_features(raw, spec, cfg, only=only, **options)
