"""Recursive multi-step forecasts for every series in one job.

Step k reads values up to step k-1, so a series is sequential, but series are independent.
What the measured readings contribute to each step (nearest value per lag, moments per
window) is aggregated by Spark beforehand, so a series enters the recursion as one row of
fixed size however densely it was sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from seriesforge.config import FORECAST_HORIZON, HISTORY_HOURS, HOUR_US, FeatureConfig, SeriesSpec
from seriesforge.functions import scalar, times
from seriesforge.operators.features import merged_moments
from seriesforge.operators.levels import LEVEL
from seriesforge.operators.models import LinearWeights
from seriesforge.operators.trees import TreeNodes
from seriesforge.operators.quality import keep_last, valid_rows
from seriesforge.session import materialize, settle

_SPEC, _CFG = SeriesSpec(), FeatureConfig()


def forecast_inputs(readings: DataFrame, cfg: FeatureConfig = _CFG, spec: SeriesSpec = _SPEC,
                    history_hours: int = HISTORY_HOURS) -> DataFrame:
    """One row per key: last time and value, plus per step what the measured history gives.

    lag_L[k-1] is the measured value nearest to L hours before step k (k <= L; later steps
    read a forecast exactly L hours back). n_w, mean_w, m2_w [k-1] describe the measured
    readings still inside a w-hour window at step k. Repeats of a time may still be in: the newest
    time of each key comes first, then the few hours that matter, and only those are deduplicated.
    """
    key, us = spec.key, times.micros(spec.ts)
    valid = valid_rows(readings, spec).withColumn("us", us)
    last = settle(valid.groupBy(key).agg(F.max("us").alias("last_us")), "newest")
    deepest = min(cfg.reach_us, history_hours * HOUR_US)
    age = F.col("last_us") - F.col("us")
    recent = valid.join(last, key).filter(age <= deepest)
    if spec.seq in readings.columns:
        recent = keep_last(recent, spec)
    aged = materialize(recent.select(key, "us", F.col(spec.value).alias("v"), "last_us", age.alias("age")), "recent")
    newest = settle(aged.groupBy(key).agg(F.max("last_us").alias("last_us"), F.max_by("v", "us").alias("last_v")), "newest")
    steps = max([*cfg.lag_hours, *(w - 1 for w in cfg.rolling_hours)])
    # A reading matters for the steps at which it is near a lag target or inside a window.
    last_step = F.greatest(
        *[F.floor((lag * HOUR_US + cfg.tolerance_us(lag) - F.col("age")) / HOUR_US) for lag in cfg.lag_hours],
        *[F.ceil((w * HOUR_US - F.col("age")) / HOUR_US) - 1 for w in cfg.rolling_hours])
    last_step = F.least(last_step, F.lit(steps))
    stepped = (aged.filter(last_step >= 1)
               .withColumn("k", F.explode(F.sequence(F.lit(1), last_step.cast("int")))))
    aggs: list[Column] = []
    for lag in cfg.lag_hours:
        offset = (lag - F.col("k")) * F.lit(HOUR_US) - F.col("age")
        distance = F.abs(offset)
        # Order by distance, the earlier reading first.
        rank = F.when((distance <= cfg.tolerance_us(lag)) & (F.col("k") <= lag),
                      distance * 2 + F.when(offset > 0, 1).otherwise(0))
        aggs.append(F.min_by("v", rank).alias(f"lag_{lag}"))
    for w in cfg.rolling_hours:
        v = F.when(F.col("k") * F.lit(HOUR_US) < w * HOUR_US - F.col("age"), F.col("v"))
        aggs += [F.count(v).alias(f"n_{w}"), F.avg(v).alias(f"mean_{w}"),
                 (F.var_pop(v) * F.count(v)).alias(f"m2_{w}")]
    per_step = stepped.groupBy(key, "k").agg(*aggs)
    stats = [c for c in per_step.columns if c not in (key, "k")]
    # At most ``steps`` rows per key are put together here.
    packed = per_step.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("k", F.struct(*stats)))).alias("_m"))

    def series(name: str, length: int) -> Column:
        empty = F.lit(0).cast("bigint") if name.startswith("n_") else F.lit(None).cast("double")
        at = F.transform(F.sequence(F.lit(1), F.lit(length)),
                         lambda k: F.coalesce(F.try_element_at("_m", k)[name], empty))
        return at.alias(name)

    arrays = [series(f"lag_{lag}", lag) for lag in cfg.lag_hours]
    arrays += [series(f"{s}_{w}", w) for w in cfg.rolling_hours for s in ("n", "mean", "m2")]
    return newest.join(packed, key, "left").select(F.col(key).alias("city"), "last_us", "last_v", *arrays)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: a one-element transform acts as a let."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _no_moments() -> Column:
    return F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))


def _entered(a: Column, x: Column) -> Column:
    """Count, mean and sum of squared deviations with one more value."""
    n = a["n"] + 1
    mean = a["mean"] + (x - a["mean"]) / n
    return F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + (x - a["mean"]) * (x - mean)).alias("m2"))


def _left(a: Column, x: Column) -> Column:
    """The same without one of its values."""
    n = a["n"] - 1
    mean = F.when(n > 0, a["mean"] - (x - a["mean"]) / n).otherwise(F.lit(0.0))
    m2 = F.when(n > 1, F.greatest(a["m2"] - (x - a["mean"]) * (x - mean), F.lit(0.0))).otherwise(F.lit(0.0))
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def _empty_fold(cfg: FeatureConfig) -> Column:
    """What the fold carries: the forecasts so far, and for each window the moments of those inside it."""
    return F.struct(F.array().cast("array<double>").alias("path"), *[_no_moments().alias(f"new_{w}") for w in cfg.rolling_hours])


def _step_state(k: Column, fold: Column, cfg: FeatureConfig) -> Column:
    """Everything step ``k`` needs from the forecasts of steps 1..k-1 and the measured arrays."""
    predicted = fold["path"]
    parts = [F.when(k == 1, F.col("last_v")).otherwise(F.get(predicted, k - 2)).alias("newest")]
    for lag in cfg.lag_hours:
        parts.append(F.when(k <= lag, F.get(F.col(f"lag_{lag}"), k - 1)).otherwise(
            F.get(predicted, k - lag - 1)).alias(f"lag_{lag}"))
    for w in cfg.rolling_hours:
        old = F.struct(*[F.get(F.col(f"{name}_{w}"), k - 1).alias(name) for name in ("n", "mean", "m2")])
        parts.append(_bound(F.struct(old.alias("old"), fold[f"new_{w}"].alias("new")), _together).alias(f"window_{w}"))
    return F.struct(*parts)


def _together(both: Column) -> Column:
    """Moments of the measured readings and the forecasts inside a window."""
    old, new = both["old"], both["new"]
    n, mean, m2 = merged_moments(F.coalesce(old["n"], F.lit(0).cast("bigint")), old["mean"], old["m2"],
                                 new["n"], new["mean"], new["m2"])
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def _grown(fold: Column, k: Column, value: Column, cfg: FeatureConfig) -> Column:
    """The fold after step ``k``: its value enters every window, and the one that is w - 1 steps older leaves.

    The ring of a window is the path itself, so a step costs the same however long a window is.
    """
    parts = [F.concat(fold["path"], F.array(value)).alias("path")]
    for w in cfg.rolling_hours:
        if w == 1:  # a window of one hour never holds a forecast
            parts.append(_no_moments().alias("new_1"))
            continue
        kept = F.when(k >= w, _left(fold[f"new_{w}"], F.get(fold["path"], k - w))).otherwise(fold[f"new_{w}"])
        parts.append(_bound(kept, lambda a: _entered(a, value)).alias(f"new_{w}"))
    return F.struct(*parts)


def _feature_row(k: Column, state: Column, cfg: FeatureConfig) -> dict[str, Column]:
    """The feature row of step ``k`` before median fill.

    Serving differs from training on purpose: population deviation, a window without the value
    to be forecast, and a change rate from the newest value against the one-hour lag.
    """
    at = times.from_micros(F.col("last_us") + k.cast("bigint") * F.lit(HOUR_US))
    row = {name: c.cast("double") for name, c in times.calendar(at).items()}
    row["is_stale"] = F.lit(0.0)
    for lag in cfg.lag_hours:
        row[f"lag_{lag}h_aqi"] = state[f"lag_{lag}"]
    for w in cfg.rolling_hours:
        inside = state[f"window_{w}"]
        row[f"rolling_{w}h_mean_aqi"] = F.when(inside["n"] > 0, inside["mean"])
        row[f"rolling_{w}h_std_aqi"] = F.when(inside["n"] > 1, F.sqrt(inside["m2"] / inside["n"]))
    before = state[f"lag_{1}"] if 1 in cfg.lag_hours else F.lit(None).cast("double")
    row["aqi_change_rate"] = (state["newest"] - before) / F.nullif(before, F.lit(0.0))
    return row


def _with_level(row: dict[str, Column], inputs: DataFrame) -> dict[str, Column]:
    """The series' level, where the inputs carry one, is the same at every step."""
    return row | {LEVEL: F.col(LEVEL)} if LEVEL in inputs.columns else row


def filled_row(row: dict[str, Column], columns, medians: dict[str, float]) -> dict[str, Column]:
    """Fitted columns only; missing or unknown ones take the training median, else 0."""
    def value(c: str) -> Column:
        if c.startswith("city_"):
            return (F.col("city") == c.removeprefix("city_")).cast("double")
        fill = F.lit(float(medians.get(c) or 0.0))
        return F.coalesce(row[c], fill) if c in row else fill
    return {c: value(c) for c in columns}


def next_hour_features(inputs: DataFrame, columns, medians: dict[str, float],
                       cfg: FeatureConfig = _CFG) -> DataFrame:
    """The exact model input of the first forecast hour, one column per feature."""
    staged = inputs.withColumn("_state", _step_state(F.lit(1), _empty_fold(cfg), cfg))
    row = filled_row(_with_level(_feature_row(F.lit(1), F.col("_state"), cfg), inputs), columns, medians)
    at = times.from_micros(F.col("last_us") + HOUR_US)
    return staged.select("city", at.alias("timestamp"), *[c.alias(n) for n, c in row.items()])


def _spread(inputs: DataFrame) -> DataFrame:
    """A row is small but costs a whole recursion, so rows are dealt out over all cores.

    Partition sizes in bytes would put every series into a few tasks.
    """
    spark = inputs.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return inputs.repartition(width, "city")


def _presented(steps: DataFrame) -> DataFrame:
    """(city, timestamp, step, rounded forecast, category, hazard); flags use the unrounded value."""
    v = F.col("value")
    return steps.select(
        "city", times.from_micros(F.col("last_us") + F.col("step") * F.lit(HOUR_US)).alias("timestamp"), "step",
        scalar.half_even_tenths(v).alias("predicted_aqi"), scalar.forecast_category(v).alias("aqi_category"),
        scalar.is_hazardous(v).alias("is_hazardous"))


def _with_own(rows: DataFrame, city_weights: dict[str, float]) -> DataFrame:
    """Each series with the weight of its own indicator: a lookup, so any number of series fits the plan."""
    if not city_weights:
        return rows.withColumn("_own", F.lit(0.0))
    known = rows.sparkSession.createDataFrame([(c, float(w)) for c, w in city_weights.items()], "city string, _own double")
    return rows.join(known, "city", "left").withColumn("_own", F.coalesce("_own", F.lit(0.0)))


def indicator_columns(columns) -> dict[str, int]:
    """The column of each series' own indicator."""
    return {c.removeprefix("city_"): j for j, c in enumerate(columns) if c.startswith("city_")}


def own_columns(cities: np.ndarray, indicators: dict[str, int]) -> np.ndarray:
    """The column of each row's indicator, -1 where the model knows none."""
    return np.fromiter((indicators.get(c, -1) for c in cities), dtype=np.int64, count=len(cities))


def dense(predict, columns):
    """A predictor over the whole matrix as one over (numeric columns, own indicator); for few series."""
    def spread(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        whole = np.zeros((len(x), len(columns)))
        whole[:, :x.shape[1]] = x
        known = np.flatnonzero(own >= 0)
        whole[known, own[known]] = 1.0
        return predict(whole)

    return spread


# Series that advance together: a forest of 200 trees holds some numbers per series and tree.
BATCH_SERIES = 4_000


def recursive_linear_steps(inputs: DataFrame, weights: LinearWeights, medians: dict[str, float],
                           horizon: int = FORECAST_HORIZON, cfg: FeatureConfig = _CFG) -> DataFrame:
    """Unrounded forecasts of a linear model: one fold over the steps, no Python in the tasks."""
    inputs, weights = _with_own(inputs, weights.city_weights), weights.numeric()

    def advance(fold: Column, k: Column) -> Column:
        def score(state: Column) -> Column:
            row = _with_level(_feature_row(k, state, cfg), inputs)
            return weights.predict(filled_row(row, weights.columns, medians)) + F.col("_own")
        value = F.greatest(_bound(_step_state(k, fold, cfg), score), F.lit(0.0))
        return _bound(value, lambda v: _grown(fold, k, v, cfg))

    inputs = _spread(inputs)
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), _empty_fold(cfg), advance, lambda fold: fold["path"])
    return (inputs.select("city", "last_us", F.posexplode(path).alias("_p", "value"))
            .withColumn("step", (F.col("_p") + 1).cast("int")).drop("_p"))


def recursive_forecast_linear(inputs, weights, medians, horizon=FORECAST_HORIZON, cfg=_CFG) -> DataFrame:
    return _presented(recursive_linear_steps(inputs, weights, medians, horizon, cfg))


def _batch_matrix(batch: pd.DataFrame, k: int, predicted: np.ndarray, columns, medians, cfg) -> np.ndarray:
    """``step_features`` for a batch of series at once: (series, numeric features), NaN already filled."""
    n = len(batch)
    at = batch["last_us"].to_numpy() + k * HOUR_US
    day = at // (24 * HOUR_US)
    row: dict[str, np.ndarray] = {
        "hour": at // HOUR_US % 24, "day_of_week": (day + 3) % 7,
        "month": day.astype("datetime64[D]").astype("datetime64[M]").astype(int) % 12 + 1,
        "is_weekend": (day + 3) % 7 >= 5, "is_stale": np.zeros(n)}
    for lag in cfg.lag_hours:
        row[f"lag_{lag}h_aqi"] = (np.array([a[k - 1] for a in batch[f"lag_{lag}"]], dtype=float) if k <= lag
                                  else predicted[:, k - lag - 1])
    for w in cfg.rolling_hours:
        inside = predicted[:, max(0, k - w):k - 1]
        n2 = inside.shape[1]
        stats = [np.array([a[k - 1] for a in batch[f"{s}_{w}"]], dtype=float) if k <= w else np.zeros(n)
                 for s in ("n", "mean", "m2")]
        n1, mean1, m21 = (np.nan_to_num(s) for s in stats)
        mean2 = inside.mean(axis=1) if n2 else np.zeros(n)
        m22 = ((inside - mean2[:, None]) ** 2).sum(axis=1)
        size = n1 + n2
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = (n1 * mean1 + n2 * mean2) / size
            m2 = m21 + m22 + (mean2 - mean1) ** 2 * n1 * n2 / size
            row[f"rolling_{w}h_mean_aqi"] = mean
            row[f"rolling_{w}h_std_aqi"] = np.where(size > 1, np.sqrt(m2 / size), np.nan)
    if LEVEL in batch:
        row[LEVEL] = batch[LEVEL].to_numpy(dtype=float)
    newest = batch["last_v"].to_numpy(dtype=float) if k == 1 else predicted[:, k - 2]
    before = row.get("lag_1h_aqi", np.full(n, np.nan))
    with np.errstate(divide="ignore", invalid="ignore"):
        row["aqi_change_rate"] = np.where(before == 0, np.nan, (newest - before) / before)
    out = np.empty((n, len(columns)))
    for j, c in enumerate(columns):
        fill = float(medians.get(c) or 0.0)
        values = np.asarray(row[c], dtype=float) if c in row else np.full(n, fill)
        out[:, j] = np.where(np.isnan(values), fill, values)
    return out


def recursive_batch_steps(inputs: DataFrame, predict, columns, medians: dict[str, float],
                          horizon: int = FORECAST_HORIZON, cfg: FeatureConfig = _CFG) -> DataFrame:
    """Unrounded forecasts of any batch predictor. Whole Arrow batches of series advance together.

    ``predict`` takes the numeric columns and the column of each series' own indicator, so work and
    memory grow with the series, not with series times indicators.
    """
    numeric = tuple(c for c in columns if not c.startswith("city_"))
    if tuple(columns[:len(numeric)]) != numeric:
        raise ValueError("the indicators of the series have to come last")
    shared = inputs.sparkSession.sparkContext.broadcast(indicator_columns(columns))
    medians = {c: medians[c] for c in numeric if c in medians}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[at:at + BATCH_SERIES] for whole in batches for at in range(0, len(whole), BATCH_SERIES)):
            predicted = np.empty((len(batch), horizon))
            own = own_columns(batch["city"].to_numpy(), shared.value)
            for k in range(1, horizon + 1):
                x = _batch_matrix(batch, k, predicted, numeric, medians, cfg)
                predicted[:, k - 1] = np.maximum(predict(x, own), 0.0)
            yield pd.DataFrame({
                "city": np.repeat(batch["city"].to_numpy(), horizon),
                "last_us": np.repeat(batch["last_us"].to_numpy(), horizon),
                "value": predicted.ravel(),
                "step": np.tile(np.arange(1, horizon + 1, dtype="int32"), len(batch))})

    return _spread(inputs).mapInPandas(run, "city string, last_us bigint, value double, step int")


def recursive_forecast_trees(inputs: DataFrame, nodes: TreeNodes, medians: dict[str, float],
                             horizon: int = FORECAST_HORIZON, cfg: FeatureConfig = _CFG) -> DataFrame:
    shipped = nodes.shipped(inputs.sparkSession)
    steps = recursive_batch_steps(inputs, lambda x, own: shipped().predict(x, own), nodes.columns, medians, horizon, cfg)
    return _presented(steps)


def sequence_steps(seeds: DataFrame, scalers: DataFrame, weights: list[float], intercept: float,
                   city_weights: dict[str, float], horizon: int = FORECAST_HORIZON) -> DataFrame:
    """Recursive forecast from the last scaled values of each series, folded inside Catalyst."""
    length = len(weights)
    span = F.when(F.col("hi") == F.col("lo"), 1.0).otherwise(F.col("hi") - F.col("lo"))
    own = F.lit(float(intercept)) + F.col("_own")
    factors = F.array(*[F.lit(float(w)) for w in weights])

    def advance(window: Column, _k: Column) -> Column:
        recent = F.slice(window, F.size(window) - length + 1, length)
        score = F.aggregate(F.zip_with(recent, factors, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
        return F.concat(window, F.array(scalar.clamp(score + own, 0.0, 1.0)))

    scaled = _with_own(seeds.join(scalers, "city"), city_weights).withColumn(
        "_x", F.transform("x", lambda v: (v - F.col("lo")) / span))
    path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("_x"), advance)
    return (scaled.select("city", "last_us", "lo", span.alias("_span"),
                          F.posexplode(F.slice(path, length + 1, horizon)).alias("_p", "_s"))
            .select("city", "last_us", scalar.clamp(F.col("_s") * F.col("_span") + F.col("lo"), 0.0).alias("value"),
                    (F.col("_p") + 1).cast("int").alias("step")))


def sequence_forecast(seeds, scalers, weights, intercept, city_weights, horizon=FORECAST_HORIZON) -> DataFrame:
    return _presented(sequence_steps(seeds, scalers, weights, intercept, city_weights, horizon))


def sequence_batch_steps(seeds: DataFrame, scalers: DataFrame, predict, cities: list[str],
                         horizon: int = FORECAST_HORIZON) -> DataFrame:
    """The same recursion for any batch predictor over (window, indicator of the city).

    ``predict`` takes the window's columns and the column of each series' indicator; the indicators
    come after the window.
    """
    shared = seeds.sparkSession.sparkContext.broadcast({c: j for j, c in enumerate(cities)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[at:at + BATCH_SERIES] for whole in batches for at in range(0, len(whole), BATCH_SERIES)):
            lo = batch["lo"].to_numpy()[:, None]
            span = np.where(batch["hi"] == batch["lo"], 1.0, batch["hi"] - batch["lo"])[:, None]
            window = (np.array(batch["x"].tolist(), dtype=float).reshape(len(batch), -1) - lo) / span
            length = window.shape[1]
            own = own_columns(batch["city"].to_numpy(), shared.value)
            own = np.where(own >= 0, own + length, -1)
            for _ in range(horizon):
                score = predict(window[:, -length:], own)
                window = np.hstack([window, np.clip(score, 0.0, 1.0)[:, None]])
            real = np.maximum(window[:, length:] * span + lo, 0.0)
            yield pd.DataFrame({
                "city": np.repeat(batch["city"].to_numpy(), horizon),
                "last_us": np.repeat(batch["last_us"].to_numpy(), horizon), "value": real.ravel(),
                "step": np.tile(np.arange(1, horizon + 1, dtype="int32"), len(batch))})

    rows = _spread(seeds.join(scalers, "city").select("city", "last_us", "x", "lo", "hi"))
    return rows.mapInPandas(run, "city string, last_us bigint, value double, step int")


def sequence_forecast_trees(seeds: DataFrame, scalers: DataFrame, nodes: TreeNodes, cities: list[str],
                            horizon: int = FORECAST_HORIZON) -> DataFrame:
    shipped = nodes.shipped(seeds.sparkSession)
    return _presented(sequence_batch_steps(seeds, scalers, lambda x, own: shipped().predict(x, own), cities, horizon))
