"""Recursive forecasts against a plain step-by-step computation over each history."""

import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import forecast, insights, models, sequences, trees
from seriesforge.plans import catalog

T0 = datetime(2024, 1, 1)
SCHEMA = "city string, timestamp timestamp_ntz, aqi double, ingest_seq bigint"
COLUMNS, MEDIANS = catalog.LINEAR.columns, catalog.MEDIANS


def histories():
    rng = np.random.default_rng(8)
    out = {}
    for name, count, step in (("click", 200, 31), ("hourly", 80, 60), ("sparse", 9, 700), ("single", 1, 1)):
        minutes = np.cumsum(rng.integers(1, 2 * step, count)) if name != "hourly" else np.arange(count) * 60
        out[name] = {T0 + timedelta(minutes=int(m)): float(v) for m, v in zip(minutes, rng.gamma(2, 40, count).round(2))}
    out["zero"] = {T0: 5.0, T0 + timedelta(hours=1): 0.0}
    return out


def naive_row(history, at, city):
    row = {"hour": at.hour, "is_weekend": int(at.weekday() >= 5), "city_click": int(city == "click")}
    for lag, tol in ((1, 0.25), (3, 0.6), (24, 4.8)):
        target = at - timedelta(hours=lag)
        near = sorted((abs((t - target).total_seconds()), t) for t in history
                      if abs((t - target).total_seconds()) <= tol * 3600)
        row[f"lag_{lag}h_aqi"] = history[near[0][1]] if near else None
    for w in (3, 24):
        inside = [v for t, v in history.items() if at - timedelta(hours=w) < t <= at]
        row[f"rolling_{w}h_mean_aqi"] = np.mean(inside) if inside else None
        row[f"rolling_{w}h_std_aqi"] = np.std(inside) if len(inside) > 1 else None
    before = row["lag_1h_aqi"]
    row["aqi_change_rate"] = (history[max(history)] - before) / before if before else None
    return [MEDIANS[c] if row[c] is None else row[c] for c in COLUMNS]


def naive_forecast(history, city, horizon, predict):
    history, last, out = dict(history), max(history), []
    for k in range(1, horizon + 1):
        at = last + timedelta(hours=k)
        history[at] = max(predict(np.array(naive_row(history, at, city), dtype=float)), 0.0)
        out.append(history[at])
    return out


@pytest.fixture(scope="module")
def inputs(spark):
    rows = [(c, t, v, i) for c, h in histories().items() for i, (t, v) in enumerate(h.items())]
    return forecast.forecast_inputs(spark.createDataFrame(rows, SCHEMA)).cache()


@pytest.mark.parametrize("engine", ["fold", "batch"])
def test_linear_forecast_matches_step_by_step(inputs, engine):
    w = np.array(catalog.LINEAR.coefficients)
    predict = lambda x: x @ w + catalog.LINEAR.intercept
    steps = (forecast.recursive_linear_steps(inputs, catalog.LINEAR, MEDIANS) if engine == "fold"
             else forecast.recursive_batch_steps(inputs, forecast.dense(predict, COLUMNS), COLUMNS, MEDIANS))
    got = {}
    for r in steps.orderBy("city", "step").collect():
        got.setdefault(r.city, []).append(r.value)
    for city, history in histories().items():
        np.testing.assert_allclose(got[city], naive_forecast(history, city, 72, predict), atol=1e-8, err_msg=city)


def test_next_hour_row_is_the_first_step_input(inputs):
    rows = {r.city: r for r in forecast.next_hour_features(inputs, COLUMNS, MEDIANS).collect()}
    for city, history in histories().items():
        want = naive_row(history, max(history) + timedelta(hours=1), city)
        np.testing.assert_allclose([rows[city][c] for c in COLUMNS], want, atol=1e-9, err_msg=city)


def test_negative_forecasts_are_clamped_and_flags_use_unrounded_values(inputs):
    low = models.LinearWeights(("hour",), (0.0,), -5.0)
    assert {r.predicted_aqi for r in forecast.recursive_forecast_linear(inputs, low, {}, 3).collect()} == {0.0}
    edge = models.LinearWeights(("hour",), (0.0,), 149.96)
    row = forecast.recursive_forecast_linear(inputs, edge, {}, 1).first()
    assert row.predicted_aqi == 150.0 and not row.is_hazardous and row.aqi_category == "Unhealthy for Sensitive Groups"


def test_history_is_bounded_per_series(spark):
    dense = [("a", T0 + timedelta(seconds=s), float(s % 50), s) for s in range(0, 40_000, 4)]
    row = forecast.forecast_inputs(spark.createDataFrame(dense, SCHEMA)).first()
    assert [len(row[c]) for c in ("lag_1", "lag_3", "lag_24", "n_3", "n_24")] == [1, 3, 24, 3, 24]
    assert row.n_24[0] == len(dense)


def test_sequence_forecast_matches_step_by_step(spark):
    data = {c: h for c, h in histories().items()}
    rows = [(c, t, v, i) for c, h in data.items() for i, (t, v) in enumerate(h.items())]
    clean = spark.createDataFrame(rows, SCHEMA)
    seeds = sequences.seed_windows(insights.recent_history(clean))
    steps = forecast.sequence_steps(seeds, sequences.fit_scalers(clean), catalog.SEQ_WEIGHTS, catalog.SEQ_INTERCEPT,
                                    catalog.SEQ_CITY)
    got = {}
    for r in steps.orderBy("city", "step").collect():
        got.setdefault(r.city, []).append(r.value)
    assert set(got) == {"click", "hourly"}     # the others have fewer than 24 recent readings
    for city, values in got.items():
        series = list(data[city].values())
        lo, hi = min(series), max(series)
        window = [(v - lo) / (hi - lo) for v in series[-24:]]
        for value in values:
            score = np.dot(window[-24:], catalog.SEQ_WEIGHTS) + catalog.SEQ_INTERCEPT + catalog.SEQ_CITY.get(city, 0)
            window.append(min(max(score, 0), 1))
            assert value == pytest.approx(max(window[-1] * (hi - lo) + lo, 0))


def test_sequences_skip_gaps_and_allow_jitter(spark):
    minutes = [60 * i for i in range(25)]
    def build(ms):
        rows = [("a", T0 + timedelta(minutes=m), float(i), i) for i, m in enumerate(ms)]
        return sequences.build_sequences(spark.createDataFrame(rows, SCHEMA)).collect()
    whole = build(minutes)
    assert len(whole) == 1 and whole[0].x == [float(i) for i in range(24)] and whole[0].y == 24.0
    late = 76 - 1 / 60                                   # 75 min 59 s still counts as 75 minutes
    assert len(build(minutes[:24] + [minutes[23] + late])) == 1
    assert len(build(minutes[:24] + [minutes[23] + 76])) == 0
    assert len(build(minutes[:24] + [minutes[23] + 45])) == 1
    assert len(build(minutes[:24] + [minutes[23] + 44])) == 0
    assert build(minutes[:24]) == []


def test_scaling_constant_series_and_missing_scaler(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 1.0), ("b", 3.0)], "city string, aqi double")
    scalers = sequences.fit_scalers(df)
    scaled = sequences.scale(df, scalers, "aqi", "s")
    assert sorted((r.city, r.s) for r in scaled.collect()) == [("a", 0.0), ("a", 0.0), ("b", 0.0), ("b", 1.0)]
    assert sorted(r.back for r in sequences.unscale(scaled, scalers, "s", "back").collect()) == [1.0, 3.0, 5.0, 5.0]
    assert [r.city for r in sequences.missing_scalers(df, scalers.filter("city = 'b'")).collect()] == ["a"]


def grown_trees(columns, numeric, rng, count=30, depth=7):
    """Random trees over all columns, in node arrays."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def grow(level):
        at = len(feature)
        for part in (feature, threshold, left, right, value):
            part.append(-1)
        value[at], threshold[at] = float(rng.normal(60, 30)), 0.0
        if level < depth:
            f = int(rng.integers(len(columns)))
            feature[at] = f
            threshold[at] = 0.5 if f >= numeric else float(rng.normal(40, 20))
            left[at] = grow(level + 1)
            right[at] = grow(level + 1)
        return at

    for _ in range(count):
        roots.append(grow(0))
    return trees.TreeNodes(tuple(columns), *(np.array(x) for x in (roots, feature, threshold, left, right, value, value)),
                           np.full(count, 1 / count))


def many_inputs(spark, series):
    arrays = {f"lag_{n}": n for n in (1, 3, 24)}
    lists = [F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: (F.col("id") + k) % 97 + 0.5).alias(c) for c, n in arrays.items()]
    for w in (3, 24):
        ks = F.sequence(F.lit(1), F.lit(w))
        lists += [F.transform(ks, lambda k: (F.lit(w) - k).cast("bigint")).alias(f"n_{w}"),
                  F.transform(ks, lambda k: (F.col("id") % 50).cast("double")).alias(f"mean_{w}"),
                  F.transform(ks, lambda k: F.lit(2.0) * k).alias(f"m2_{w}")]
    return spark.range(series).select(F.concat(F.lit("s"), "id").alias("city"), (F.col("id") * 3_600_000_000).alias("last_us"),
                                      (F.col("id") % 80).cast("double").alias("last_v"), *lists)


def test_trees_read_a_series_own_indicator_as_the_whole_matrix_would(spark):
    rng = np.random.default_rng(5)
    columns = (*[c for c in COLUMNS if not c.startswith("city_")], *(f"city_s{i}" for i in range(140)))
    nodes = grown_trees(columns, len(COLUMNS) - 1, rng)
    inputs = many_inputs(spark, 150)                     # the model doesn't know the last ten
    own = forecast.recursive_batch_steps(inputs, lambda x, i: nodes.predict(x, i), columns, MEDIANS, 30)
    whole = forecast.recursive_batch_steps(inputs, forecast.dense(nodes.predict, columns), columns, MEDIANS, 30)
    read = lambda df: {(r.city, r.step): r.value for r in df.collect()}
    got = read(own)
    assert got == read(whole) and len(got) == 4500 and len(set(got.values())) > 200


def test_many_series_cost_in_proportion(spark):
    """With an indicator a series, 16 times the series take about 16 times as long, not 256 times."""
    rng = np.random.default_rng(6)

    def seconds(series):
        columns = (*[c for c in COLUMNS if not c.startswith("city_")], *(f"city_s{i}" for i in range(series)))
        nodes = grown_trees(columns, len(COLUMNS) - 1, rng, count=10, depth=5)
        steps = forecast.recursive_forecast_trees(many_inputs(spark, series), nodes, MEDIANS, 6)
        start = time.perf_counter()
        assert steps.count() == 6 * series
        steps.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(100)
    assert seconds(48_000) < 40 * max(seconds(3_000), 0.5)
