import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.functions import times
from seriesforge.operators import selection


@pytest.mark.parametrize("shape", ["hot", "constant", "clustered"])
def test_exact_median(spark, shape):
    rng = np.random.default_rng(7)
    rows = []
    for key, n in (("a", 3001), ("b", 40), ("c", 1), ("d", 2)):
        values = {"hot": rng.normal(size=n), "constant": np.full(n, 4.0),
                  "clustered": np.where(rng.random(n) < 0.9, 1.0, rng.normal(size=n) * 1e6)}[shape]
        rows += [(key, float(v)) for v in values]
    df = spark.createDataFrame(rows + [("a", None), ("e", None)], "k string, v double")
    got = {r.k: r["median"] for r in selection.exact_median(df, ["k"], "v").collect()}
    want = {k: statistics.median([v for kk, v in rows if kk == k]) for k in "abcd"}
    assert got == pytest.approx(want)


def test_bits_sort_like_the_numbers(spark):
    values = [float("-inf"), -1e308, -2.0, -1.5, -5e-324, 0.0, 5e-324, 1e-310, 2.0**-1022, 0.1, 1.0, 1.0000000000000002, 3.0, 1e308, float("inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(-0.0,)], "v double")
    got = sorted((r.s, r.v) for r in df.select(selection.sortable(F.col("v")).alias("s"), "v").collect())
    assert [v for _, v in got] == sorted(values + [-0.0]) and len({s for s, _ in got}) == len(values)


def test_medians_of_values_that_differ_in_the_last_bits(spark):
    rng = np.random.default_rng(3)
    close = [float(np.nextafter(1.0, 2.0)) for _ in range(3)] + [1.0] * 3
    groups = {"close": close, "signs": [-5e-324, 0.0, -0.0, 5e-324], "wide": [float(v) for v in 10.0 ** rng.uniform(-300, 300, 101)],
              "ends": [float("-inf"), float("inf"), 2.0], "gap": [1.0, 1.0, 1e300, 1e300], "nan": [float("nan"), 4.0, 8.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: r["median"] for r in selection.exact_median(df, ["k"], "v").collect()}
    assert got == {k: statistics.median([v for v in vs if v == v]) for k, vs in groups.items()}


def test_a_hot_group_sends_counts_not_values(spark):
    n = 400_000
    v = (F.pmod(F.col("id") * 7919, F.lit(n)) / 7 - 20_000).alias("v")   # all distinct
    df = spark.range(n).select(F.lit("hot").alias("k"), v).unionByName(spark.range(5).select(F.lit("cold").alias("k"), F.col("id").cast("double").alias("v")))
    rows = df.select("k", selection.sortable(F.col("v")).alias("_s"), F.col("v").alias("_v"))
    assert selection.digit_counts(rows, ["k"], 0).count() < 1000
    assert selection.digit_counts(rows.filter("k = 'hot'"), ["k"], 16).count() <= 1 << 16
    got = {r.k: r["median"] for r in selection.exact_median(df, ["k"], "v").collect()}
    assert got == {"hot": statistics.median(i / 7 - 20_000 for i in range(n)), "cold": 2.0}


def test_medians_of_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (10.0, 6.0)], "x double, y double")
    got = {r.column_name: r["median"] for r in selection.exact_medians(df, ["x", "y"]).collect()}
    assert got == {"x": 2.0, "y": 5.5}


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("fraction", [0.2, 0.5, 0.0, 1.0])
def test_chronological_cut(spark, keys, fraction):
    rng = np.random.default_rng(11)
    t0 = datetime(2024, 1, 1)
    rows = []
    for key, n in (("a", 500), ("b", 7), ("c", 1)):
        for _ in range(n):
            # Many rows of one second, to make the cut fall between equal times.
            at = t0 + timedelta(seconds=int(rng.integers(0, 40) ** 2 * 900), microseconds=int(rng.integers(0, 3)))
            rows.append((key, at if rng.random() > 0.05 else None, len(rows)))
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int")
    got = {r.i: r.is_train for r in selection.chronological_cut(df, keys, times.micros("t"), ["k", "i"], fraction).collect()}
    want = {}
    for group in ([[r for r in rows if r[0] == k] for k in "abc"] if keys else [rows]):
        ordered = sorted(group, key=lambda r: (r[1] is None, r[1] or t0, r[0], r[2]))
        cut = int(len(ordered) * (1 - fraction))
        want |= {r[2]: pos < cut for pos, r in enumerate(ordered)}
    assert got == want


def test_rows_without_a_time_are_training_rows_where_the_others_do_not_suffice(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0 + timedelta(hours=i) if i < 5 else None, i) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int")
    for keys in ([], ["k"]):
        got = {r.i: r.is_train for r in selection.chronological_cut(df, keys, times.micros("t"), ["k", "i"], 0.2).collect()}
        assert got == {i: i < 8 for i in range(10)}


def test_ordinals(spark):
    rng = np.random.default_rng(2)
    rows = [("hot" if i % 3 else str(i % 7), int(rng.integers(0, 50)), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    got = {r.i: r["_pos"] for r in selection.ordinals(df, ["g"], ["v", "i"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        want |= {r[2]: n for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: r[1:]))}
    assert got == want


def test_cut_of_empty_table(spark):
    df = spark.createDataFrame([], "k string, t timestamp_ntz, i int")
    assert selection.chronological_cut(df, [], times.micros("t"), ["i"], 0.2).count() == 0
