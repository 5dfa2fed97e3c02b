"""Additive attributions of next-hour forecasts and the strongest drivers per series."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from seriesforge.operators.lookups import feature_labels
from seriesforge.operators.models import LinearWeights
from seriesforge.operators.trees import TreeNodes

TREE_KINDS = ("random_forest", "boosted_trees")


def linear_attribution(rows: DataFrame, weights: LinearWeights, medians: dict[str, float]) -> DataFrame:
    """coefficient * (value - training median) per feature: (city, position, feature, value, attribution)."""
    parts = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                      (F.lit(w) * (F.col(c) - F.lit(float(medians.get(c) or 0.0)))).alias("attribution"))
             for i, (c, w) in enumerate(zip(weights.columns, weights.coefficients))]
    return rows.select("city", F.inline(F.array(*parts)))


def tree_attribution(rows: DataFrame, nodes: TreeNodes) -> DataFrame:
    """Path-dependent Shapley values; per row they add up to prediction minus ``base``."""
    shipped = nodes.shipped(rows.sparkSession)
    columns = list(nodes.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[columns].to_numpy(dtype=float)
            nodes_here = shipped()
            phi, base = nodes_here.attribute(x)
            yield pd.DataFrame({
                "city": batch["city"].repeat(len(columns)).to_numpy(),
                "position": list(range(len(columns))) * len(batch),
                "feature": columns * len(batch), "value": x.ravel(), "attribution": phi.ravel(),
                "base": base, "prediction": nodes_here.predict(x).repeat(len(columns))})

    return rows.select("city", *columns).mapInPandas(
        run, "city string, position int, feature string, value double, attribution double, "
             "base double, prediction double")


def tree_attribution_sums(rows: DataFrame, nodes: TreeNodes) -> DataFrame:
    """(city, total attribution, base, prediction) of every row, one row out per row in."""
    shipped = nodes.shipped(rows.sparkSession)
    columns = list(nodes.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[columns].to_numpy(dtype=float)
            nodes_here = shipped()
            phi, base = nodes_here.attribute(x)
            yield pd.DataFrame({"city": batch["city"], "total": phi.sum(axis=1), "base": base,
                                "prediction": nodes_here.predict(x)})

    return rows.select("city", *columns).mapInPandas(run, "city string, total double, base double, prediction double")


def top_drivers(attributions: DataFrame, top_n: int = 6) -> DataFrame:
    """Labelled features with the greatest effect per city; equal effects keep feature order."""
    order = Window.partitionBy("city").orderBy(F.abs("attribution").desc(), "position")
    return (feature_labels(attributions).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top_n)
            .select("city", "rank", "feature", "label", "value", "attribution"))


def explain(kind: str, model, rows: DataFrame, medians: dict[str, float], top_n: int = 6) -> DataFrame | None:
    """Top drivers of each row's prediction; a sequence model has no such explanation."""
    if kind.startswith("sequence"):
        return None
    if kind == "ridge":
        return top_drivers(linear_attribution(rows, model, medians), top_n)
    if kind in TREE_KINDS:
        return top_drivers(tree_attribution(rows, model), top_n)
    raise ValueError(f"no explanation for model kind {kind!r}")
