"""Regressors on pyspark.ml, their comparison, and error metrics."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from seriesforge.config import ModelConfig
from seriesforge.operators import matrix as M
from seriesforge.operators.boosting import barrier_slots, fit_rounds
from seriesforge.operators.forests import fit_forest
from seriesforge.session import settle, shared_dir

PREDICTION = "prediction"


@dataclass(frozen=True)
class LinearWeights:
    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    @classmethod
    def of(cls, model, columns) -> LinearWeights:
        return cls(tuple(columns), tuple(float(c) for c in model.coefficients), float(model.intercept))

    @property
    def city_weights(self) -> dict[str, float]:
        return {c.removeprefix("city_"): w for c, w in zip(self.columns, self.coefficients) if c.startswith("city_")}

    def numeric(self) -> LinearWeights:
        """Without the city indicators, whose weights are looked up by city instead."""
        own = [(c, w) for c, w in zip(self.columns, self.coefficients) if not c.startswith("city_")]
        return LinearWeights(tuple(c for c, _ in own), tuple(w for _, w in own), self.intercept)

    def predict(self, features: dict[str, Column]) -> Column:
        out = F.lit(self.intercept)
        for name, weight in zip(self.columns, self.coefficients):
            out = out + F.lit(weight) * features[name]
        return out


def fit_ridge(train: DataFrame, alpha: float = 1.0):
    """L2 on the coefficients with a free intercept and no standardisation.

    The solver divides the penalty by the target deviation and averages the loss over rows,
    hence the factor that restores a plain sum-of-squares penalty of ``alpha``. Up to 4,096 features
    the normal equations are solved, beyond that the same objective is minimised iteratively.
    """
    spread = train.agg(F.stddev_pop(M.TARGET).alias("s"), F.count(F.lit(1)).alias("n")).first()
    penalty = alpha * (spread["s"] or 1.0) / spread["n"]
    return LinearRegression(featuresCol=M.FEATURES, labelCol=M.TARGET, regParam=penalty, elasticNetParam=0.0,
                            standardization=False, solver="auto").fit(train)


@dataclass(frozen=True)
class SeriesRidge:
    """A ridge with an indicator a series: one weight a series as a table, the others as numbers."""

    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    series: DataFrame  # (key, weight)


def fit_series_ridge(rows: DataFrame, columns: tuple[str, ...] = (), key: str = "city", target: str = M.TARGET,
                     alpha: float = 1.0) -> SeriesRidge:
    """The ridge of :func:`fit_ridge` over ``columns`` (doubles without nulls) and an indicator a series, in closed form.

    Given the other weights w, a series' own is n / (n + alpha) times its mean residual. Put in, what is
    left to solve has one row a column and needs only count, means and scatter of each series. One
    aggregation of the rows whatever the number of series; their weights stay a table. Rows without a
    series have no indicator.
    """
    n, y, names = F.col("_n"), F.col("_y0"), [f"_x{i}" for i in range(len(columns))]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    x = [F.col(c).cast("double") for c in columns]
    groups = settle(rows.dropna(subset=[target]).groupBy(F.col(key)).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(target).alias("_y0"), *[F.avg(c).alias(name) for c, name in zip(x, names)],
        *[F.covar_pop(x[i], x[j]).alias(f"_s{i}_{j}") for i, j in pairs],
        *[F.covar_pop(c, F.col(target)).alias(f"_t{i}") for i, c in enumerate(x)]), "series-moments")
    # How much of a series' mean its own weight leaves to the others.
    left = n * F.when(F.col(key).isNull(), 1.0).otherwise(F.lit(alpha) / (n + alpha))
    mean = [F.lit(1.0), *[F.col(name) for name in names]]
    sums = [F.sum(left * mean[i] * mean[j] + (n * F.col(f"_s{i - 1}_{j - 1}") if i else 0.0)) for i in range(len(mean)) for j in range(i, len(mean))]
    ends = [F.sum(left * mean[i] * y + (n * F.col(f"_t{i - 1}") if i else 0.0)) for i in range(len(mean))]
    found = groups.agg(*[s.alias(f"_{k}") for k, s in enumerate([*sums, *ends])]).first()
    normal, at = np.zeros((len(mean), len(mean))), 0
    for i in range(len(mean)):
        for j in range(i, len(mean)):
            normal[i, j] = normal[j, i] = found[at] or 0.0
            at += 1
    normal[1:, 1:] += alpha * np.eye(len(columns))
    w = np.linalg.lstsq(normal, np.array([v or 0.0 for v in found[at:]]), rcond=None)[0]
    rest = F.lit(float(w[0]))
    for weight, name in zip(w[1:], names):
        rest = rest + F.lit(float(weight)) * F.col(name)
    series = groups.dropna(subset=[key]).select(key, (n / (n + alpha) * (y - rest)).alias("weight"))
    return SeriesRidge(tuple(columns), tuple(map(float, w[1:])), float(w[0]), series)


# A boosting round does little per row, so a task is given this many rows at least, and tasks run in one wave,
# or in as few as keep a task below the greater number.
ROWS_PER_BOOST_TASK, MOST_ROWS_PER_BOOST_TASK = 50_000, 500_000


def boost_tasks(rows: int, cores: int) -> int:
    """Tasks of a boosting round over ``rows``: a last wave of few tasks would hold up each of the thousands of jobs."""
    tasks = max(2, rows // ROWS_PER_BOOST_TASK)
    return tasks if tasks <= cores else cores * max(1, -(-rows // (cores * MOST_ROWS_PER_BOOST_TASK)))


def ready_to_boost(train: DataFrame) -> DataFrame:
    """Stored rows in partitions of a size worth a task, and a shared folder that cuts the rounds' lineage."""
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(train.sparkSession))
    tasks = boost_tasks(train.count(), context.defaultParallelism)
    # Merged without a shuffle the partitions would differ by a whole one of the source.
    return train.coalesce(tasks) if tasks == 2 else train.repartition(tasks)


def fit_boosted(train: DataFrame, cfg: ModelConfig = ModelConfig()):
    """Boosted trees, all rounds in one job; where its tasks can't work together, as many rounds by MLlib, a job a level."""
    model = fit_rounds(train, cfg, barrier_slots(train.sparkSession))
    if model is not None:
        return model
    train = ready_to_boost(train)
    return GBTRegressor(
        featuresCol=M.FEATURES, labelCol=M.TARGET, maxIter=cfg.boost_rounds, maxDepth=cfg.boost_depth,
        stepSize=cfg.boost_rate, subsamplingRate=cfg.boost_row_fraction,
        featureSubsetStrategy=str(cfg.boost_column_fraction), maxMemoryInMB=cfg.max_memory_mb,
        seed=cfg.seed).fit(train)


def error_metrics(predictions: DataFrame, by: list[str], y: str = "y", p: str = "p") -> DataFrame:
    """RMSE, MAE and R² per group. A constant target scores 1 when hit exactly, else 0."""
    e, target = F.col(p) - F.col(y), F.col(y)
    sums = predictions.groupBy(*by).agg(
        F.count(target).alias("n"), F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("mae"),
        F.var_pop(target).alias("_var"))
    constant = F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)
    return sums.select(*by, "n", F.sqrt("_mse").alias("rmse"), "mae",
                       F.when(F.col("_var") == 0, constant).otherwise(1 - F.col("_mse") / F.col("_var")).alias("r2"))


FAMILIES = ("ridge", "random_forest", "boosted_trees")


def train_all(train: DataFrame, cfg: ModelConfig = ModelConfig(), families: tuple[str, ...] = FAMILIES) -> dict[str, object]:
    """Fit the families on one assembled training table, cached across the fits.

    They are fitted at the same time: boosting runs many short jobs that leave cores to the forest.
    """
    train = train.select(M.FEATURES, M.TARGET).persist()
    fits = {"ridge": lambda: fit_ridge(train, cfg.ridge_alpha), "random_forest": lambda: fit_forest(train, cfg),
            "boosted_trees": lambda: fit_boosted(train, cfg)}
    try:
        train.count()  # fills the cache once, not in every fit
        with ThreadPoolExecutor(max(len(families), 1)) as pool:
            running = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fits[name])) for name in families}
            return {name: fit.result() for name, fit in running.items()}
    finally:
        train.unpersist()


def predictions_long(models: dict[str, object], test: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(model, kept columns, y, p) for every model, scored on the same rows."""
    out = None
    for name, model in models.items():
        scored = model.transform(test).select(
            F.lit(name).alias("model"), *keep, F.col(M.TARGET).alias("y"), F.col(PREDICTION).alias("p"))
        out = scored if out is None else out.unionByName(scored)
    return out


def compare(models: dict[str, object], test: DataFrame) -> DataFrame:
    return error_metrics(predictions_long(models, test), ["model"]).orderBy("rmse")
