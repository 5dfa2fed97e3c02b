"""Next-value regressors on windows of scaled values plus city indicators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, functions as F

from seriesforge.config import SEQUENCE_LENGTH, ModelConfig
from seriesforge.operators import matrix as M
from seriesforge.operators.models import PREDICTION, error_metrics, ready_to_boost
from seriesforge.operators.selection import chronological_cut
from seriesforge.functions import times


@dataclass(frozen=True)
class SequenceWeights:
    """A linear sequence model, ready for the forecast fold."""

    weights: tuple[float, ...]
    intercept: float
    city_weights: dict[str, float]

    @classmethod
    def of(cls, model, cities: list[str], length: int = SEQUENCE_LENGTH) -> SequenceWeights:
        c = [float(v) for v in model.coefficients]
        return cls(tuple(c[:length]), float(model.intercept), dict(zip(cities, c[length:])))


def assemble_sequences(sequences: DataFrame, cities: list[str]) -> DataFrame:
    """Window and indicators as one vector; keeps city, target time and target."""
    wide = sequences.withColumn("_x", array_to_vector("x"))
    inputs = ["_x"]
    if cities:
        wide, inputs = M.indicator_vector(wide, cities), ["_x", "_cities"]
    out = VectorAssembler(inputCols=inputs, outputCol=M.FEATURES).transform(wide)
    return out.select("city", "target_ts", M.plain_vector(), F.col("y").alias(M.TARGET))


def fit_sequence_linear(train: DataFrame, penalty: float = 1e-6):
    return LinearRegression(featuresCol=M.FEATURES, labelCol=M.TARGET, regParam=penalty, elasticNetParam=0.0,
                            standardization=False, solver="auto").fit(train)


def fit_sequence_boosted(train: DataFrame, cfg: ModelConfig = ModelConfig(), validation: float = 0.1):
    """Boosted trees that stop early on the last ``validation`` share of each city's windows."""
    marked = chronological_cut(train, ["city"], times.micros("target_ts"), [], validation)
    marked = marked.persist()
    try:
        return GBTRegressor(
            featuresCol=M.FEATURES, labelCol=M.TARGET, maxIter=cfg.boost_rounds, maxDepth=cfg.boost_depth,
            stepSize=cfg.boost_rate, validationIndicatorCol="_held", maxMemoryInMB=cfg.max_memory_mb,
            seed=cfg.seed).fit(ready_to_boost(marked).withColumn("_held", ~F.col("is_train")))
    finally:
        marked.unpersist()


def real_scale_metrics(scored: DataFrame, scalers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Errors after both sides are brought back to the scale of their city."""
    span = F.when(F.col("hi") == F.col("lo"), 1.0).otherwise(F.col("hi") - F.col("lo"))
    real = scored.join(scalers, "city").select(
        "city", F.lit("sequence").alias("model"), (F.col(M.TARGET) * span + F.col("lo")).alias("y"),
        (F.col(PREDICTION) * span + F.col("lo")).alias("p"))
    return error_metrics(real, by or ["model"])
