"""Versioned models: a saved pyspark.ml model per version plus one registry row."""

from __future__ import annotations

import uuid

from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from seriesforge import schema as S
from seriesforge.config import POLLUTANTS
from seriesforge.operators.matrix import FeatureSet
from seriesforge.operators.trees import StoredForest
from seriesforge.session import file_system, path_exists

LOADERS = {"ridge": LinearRegressionModel, "random_forest": StoredForest,
           "boosted_trees": GBTRegressionModel, "sequence": LinearRegressionModel,
           "sequence_boosted": GBTRegressionModel}
# Not offered by the automatic choice, only by name.
SEQUENCE_KINDS = ("sequence", "sequence_boosted")


def latest_versions(registry: DataFrame) -> DataFrame:
    rest = [c for c in registry.columns if c != "name"]
    return (registry.groupBy("name").agg(F.max_by(F.struct(*rest), F.col("version")).alias("_m"))
            .select("name", *[F.col(f"_m.{c}").alias(c) for c in rest]))


def best_model(registry: DataFrame, exclude_kinds: tuple[str, ...] = SEQUENCE_KINDS) -> DataFrame:
    """Lowest RMSE among the latest versions; a missing RMSE counts as infinite."""
    latest = latest_versions(registry).filter(~F.col("kind").isin(*exclude_kinds))
    rank = F.struct(F.coalesce("rmse", F.lit(float("inf"))), F.col("name"))
    return (latest.agg(F.min_by(F.struct(*latest.columns), rank).alias("_m"))
            .filter(F.col("_m").isNotNull()).select("_m.*"))


def leaking_models(registry: DataFrame) -> DataFrame:
    """Registered versions trained on a pollutant measured at the same time as the target."""
    bad = F.array_intersect("feature_columns", F.array(*[F.lit(p) for p in POLLUTANTS]))
    return registry.withColumn("leaking", bad).filter(F.size("leaking") > 0).select("name", "version", "leaking")


def guard_leakage(feature_columns: list[str], label: str) -> None:
    leaking = sorted(set(POLLUTANTS) & set(feature_columns))
    if leaking:
        raise ValueError(f"leak: {label} takes {leaking}, which are measured together with the target")


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._rows_path = f"{self.root}/registry"

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, self._rows_path):
            return self.spark.createDataFrame([], S.REGISTRY)
        # One folder a version: writers that append to one folder at a time can remove each other's files.
        return self.spark.read.schema(S.REGISTRY).option("recursiveFileLookup", "true").parquet(self._rows_path)

    def _claim(self, name: str) -> int:
        """The next version of a model, for this writer alone: whoever renames a draft to the number first has it."""
        fs, folder = file_system(self.spark, f"{self.root}/{name}/versions")
        fs.mkdirs(folder)
        token = uuid.uuid4().hex
        while True:
            taken = [int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit()]
            number = max(taken, default=0) + 1
            _, draft = file_system(self.spark, f"{self.root}/{name}/versions/_{token}")
            _, claim = file_system(self.spark, f"{self.root}/{name}/versions/{number}")
            stream = fs.create(draft)
            try:
                stream.write(token.encode())
            finally:
                stream.close()
            if not fs.exists(claim) and fs.rename(draft, claim) and self._read(fs, claim) == token:
                return number
            fs.delete(draft, False)

    def _read(self, fs, path) -> str:
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def register(self, name: str, kind: str, model, features: FeatureSet, metrics: dict[str, float],
                 scalers: DataFrame | None = None, sequence_length: int | None = None) -> int:
        """Save the model, and the per-series table it needs, under the next version and add its registry row.

        Everything is written under a name no other writer has before the version is claimed, so writers
        at the same time get versions of their own, and one that fails leaves at most a number unused.
        """
        path = f"{self.root}/{name}/model-{uuid.uuid4().hex}"
        model.write().save(path)
        scalers_path = f"{path}-series" if scalers is not None else None
        if scalers_path:
            scalers.write.parquet(scalers_path)
        version = self._claim(name)
        row = (name, version, kind, path, metrics.get("rmse"), metrics.get("mae"), metrics.get("r2"),
               list(features.columns), dict(features.medians), sequence_length, scalers_path)
        rows = self.spark.createDataFrame([row], S.REGISTRY).coalesce(1)
        rows.write.parquet(f"{self._rows_path}/{name}-{version}")
        return version

    def pick(self, name: str | None = None) -> Row:
        """Registry row of the best model, or of the latest version of a named one."""
        chosen = (best_model(self.rows()) if name is None
                  else latest_versions(self.rows()).filter(F.col("name") == name))
        row = chosen.first()
        if row is None:
            raise LookupError(f"no registered model {name!r}" if name else "no registered model")
        guard_leakage(row["feature_columns"], f"{row['name']} v{row['version']}")
        return row

    def scalers(self, row: Row) -> DataFrame:
        if not row["scalers_path"]:
            raise LookupError(f"{row['name']} v{row['version']} was registered without its scalers")
        return self.spark.read.parquet(row["scalers_path"])

    def load(self, row: Row):
        return LOADERS[row["kind"]].load(row["path"])
