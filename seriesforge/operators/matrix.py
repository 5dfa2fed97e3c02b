"""Feature matrix: candidate columns, missing-share prune, medians, city indicators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from seriesforge import config as C
from seriesforge.functions import scalar, times
from seriesforge.operators.selection import chronological_cut, exact_medians

FEATURES, TARGET = "features", "_y"


@dataclass(frozen=True)
class FeatureSet:
    """Fitted once on training rows, replayed everywhere else."""

    columns: tuple[str, ...]
    medians: dict[str, float] = field(default_factory=dict)
    cities: tuple[str, ...] = ()


def city_indicators(cities: list[str], city: Column) -> dict[str, Column]:
    """0/1 column per listed city; a city outside the list is all zeros."""
    return {f"city_{c}": F.coalesce((city == c).cast("double"), F.lit(0.0)) for c in cities}


def candidate_columns(df: DataFrame, ignore: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c not in C.NON_FEATURES and c not in ignore]


def labelled(df: DataFrame, target: str = "aqi") -> DataFrame:
    """Rows with a numeric target."""
    return df.withColumn(target, scalar.to_double(F.col(target))).dropna(subset=[target])


def numeric_candidates(df: DataFrame, candidates: list[str]) -> dict[str, Column]:
    return {c: F.col(c).cast("int").cast("double") if c == "is_stale" else scalar.to_double(F.col(c))
            for c in candidates}


def seen_cities(df: DataFrame, city: str = "city") -> list[str]:
    """Distinct cities in name order: one fitted column name a series, however many there are."""
    return sorted(r[0] for r in df.select(city).dropna().distinct().collect())


def indicator_vector(df: DataFrame, cities, out: str = "_cities", city: str = "city") -> DataFrame:
    """The indicators of all ``cities`` as one sparse vector; an unlisted or null city is all zeros.

    A row costs one entry whatever the number of cities, and the plan one expression.
    """
    index = StringIndexerModel.from_labels(list(cities), inputCol=city, outputCol="_ci", handleInvalid="keep")
    indexed = index.transform(df)
    return OneHotEncoder(inputCols=["_ci"], outputCols=[out], dropLast=True).fit(indexed).transform(indexed).drop("_ci")


def fit_features(train: DataFrame, target: str = "aqi", ignore: tuple[str, ...] = ("ingest_seq",),
                 with_cities: bool = True, max_missing: float = C.MAX_MISSING_FRACTION) -> FeatureSet:
    """Choose columns (at most ``max_missing`` null) and their exact training medians.

    Only fitted scalars reach the driver: one share and one median per column.
    """
    rows = labelled(train, target)
    candidates = candidate_columns(rows, (*ignore, target))
    cities = seen_cities(rows) if with_cities else []
    # An all-null candidate may be untyped text; the numeric view settles that.
    numeric = rows.select(*[c.alias(n) for n, c in numeric_candidates(rows, candidates).items()])
    shares = numeric.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in candidates]).first() if candidates else {}
    kept = [c for c in candidates if shares[c] is not None and shares[c] <= max_missing]
    medians = {r["column_name"]: r["median"] for r in exact_medians(numeric, kept).collect()} if kept else {}
    dummies = [f"city_{c}" for c in cities]
    if dummies:
        # An indicator is mostly 0, or mostly 1 when one city dominates.
        counts = {r["city"]: r["count"] for r in rows.groupBy("city").count().collect()}
        n = sum(counts.values())
        medians |= {f"city_{c}": 0.5 if 2 * counts[c] == n else float(2 * counts[c] > n) for c in cities}
    return FeatureSet(tuple(kept + dummies), medians, tuple(cities))


def transform_features(df: DataFrame, fitted: FeatureSet, keep: tuple[str, ...] = (), target: str = "aqi") -> DataFrame:
    """Fitted columns in fitted order: absent ones are 0, missing values the training median."""
    rows = labelled(df, target)
    present = numeric_candidates(rows, [c for c in fitted.columns if c in rows.columns])
    indicators = city_indicators([c.removeprefix("city_") for c in fitted.columns if c.startswith("city_")],
                                 F.col("city")) if "city" in rows.columns else {}
    available = indicators | present
    filled = [F.coalesce(available.get(c, F.lit(0.0)), F.lit(float(fitted.medians.get(c) or 0.0))).alias(c)
              for c in fitted.columns]
    extra = [F.col(c).alias(f"_{c}") for c in keep]
    return rows.select(*extra, F.col(target).alias(TARGET), *filled)


def vectorise(df: DataFrame, fitted: FeatureSet, keep: tuple[str, ...] = (), target: str = "aqi") -> DataFrame:
    """The matrix of :func:`transform_features` as one vector in fitted order, indicators sparse."""
    numeric = tuple(c for c in fitted.columns if c not in {f"city_{x}" for x in fitted.cities})
    if not fitted.cities:
        return assemble(transform_features(df, fitted, keep, target), fitted.columns)
    wide = transform_features(df, FeatureSet(numeric, fitted.medians), (*keep, "city") if "city" not in keep else keep, target)
    wide = indicator_vector(wide, fitted.cities, city="_city")
    out = VectorAssembler(inputCols=[*numeric, "_cities"], outputCol=FEATURES).transform(wide)
    return out.select(*[f"_{c}" for c in keep], TARGET, plain_vector())


def plain_vector() -> Column:
    """The features without attribute notes: indicators are numbers to a tree, not categories."""
    return F.col(FEATURES).alias(FEATURES, metadata={})


def assemble(matrix: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    out = VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(matrix)
    return out.drop(*columns)


def time_split(df: DataFrame, test_fraction: float = 0.2, ts: str = "timestamp",
               ties: tuple[str, ...] = ("city", "ingest_seq")) -> DataFrame:
    """Chronological split over the whole table as an ``is_train`` column."""
    return chronological_cut(df, [], times.micros(ts), list(ties), test_fraction)
