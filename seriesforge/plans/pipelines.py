"""The four jobs: hourly refresh, backfill, training, forecast with explanation."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from seriesforge import config as C, schema as S
from seriesforge.config import FeatureConfig, ModelConfig, SeriesSpec
from seriesforge.functions import scalar, times
from seriesforge.operators import buckets as B, explain as E, forecast as FC, insights, levels as LV, matrix as M, models as MD
from seriesforge.operators import sequence_models as SM, sequences as SQ, trees as TR
from seriesforge.operators.asof import asof_join
from seriesforge.operators.features import engineer_features
from seriesforge.operators.quality import clean_series, coerce_numeric, keep_last
from seriesforge.session import materialize, settle
from seriesforge.sources import landing
from seriesforge.sources.edges import EdgeTable
from seriesforge.sources.registry import SEQUENCE_KINDS, ModelRegistry, guard_leakage
from seriesforge.sources.tables import KeyedTable

# Choice shown to users -> registered name.
MODEL_CHOICES = {
    "Random Forest": "aqi_random_forest",
    "Boosted Trees": "aqi_boosted_trees",
    "Ridge Regression": "aqi_ridge",
    "Sequence": "aqi_sequence",
    "Boosted Sequence": "aqi_sequence_boosted",
}


def to_raw_schema(rows: DataFrame) -> DataFrame:
    """Align by name with the raw table; absent columns become null."""
    missing = [f for f in S.RAW_READINGS.fields if f.name not in rows.columns]
    return coerce_numeric(rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
                          .select(*S.RAW_READINGS.fieldNames()))


def combine_raw(existing: DataFrame, new: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Stored and new rows by column name, the last one per (key, time) kept."""
    return keep_last(existing.unionByName(new, allowMissingColumns=True), spec)


# Widths a stored table's buckets narrow to, in hours: few, as each has an edge table of its own.
NARROWER, BUCKET_ROWS = (48, 24, 12, 6), 100_000


def narrowed(cfg: FeatureConfig, rows: DataFrame, spec: SeriesSpec) -> FeatureConfig:
    """The usual bucket width, or the first narrower one at which the densest series of ``rows`` keeps near BUCKET_ROWS a bucket."""
    fits = B.fit_bucket_hours(rows.select(spec.key, spec.ts), spec, BUCKET_ROWS, shortest=NARROWER[-1], longest=cfg.bucket_hours)
    return replace(cfg, bucket_hours=next(h for h in (cfg.bucket_hours, *NARROWER) if h <= fits))


def refresh_stored_features(changed: DataFrame, raw: KeyedTable, features: KeyedTable,
                            cfg: FeatureConfig = FeatureConfig()) -> None:
    """Recompute the stored features that rows just upserted into ``raw`` can affect.

    Only the days of the touched buckets and their look-back are read. Buckets are narrower than usual
    where the readings of the changed days are dense. Which buckets follow each other is known from the table's edges, so the history of the changed series is not scanned.
    """
    spec = raw.spec
    arrived = [r[0] for r in changed.dropna(subset=[spec.ts]).select(F.to_date(spec.ts)).distinct().collect()]
    cfg = narrowed(cfg, raw.scan_on(arrived), spec)
    table = EdgeTable(raw, cfg.bucket_us).create()
    edges = table.around(B.reached_buckets(changed, spec, cfg.bucket_us, cfg.reach_us))
    touched = settle(B.touched_buckets(edges, changed, spec, cfg.bucket_us, cfg.reach_us), "touched")
    start = F.col(B.BUCKET) * F.lit(cfg.bucket_us)
    day = [F.to_date(times.from_micros(us)) for us in (start - cfg.reach_us, start + (cfg.bucket_us - 1))]
    # One value per calendar day.
    days = [r[0] for r in touched.select(F.explode(F.sequence(*day))).distinct().collect()]
    if days:
        features.upsert(engineer_features(raw.scan_on(days), spec, cfg, unique=True, only=touched, edges=edges))


def run_feature_refresh(new_rows: DataFrame, raw: KeyedTable, features: KeyedTable,
                        cfg: FeatureConfig = FeatureConfig(), full: bool = False) -> bool:
    """Upsert the new readings and store their features. False when nothing arrived that the table lacks.

    ``full`` recomputes everything from the whole history; otherwise only what can change. The source
    is read once; readings that are stored as they are, such as those of a replay, cost one join.
    """
    batch = materialize(to_raw_schema(new_rows), "arrived")
    changed = materialize(raw.create().changes(batch), "changed")
    if changed.isEmpty():
        return False
    raw.upsert(changed, stored=True)
    if full:
        features.upsert(engineer_features(raw.scan(), raw.spec, narrowed(cfg, raw.scan(), raw.spec), unique=True))
    else:
        refresh_stored_features(changed, raw, features, cfg)
    return True


def backfill_readings(history: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """History documents of all cities as clean raw readings."""
    entries = landing.explode_history(history, start, end).filter(scalar.has_index(F.col("pm25")))
    rows = landing.backfill_rows(entries).withColumn("ingest_seq", F.col("poll_id"))
    return keep_last(to_raw_schema(rows))


def run_backfill(history: DataFrame, raw: KeyedTable, features: KeyedTable, start: Column | None = None,
                 end: Column | None = None, cfg: FeatureConfig = FeatureConfig()) -> bool:
    """Backfill, then derive features from the merged raw table, so edges see all history."""
    return run_feature_refresh(backfill_readings(history, start, end), raw, features, cfg)


@dataclass(frozen=True)
class Trained:
    features: M.FeatureSet
    models: dict[str, object]
    comparison: DataFrame
    train: DataFrame
    test: DataFrame
    levels: DataFrame | None = None


@dataclass(frozen=True)
class Prepared:
    features: M.FeatureSet
    train: DataFrame
    test: DataFrame
    levels: DataFrame | None = None


def prepare_training(features: DataFrame, test_fraction: float = 0.2, target: str = "aqi",
                     ignore: tuple[str, ...] = ("ingest_seq",), with_cities: bool = True, with_levels: bool = False) -> Prepared:
    """Chronological split and the matrices of both parts, columns and medians fitted on the training rows.

    Every series gets an indicator, sparse, unless ``with_cities`` is false; with ``with_levels`` it is
    one column for all series, the level of each (see ``levels``), which suits very many of them.
    ``features`` is read several times: hand in a stored table.
    """
    split = materialize(M.time_split(features, test_fraction), "split")
    train, test = split.filter("is_train").drop("is_train"), split.filter("NOT is_train").drop("is_train")
    levels = None
    if with_levels:
        train = M.labelled(train, target)
        prior = LV.prior_of(train, target)
        levels = LV.fit_levels(train, prior, target)
        train = materialize(LV.ordered_levels(train, prior, target), "leveled")
        test = LV.with_levels(test, levels)
        fitted = M.fit_features(train, target, ignore, with_cities=False)
        fitted = replace(fitted, medians=fitted.medians | {LV.LEVEL: prior})  # what a series without a level gets
    else:
        fitted = M.fit_features(train, target, ignore, with_cities)
    guard_leakage(list(fitted.columns), "in training")
    return Prepared(fitted, *[M.vectorise(part, fitted, keep=("city", "timestamp"), target=target) for part in (train, test)], levels)


def compared(prepared: Prepared, models: dict[str, object]) -> Trained:
    """The models with their errors on the same test rows."""
    return Trained(prepared.features, models, MD.compare(models, prepared.test), prepared.train, prepared.test, prepared.levels)


def train_and_compare(features: DataFrame, cfg: ModelConfig = ModelConfig(), test_fraction: float = 0.2,
                      target: str = "aqi", ignore: tuple[str, ...] = ("ingest_seq",), with_cities: bool = True,
                      with_levels: bool = False) -> Trained:
    """Chronological split, fit on train only, compare all families on the same test rows (see ``prepare_training``)."""
    prepared = prepare_training(features, test_fraction, target, ignore, with_cities, with_levels)
    return compared(prepared, MD.train_all(prepared.train, cfg))


def next_hour_target(features: DataFrame, tolerance_us: int = 15 * C.MINUTE_US) -> DataFrame:
    """Replace the same-row target by the value about an hour later (``next_aqi``)."""
    left = features.withColumn("_target_us", times.micros("timestamp") + C.HOUR_US)
    right = features.select("city", times.micros("timestamp").alias("_at"), F.col("aqi").alias("next_aqi"))
    joined = asof_join(left, right, ["city"], "_target_us", "_at", "_at", "nearest", tolerance_us)
    return joined.drop("_target_us", "_at")


def register_all(trained: Trained, registry: ModelRegistry) -> dict[str, int]:
    metrics = {r["model"]: r.asDict() for r in trained.comparison.collect()}
    return {name: registry.register(f"aqi_{name}", name, model, trained.features, metrics[name], trained.levels)
            for name, model in trained.models.items()}


def predictor_of(registry: ModelRegistry, row):
    """Linear weights or tree nodes of a registry row."""
    columns = tuple(row["feature_columns"])
    if row["kind"] == "ridge":
        return MD.LinearWeights.of(registry.load(row), columns)
    return TR.send_nodes(registry.spark, row["path"], columns, averaged=row["kind"] == "random_forest")


def forecast_with(kind: str, predictor, medians: dict[str, float], raw: DataFrame,
                  horizon: int = C.FORECAST_HORIZON, cfg: FeatureConfig = FeatureConfig(),
                  levels: DataFrame | None = None) -> DataFrame:
    inputs = FC.forecast_inputs(raw, cfg)
    if levels is not None:
        inputs = LV.with_levels(inputs, levels)
    run = FC.recursive_forecast_linear if kind == "ridge" else FC.recursive_forecast_trees
    return run(inputs, predictor, medians, horizon, cfg)


def forecast_sequences(raw: DataFrame, registry: ModelRegistry, row, horizon: int = C.FORECAST_HORIZON) -> DataFrame:
    """Forecasts of a registered sequence model, scaled as in its training.

    A series the model has no scaler for, or with too few recent readings, is an error.
    """
    recent, scalers = materialize(insights.recent_clean(raw), "recent"), registry.scalers(row)
    seeds = settle(SQ.seed_windows(recent, row["sequence_length"]), "seeds")
    for problem, missing in (("no scaler", SQ.missing_scalers(recent, scalers)),
                             (f"fewer than {row['sequence_length']} recent readings", SQ.missing_scalers(recent, seeds))):
        named = sorted(r[0] for r in missing.limit(5).collect())
        if named:
            raise ValueError(f"{problem} for {', '.join(named)}" + (" and maybe others" if len(named) == 5 else ""))
    cities = [c.removeprefix("city_") for c in row["feature_columns"]]
    if row["kind"] == "sequence":
        w = SM.SequenceWeights.of(registry.load(row), cities, row["sequence_length"])
        return FC.sequence_forecast(seeds, scalers, w.weights, w.intercept, w.city_weights, horizon)
    return FC.sequence_forecast_trees(seeds, scalers, TR.send_nodes(registry.spark, row["path"], cities),
                                      cities, horizon)


def forecast_all(raw: DataFrame, registry: ModelRegistry, choice: str | None = None,
                 horizon: int = C.FORECAST_HORIZON) -> DataFrame:
    """Forecast of every city with history by the best model, or by a chosen one."""
    if choice is not None and choice not in MODEL_CHOICES:
        raise ValueError(f"unknown model choice {choice!r}; options: {sorted(MODEL_CHOICES)}")
    row = registry.pick(MODEL_CHOICES[choice] if choice else None)
    if row["kind"] in SEQUENCE_KINDS:
        return forecast_sequences(raw, registry, row, horizon)
    return forecast_with(row["kind"], predictor_of(registry, row), row["medians"], raw, horizon, levels=_levels(registry, row))


def _levels(registry: ModelRegistry, row) -> DataFrame | None:
    return registry.scalers(row) if LV.LEVEL in row["feature_columns"] else None


def explain_next_hour(raw: DataFrame, registry: ModelRegistry, choice: str | None = None,
                      top_n: int = 6) -> DataFrame | None:
    """Top drivers of every city's next-hour forecast, from the same feature row the forecast uses."""
    row = registry.pick(MODEL_CHOICES[choice] if choice else None)
    if row["kind"] in SEQUENCE_KINDS:
        return None
    inputs, levels = FC.forecast_inputs(raw), _levels(registry, row)
    if levels is not None:
        inputs = LV.with_levels(inputs, levels)
    rows = FC.next_hour_features(inputs, row["feature_columns"], row["medians"])
    return E.explain(row["kind"], predictor_of(registry, row), rows, row["medians"], top_n)


def train_sequences(raw: DataFrame, length: int = C.SEQUENCE_LENGTH, test_fraction: float = 0.2,
                    boosted: bool = False, cfg: ModelConfig = ModelConfig(), scaler_fit: str = "all",
                    with_cities: bool = True):
    """Sequence regressor: scale per city, window, split per city, fit, score on the real scale.

    scaler_fit='all' lets the scalers see the test period as the original does; 'train' fits
    them on readings before each city's first test target.
    """
    # The cut reads its rows several times, so what it cuts is stored first.
    clean = materialize(clean_series(raw), "clean")
    scalers = settle(SQ.fit_scalers(clean), "scalers")
    if scaler_fit == "train":
        probe = SQ.split_sequences(materialize(SQ.build_sequences(clean, length), "windows"), test_fraction)
        first_test = settle(probe.filter("NOT is_train").groupBy("city").agg(F.min("target_ts").alias("_cut")))
        scalers = settle(SQ.fit_scalers(clean.join(first_test, "city", "left").filter(
            F.col("_cut").isNull() | (F.col("timestamp") < F.col("_cut")))), "scalers")
    scaled = SQ.scale(clean, scalers, "aqi", "aqi")
    windows = materialize(SQ.build_sequences(scaled, length), "windows")
    split = materialize(SQ.split_sequences(windows, test_fraction), "sequences")
    cities = M.seen_cities(clean) if with_cities else []
    train = SM.assemble_sequences(split.filter("is_train"), cities)
    test = SM.assemble_sequences(split.filter("NOT is_train"), cities)
    model = SM.fit_sequence_boosted(train, cfg) if boosted else SM.fit_sequence_linear(train)
    return model, scalers, cities, SM.real_scale_metrics(model.transform(test), scalers)


def register_sequence(model, cities: list[str], scalers: DataFrame, metrics: dict[str, float], registry: ModelRegistry,
                      boosted: bool = False, length: int = C.SEQUENCE_LENGTH) -> int:
    """Store the model with all that serving needs: scalers, window length and the order of the cities."""
    kind = "sequence_boosted" if boosted else "sequence"
    return registry.register(f"aqi_{kind}", kind, model, M.FeatureSet(tuple(f"city_{c}" for c in cities)), metrics,
                             scalers, length)
