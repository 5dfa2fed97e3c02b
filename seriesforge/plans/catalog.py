"""One named query per operator, each over whole tables. SQL twins live in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from seriesforge import schema as S
from seriesforge.config import HOUR_US, FeatureConfig, ModelConfig, SeriesSpec
from seriesforge.functions import scalar, times
from seriesforge.operators import (
    asof, explain as EX, features as FT, forecast as FC, insights as IN, levels as LV, lookups as LK, matrix as MX,
    models as MD, quality as QL, selection as SL, sequences as SQ, trees as TR)
from seriesforge.plans import pipelines as PL
from seriesforge.session import fresh_path, materialize, session_cache, settle
from seriesforge.sources import adapters as AD, landing as LA, registry as RG
from seriesforge.sources.tables import KeyedTable
from seriesforge.streaming import streams as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCALED_ABOVE = 250.0
AS_OF = "2024-01-30 12:00:00"
NEW_FROM = "2024-01-30 00:00:00"
BUCKET_ROWS = 200_000
# Fixed weights that make forecast queries comparable with SQL; shared with the oracles.
LINEAR = MD.LinearWeights(
    ("hour", "is_weekend", "lag_1h_aqi", "lag_3h_aqi", "lag_24h_aqi", "rolling_3h_mean_aqi",
     "rolling_3h_std_aqi", "rolling_24h_mean_aqi", "rolling_24h_std_aqi", "aqi_change_rate", "city_click"),
    (0.1, 1.5, 0.3, 0.1, 0.2, 0.1, 0.05, 0.15, 0.02, 0.5, 2.0), 2.0)
MEDIANS = {"hour": 11.0, "is_weekend": 0.0, "lag_1h_aqi": 36.0, "lag_3h_aqi": 36.0, "lag_24h_aqi": 35.0,
           "rolling_3h_mean_aqi": 46.0, "rolling_3h_std_aqi": 37.0, "rolling_24h_mean_aqi": 49.0,
           "rolling_24h_std_aqi": 48.0, "aqi_change_rate": 0.0, "city_click": 0.0}
SEQ_WEIGHTS = [round(0.002 * i, 3) for i in range(1, 25)]
SEQ_INTERCEPT, SEQ_CITY = 0.05, {"click": 0.02, "view": -0.01}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _events(spark, sf_dir):
    return AD.load(spark, sf_dir, "events")


def _readings(spark, sf_dir, **kw):
    return AD.readings(_events(spark, sf_dir), **kw)


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _us(text: str) -> Column:
    return times.micros_of(_ntz(text))


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, so both engines print the same value.

    Rolling means keep eight: the mean of 32 or 64 two-decimal values can end in an exact tie
    at the sixth digit, which rounding noise would break either way; means of whole series ten.
    """
    def places(c: str) -> int:
        if c == "mean":
            return 10
        return 8 if c.startswith("rolling_") and "_mean_" in c else digits

    return df.select(*[F.round(c, places(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- quality and row-level rules -------------------------------------------------------------

@query
def dedupe_keep_last(spark, sf_dir):
    return QL.keep_last(_readings(spark, sf_dir, hourly=True))


@query
def dedupe_metrics(spark, sf_dir):
    return QL.dedupe_counts(_readings(spark, sf_dir, hourly=True))


@query
def time_features(spark, sf_dir):
    return FT.add_time_features(_readings(spark, sf_dir).select("city", "timestamp", "ingest_seq"))


@query
def pm25_to_aqi(spark, sf_dir):
    return LK.with_pm25_index(_readings(spark, sf_dir).select("ingest_seq", "pm25"), "pm25", "index")


@query
def pm25_to_aqi_range_join(spark, sf_dir):
    return LK.range_lookup_index(_readings(spark, sf_dir).select("ingest_seq", "pm25"))


@query
def aqi_category(spark, sf_dir):
    index = F.when(F.col("k") % 10 != 0, F.col("aqi") * 2)
    return _readings(spark, sf_dir).select(
        "ingest_seq", scalar.forecast_category(index).alias("category"),
        F.coalesce(scalar.is_hazardous(index), F.lit(False)).alias("hazardous"))


@query
def category_attributes(spark, sf_dir):
    rows = _readings(spark, sf_dir).select("ingest_seq", (F.col("aqi") * 2).alias("aqi"))
    return LK.category_attributes(rows, F.col("aqi")).select(
        "ingest_seq", "category_key", "category_label", scalar.category_phrase(F.col("aqi")).alias("category_phrase"),
        "color", "guidance")


@query
def resolve_aqi(spark, sf_dir):
    k = F.col("k") % 10
    raw = F.when(k == 0, "-").when(k == 1, "").when(k == 2, "n/a").when(k == 3, F.lit(None)).otherwise(
        F.col("aqi").cast("string"))
    pm25 = F.when(k == 2, "bad").otherwise((F.col("pm25") / 2).cast("string"))
    return _readings(spark, sf_dir).select("ingest_seq", scalar.resolve_index(raw, pm25).alias("resolved"))


@query
def staleness_flag(spark, sf_dir):
    ts = F.when(F.col("k") % 20 != 0, F.col("timestamp"))
    rows = _readings(spark, sf_dir).withColumn("timestamp", ts)
    return QL.flag_stale(rows, _us(AS_OF)).select("ingest_seq", "is_stale")


@query
def station_match(spark, sf_dir):
    k = F.col("k") % 4
    station = (F.when(k == 0, F.concat(F.lit("Central "), F.upper("city")))
               .when(k == 1, "FDA-01 roof").when(k == 2, F.lit(None)).otherwise("elsewhere"))
    city = F.when(F.col("city") == "click", "Faisalabad").otherwise(F.col("city"))
    rows = _readings(spark, sf_dir).select("ingest_seq", city.alias("city"), station.alias("matched_station"))
    return QL.flag_station(rows).select("ingest_seq", "station_ok")


@query
def numeric_coercion(spark, sf_dir):
    text = F.when(F.col("k") < 5, "n/a").when(F.col("k") < 10, "nan").otherwise(F.col("aqi").cast("string"))
    rows = _readings(spark, sf_dir).select("ingest_seq", text.alias("aqi"), F.lit("x").alias("lag_1h_aqi"))
    return QL.coerce_numeric(rows)


@query
def display_formats(spark, sf_dir):
    ts = F.col("timestamp")
    return _readings(spark, sf_dir).select(
        "ingest_seq", times.day_text(ts).alias("day"), times.clock_text(ts).alias("clock"),
        times.weekday_text(ts).alias("weekday"), times.reading_text(ts).alias("reading"),
        times.local_time(ts).alias("local"), times.iso_utc(ts).alias("iso"))


@query
def timestamp_normalise(spark, sf_dir):
    """Text times with offsets to naive UTC; a bad one becomes null."""
    k = F.col("k") % 3
    text = F.when(k == 0, F.concat(F.date_format(F.col("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))).when(
        k == 1, times.iso_utc(F.col("timestamp"))).otherwise("soon")
    rows = _readings(spark, sf_dir).select("ingest_seq", text.alias("timestamp"))
    return QL.normalize_timestamp(rows)


# --- nested sources --------------------------------------------------------------------------

def _current(spark, sf_dir):
    return LA.parse_bodies(AD.current_payloads(_events(spark, sf_dir)), S.CURRENT_PAYLOAD)


def _weather(spark, sf_dir):
    return LA.parse_bodies(AD.weather_payloads(_events(spark, sf_dir)), S.WEATHER_PAYLOAD)


def _history(spark, sf_dir):
    return LA.parse_bodies(AD.history_payloads(_events(spark, sf_dir)), S.HISTORY_PAYLOAD)


@query
def current_flatten(spark, sf_dir):
    return _rounded(LA.flatten_current(_current(spark, sf_dir)).select(
        "city", "poll_id", "matched_station", "timestamp", "aqi", "dominant_pollutant", "pm25", "pm10", "no2",
        "aqicn_temp", "aqicn_humidity"))


@query
def status_quarantine(spark, sf_dir):
    _, rejected = LA.split_by_status(_current(spark, sf_dir))
    return rejected.select("city", "poll_id", "status")


@query
def weather_fallback(spark, sf_dir):
    merged = LK.merge_weather(LA.flatten_current(_current(spark, sf_dir)),
                              LA.flatten_weather(_weather(spark, sf_dir)))
    return merged.select("city", "poll_id", "temp", "humidity", "pressure", "wind_speed")


@query
def current_snapshot(spark, sf_dir):
    shot = LA.snapshot(_current(spark, sf_dir), _weather(spark, sf_dir), _us(AS_OF))
    return shot.select("city", "poll_id", "aqi", "temp", "is_stale", "station_ok")


@query
def snapshot_of_configured_cities(spark, sf_dir):
    """Readings polled for three configured and two other places: only the configured ones are in the snapshot, with their station."""
    names = {"click": "Lahore", "view": "Karachi", "purchase": "Quetta"}
    named = lambda df: df.replace(names, subset=["city"])
    cities = S.city_dim(spark)
    shot = LA.snapshot(named(_current(spark, sf_dir)), named(_weather(spark, sf_dir)), _us(AS_OF), cities)
    return shot.join(cities, "city").select("city", "poll_id", "aqi", "temp", "is_stale", "station", "lat", "lon")


@query
def history_explode(spark, sf_dir):
    rows = LA.explode_history(_history(spark, sf_dir), _ntz("2024-01-05 00:00:00"), _ntz("2024-01-25 00:00:00"))
    return rows.select("city", "poll_id", "timestamp", "pm25", "pm10", "no2")


@query
def landing_by_day(spark, sf_dir):
    """History documents landed in day folders; of those only the days that can hold the range are read."""
    folder = fresh_path(spark, "landing-history")
    _history(spark, sf_dir).withColumn(LA.DAY, F.to_date("ingested_at")).write.partitionBy(LA.DAY).json(folder)
    landed = LA.read_landing_days(spark, folder, S.HISTORY_PAYLOAD, "2024-01-05", "2024-01-25", earlier=1)
    good, _ = LA.split_broken(landed)
    rows = LA.explode_history(good, _ntz("2024-01-05 00:00:00"), _ntz("2024-01-25 00:00:00"))
    return rows.select("city", "poll_id", "timestamp", "pm25", "pm10", "no2")


@query
def landing_broken_lines(spark, sf_dir):
    """Every 17th document arrives cut off; its text is found, the others are read."""
    folder, k = fresh_path(spark, "landing-current"), F.get_json_object("props", "$.k").cast("int")
    cut = F.concat(F.lit('{"city":"'), "event_type", F.lit('","poll_id":'), "event_id")
    whole = F.concat(cut, F.lit(',"ingested_at":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('","status":"ok"}'))
    lines = _events(spark, sf_dir).select(F.when(k % 17 == 3, cut).otherwise(whole).alias("value"), F.to_date("ts").alias(LA.DAY))
    lines.write.partitionBy(LA.DAY).text(folder)
    good, broken = LA.split_broken(LA.read_landing_days(spark, folder, S.CURRENT_PAYLOAD))
    return broken.unionByName(good.groupBy("city").count().select(F.concat("city", F.lit(" "), "count").alias("line")))


@query
def backfill(spark, sf_dir):
    return PL.backfill_readings(_history(spark, sf_dir)).select(
        "city", "timestamp", "aqi", "pm25", "dominant_pollutant", "matched_station", "is_stale", "temp", "ingest_seq")


# --- series features -------------------------------------------------------------------------

@query
def asof_lags(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    return FT.add_lag_features(QL.keep_last(raw), edges_from=raw).drop("pm25", "k")


@query
def rolling_stats(spark, sf_dir):
    return _rounded(FT.add_rolling_features(_readings(spark, sf_dir)).drop("pm25", "k"))


@query
def change_rate(spark, sf_dir):
    return _rounded(FT.add_change_rate(_readings(spark, sf_dir)).drop("pm25", "k"))


@query
def engineer_features(spark, sf_dir):
    return _rounded(FT.engineer_features(_readings(spark, sf_dir, hourly=True)))


@query
def engineer_features_many_series(spark, sf_dir):
    return _rounded(FT.engineer_features(_readings(spark, sf_dir, key="user_id")).drop("pm25", "k"))


@query
def engineer_features_cells(spark, sf_dir):
    """The same features over cells so small that every day of a series is cut into many."""
    cfg = FeatureConfig(cell_rows=20)
    return _rounded(FT.engineer_features(_readings(spark, sf_dir, hourly=True), cfg=cfg, mode="cells"))


@query
def incremental_refresh(spark, sf_dir):
    """Features before the last day arrived, with the touched buckets replaced by a refresh."""
    from seriesforge.operators import buckets as BK
    raw, spec = _readings(spark, sf_dir), SeriesSpec()
    # A bucket is narrower where the usual width would hold too many readings of a series.
    hours = BK.fit_bucket_hours(raw, spec, max_rows=BUCKET_ROWS, longest=FeatureConfig().bucket_hours)
    cfg = FeatureConfig(bucket_hours=hours)
    late = F.col("timestamp") >= _ntz(NEW_FROM)
    old, new = raw.filter(~late), raw.filter(late)
    touched = BK.touched_buckets(BK.bucket_edges(raw, spec, cfg.bucket_us), new, spec, cfg.bucket_us, cfg.reach_us)
    kept = (FT.engineer_features(old, cfg=cfg).withColumn(BK.BUCKET, BK.bucket_of(times.micros("timestamp"), cfg.bucket_us))
            .join(touched, ["city", BK.BUCKET], "left_anti").drop(BK.BUCKET))
    return _rounded(kept.unionByName(FT.refresh_features(raw, new, cfg=cfg)).drop("pm25", "k"))


def _asof(spark, sf_dir, direction):
    e = _events(spark, sf_dir).withColumn("us", times.micros("ts"))
    left = e.filter(F.col("event_type") == "purchase").select("user_id", "event_id", "us")
    right = e.filter(F.col("event_type") == "view").select(
        "user_id", F.col("us").alias("view_us"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return asof.asof_join(left, right, ["user_id"], "us", "view_us", "view_id", direction, 24 * HOUR_US).select(
        "user_id", "event_id", "view_id", "view_value")


@query
def asof_join_backward(spark, sf_dir):
    return _asof(spark, sf_dir, "backward")


@query
def asof_join_forward(spark, sf_dir):
    return _asof(spark, sf_dir, "forward")


@query
def asof_join_nearest(spark, sf_dir):
    return _asof(spark, sf_dir, "nearest")


@query
def next_hour_target(spark, sf_dir):
    rows = _readings(spark, sf_dir).select("city", "timestamp", "aqi", "ingest_seq")
    return PL.next_hour_target(rows)


# --- tables ----------------------------------------------------------------------------------

@query
def raw_upsert(spark, sf_dir):
    """Create, load the first 20 days, then upsert everything twice: repeats change nothing."""
    raw = AD.raw_readings(_events(spark, sf_dir), hourly=True)
    table = KeyedTable(spark, fresh_path(spark, "raw-readings"), S.RAW_READINGS).create()
    table.upsert(raw.filter(F.col("timestamp") < _ntz("2024-01-21 00:00:00")))
    table.upsert(raw)
    table.upsert(raw)
    return table.scan().select("city", "timestamp", "aqi", "temp", "is_stale", "ingest_seq")


@query
def history_union(spark, sf_dir):
    """Stored rows without a column and new rows with it, aligned by name, last one kept."""
    rows = _readings(spark, sf_dir, hourly=True)
    late = F.col("timestamp") >= _ntz("2024-01-15 00:00:00")
    return PL.combine_raw(rows.filter(~late).drop("pm25"), rows.filter(late))


# --- insights --------------------------------------------------------------------------------

def _clean(spark, sf_dir, **kw):
    return QL.clean_series(_readings(spark, sf_dir, **kw))


@query
def city_summary(spark, sf_dir):
    return _rounded(IN.summary_stats(_clean(spark, sf_dir)))


@query
def city_summary_many_series(spark, sf_dir):
    return _rounded(IN.summary_stats(_clean(spark, sf_dir, key="user_id")))


@query
def daily_trend(spark, sf_dir):
    return _rounded(IN.daily_trend(_clean(spark, sf_dir)))


@query
def hourly_pattern(spark, sf_dir):
    return _rounded(IN.hourly_pattern(_clean(spark, sf_dir)))


@query
def hourly_pattern_per_series(spark, sf_dir):
    return _rounded(IN.hourly_pattern(_clean(spark, sf_dir, key="user_id"), per_key=True))


@query
def weekday_pattern(spark, sf_dir):
    return _rounded(IN.weekday_pattern(_clean(spark, sf_dir), key="view"))


@query
def freshness(spark, sf_dir):
    return _rounded(IN.freshness(_clean(spark, sf_dir), _us(AS_OF)))


@query
def freshness_view(spark, sf_dir):
    return IN.freshness_view(IN.freshness(_clean(spark, sf_dir), _us(AS_OF)))


@query
def series_counts(spark, sf_dir):
    return IN.series_counts(_readings(spark, sf_dir, key="user_id"))


@query
def latest_reading(spark, sf_dir):
    return IN.latest_reading(_clean(spark, sf_dir, key="user_id"))


@query
def recent_history(spark, sf_dir):
    return IN.recent_clean(_readings(spark, sf_dir)).select("city", "timestamp", "aqi")


@query
def daily_means_local(spark, sf_dir):
    return IN.daily_means(_clean(spark, sf_dir))


def _two_parts(spark, sf_dir):
    rows = _clean(spark, sf_dir).withColumn("aqi", F.col("aqi") * 2)
    late = F.col("timestamp") >= _ntz("2024-01-28 00:00:00")
    return rows.filter(~late), rows.filter(late)


@query
def peak_alert(spark, sf_dir):
    return IN.peak_alert(_two_parts(spark, sf_dir)[1])


@query
def measured_forecast_bridge(spark, sf_dir):
    return IN.measured_and_forecast(*_two_parts(spark, sf_dir))


@query
def hourly_forecast_table(spark, sf_dir):
    return IN.hourly_table(_two_parts(spark, sf_dir)[1])


# --- matrix, splits, scaling, sequences ------------------------------------------------------

def _raw_wide(spark, sf_dir):
    return AD.raw_readings(_events(spark, sf_dir))


_WIDE = ["temp", "humidity", "pressure", "wind_speed", "no2"]


@query
def null_fraction_prune(spark, sf_dir):
    shares = QL.null_fractions(_raw_wide(spark, sf_dir), _WIDE)
    return _rounded(shares.withColumn("kept", F.col("null_fraction") <= 0.5))


@query
def feature_medians(spark, sf_dir):
    return _rounded(SL.exact_medians(_raw_wide(spark, sf_dir), ["temp", "humidity", "pressure", "wind_speed", "aqi"]))


@query
def feature_matrix(spark, sf_dir):
    """Fit on all rows, replay on the same rows: indicators, prune, medians, fixed order."""
    raw = _raw_wide(spark, sf_dir)
    fitted = MX.fit_features(raw)
    return MX.transform_features(raw, fitted, keep=("ingest_seq",))


@query
def one_hot(spark, sf_dir):
    rows = _readings(spark, sf_dir)
    dummies = MX.city_indicators(["click", "error", "nowhere"], F.col("city"))
    return rows.select("ingest_seq", *[c.alias(n) for n, c in dummies.items()])


@query
def time_split(spark, sf_dir):
    rows = materialize(_readings(spark, sf_dir, hourly=True), "readings")
    return MX.time_split(rows).select("ingest_seq", "is_train")


@query
def minmax_scale(spark, sf_dir):
    rows = _readings(spark, sf_dir)
    return _rounded(SQ.scale(rows, settle(SQ.fit_scalers(rows)), "aqi", "scaled").select("ingest_seq", "scaled"), 9)


@query
def inverse_scale(spark, sf_dir):
    rows = _readings(spark, sf_dir)
    scalers = settle(SQ.fit_scalers(rows))
    back = SQ.unscale(SQ.scale(rows, scalers, "aqi", "scaled"), scalers, "scaled", "restored")
    return _rounded(back.select("ingest_seq", "restored"))


@query
def missing_scalers(spark, sf_dir):
    rows = _readings(spark, sf_dir, key="user_id")
    return SQ.missing_scalers(rows, SQ.fit_scalers(rows.filter(F.col("aqi") > SCALED_ABOVE)))


@query
def sequences(spark, sf_dir):
    found = SQ.build_sequences(_clean(spark, sf_dir, hourly=True))
    return found.withColumn("x", F.array_join(F.transform("x", lambda v: v.cast("string")), ","))


@query
def sequence_split(spark, sf_dir):
    found = materialize(SQ.build_sequences(_clean(spark, sf_dir, hourly=True)), "windows")
    return SQ.split_sequences(found).select("city", "target_ts", "is_train")


@query
def seed_windows(spark, sf_dir):
    seeds = SQ.seed_windows(_clean(spark, sf_dir, key="user_id"))
    return seeds.withColumn("x", F.array_join(F.transform("x", lambda v: v.cast("string")), ","))


# --- models ----------------------------------------------------------------------------------

@query
def ridge_fit(spark, sf_dir):
    """Coefficients of a two-feature ridge; the oracle solves the normal equations."""
    rows = _readings(spark, sf_dir).select(F.hour("timestamp").cast("double").alias("hour"),
                                           F.col("k").cast("double").alias("k"), F.col("aqi").alias(MX.TARGET))
    w = MD.LinearWeights.of(MD.fit_ridge(MX.assemble(rows, ("hour", "k")), 1.0), ("hour", "k"))
    terms = [*zip(w.columns, w.coefficients), ("intercept", w.intercept)]
    return _rounded(spark.createDataFrame(terms, "term string, weight double"))


@query
def metrics(spark, sf_dir):
    """Errors of the naive forecast 'same as an hour ago', per series."""
    raw = _readings(spark, sf_dir)
    lagged = FT.add_lag_features(QL.keep_last(raw), edges_from=raw).dropna(subset=["lag_1h_aqi"])
    return _rounded(MD.error_metrics(lagged, ["city"], "aqi", "lag_1h_aqi"))


def _registry(spark, sf_dir):
    k = F.col("k")
    return _readings(spark, sf_dir).groupBy(
        F.concat(F.lit("aqi_"), "city").alias("name"), (k + 1).alias("version")).agg(
        F.avg(F.when(k % 2 == 1, F.col("aqi"))).alias("rmse")).withColumn(
        "kind", F.when(F.col("name") == "aqi_view", "sequence").otherwise("ridge"))


@query
def latest_model_versions(spark, sf_dir):
    return _rounded(RG.latest_versions(_registry(spark, sf_dir)))


@query
def best_model(spark, sf_dir):
    return _rounded(RG.best_model(_registry(spark, sf_dir)))


def _features_table(spark, sf_dir):
    """Training reads stored features, so they are written once here."""
    return materialize(FT.engineer_features(_raw_wide(spark, sf_dir)), "features")


def _once(spark, sf_dir, name, make):
    """Models fitted in this session, by name and data folder: several queries look at the same one."""
    fitted, key = session_cache(spark), (sf_dir, name)
    if key not in fitted:
        fitted[key] = make()
    return fitted[key]


def _sizes(spark) -> ModelConfig:
    """Production sizes, unless the session asks for small models, as unit tests do."""
    small = spark.conf.get("spark.seriesforge.models", "production") == "small"
    return ModelConfig.small() if small else ModelConfig()


def _fitted(spark, sf_dir, families: tuple[str, ...]) -> tuple[PL.Prepared, dict[str, object]]:
    """The named families on the first four fifths of the rows; what this session has fitted is not fitted again."""
    prepared = _once(spark, sf_dir, "prepared", lambda: PL.prepare_training(_features_table(spark, sf_dir)))
    models = _once(spark, sf_dir, "same-row", dict)
    missing = tuple(name for name in families if name not in models)
    if missing:
        models |= MD.train_all(prepared.train, _sizes(spark), missing)
    return prepared, {name: models[name] for name in families}


def _trained(spark, sf_dir, *families: str) -> PL.Trained:
    """The named families (default: all) with their errors on the test rows."""
    return PL.compared(*_fitted(spark, sf_dir, families or MD.FAMILIES))


def _verdict(comparison: DataFrame, test: DataFrame) -> DataFrame:
    """Per model: test rows, whether it beats the test rows' mean, and whether its measures agree with each other."""
    spread = test.agg(F.stddev_pop(MX.TARGET).alias("spread"))
    close = lambda x, y: F.abs(x - y) < 1e-6
    return comparison.crossJoin(F.broadcast(spread)).select(
        "model", "n", (F.col("rmse") < F.col("spread")).alias("beats_mean"),
        (close(F.col("r2"), 1 - F.pow(F.col("rmse") / F.col("spread"), 2)) & (F.col("mae") <= F.col("rmse"))).alias("consistent"))


@query
def model_comparison(spark, sf_dir):
    """All families at production size on the last fifth of the rows.

    The values of these events are independent, so no model can be asked to beat the mean of later
    rows; ``forest_eval`` and ``gbt_eval`` ask it of the rows fitted to.
    """
    trained = _trained(spark, sf_dir)
    return _verdict(trained.comparison, trained.test).drop("beats_mean")


def _nodes(spark, sf_dir, name) -> TR.SentNodes:
    prepared, models = _fitted(spark, sf_dir, (name,))
    return _once(spark, sf_dir, f"{name}-nodes", lambda: TR.send_nodes(
        spark, TR.saved(spark, models[name]), prepared.features.columns, averaged=name == "random_forest"))


def _in_sample(spark, sf_dir, name):
    prepared, models = _fitted(spark, sf_dir, (name,))
    errors = MD.error_metrics(MD.predictions_long(models, prepared.train), ["model"])
    return _verdict(errors, prepared.train)


@query
def forest_eval(spark, sf_dir):
    return _in_sample(spark, sf_dir, "random_forest")


@query
def gbt_eval(spark, sf_dir):
    return _in_sample(spark, sf_dir, "boosted_trees")


@query
def sequence_model_eval(spark, sf_dir):
    """Held-out windows and the bound that all forecasts stay near the range seen in training."""
    metrics = PL.train_sequences(_readings(spark, sf_dir, hourly=True))[3]
    return metrics.select("model", "n", (F.col("rmse") < 200).alias("bounded"), (F.col("mae") <= F.col("rmse")).alias("consistent"))


@query
def train_many_series(spark, sf_dir):
    """Ridge with an indicator for every user, whatever their number: the level of each."""
    rows = MX.labelled(_readings(spark, sf_dir, key="user_id"))
    w = MD.fit_series_ridge(rows, target="aqi")
    return _rounded(w.series.select("city", (F.col("weight") + w.intercept).alias("level")), 6)


@query
def series_levels(spark, sf_dir):
    """What a model of very many series is given instead of an indicator each: rows of the first 20 days are
    trained on and know the days before them, later ones get the level of all training rows."""
    rows = materialize(_readings(spark, sf_dir, key="user_id").select("city", "timestamp", "aqi", "ingest_seq"), "readings")
    early = F.col("timestamp") < _ntz("2024-01-21 00:00:00")
    prior = LV.prior_of(rows.filter(early))
    train = LV.ordered_levels(rows.filter(early), prior)
    rest = LV.with_levels(rows.filter(~early), LV.fit_levels(rows.filter(early), prior))
    return train.unionByName(rest).select("ingest_seq", F.round(LV.LEVEL, 6).alias("series_level"))


@query
def column_alignment(spark, sf_dir):
    """Columns fitted on the late half, replayed on rows that lack one of them and know other cities."""
    rows = _raw_wide(spark, sf_dir).select("city", "timestamp", "aqi", "temp", "pressure", "wind_speed", "ingest_seq")
    fitted = MX.fit_features(rows.filter(F.col("city") != "view"))
    return MX.transform_features(rows.drop("pressure"), fitted, keep=("ingest_seq",))


@query
def leaking_models(spark, sf_dir):
    """Registered versions trained on a pollutant of the same row."""
    registry = _registry(spark, sf_dir).withColumn("feature_columns", F.when(
        F.col("version") % 7 == 0, F.array(F.lit("hour"), F.lit("pm25"))).when(
        F.col("version") % 7 == 1, F.array(F.lit("co"), F.lit("no2"))).otherwise(F.array(F.lit("hour"))))
    return RG.leaking_models(registry).withColumn("leaking", F.array_join(F.array_sort("leaking"), ","))


# --- forecasts and explanations --------------------------------------------------------------

def _inputs(spark, sf_dir):
    return FC.forecast_inputs(_readings(spark, sf_dir))


@query
def next_hour_features(spark, sf_dir):
    return _rounded(FC.next_hour_features(_inputs(spark, sf_dir), LINEAR.columns, MEDIANS))


@query
def recursive_forecast_linear(spark, sf_dir):
    steps = FC.recursive_linear_steps(_inputs(spark, sf_dir), LINEAR, MEDIANS)
    return _rounded(steps.select("city", "step", "value", scalar.forecast_category(F.col("value")).alias("category"),
                                 scalar.is_hazardous(F.col("value")).alias("hazardous")))


@query
def forecast_view(spark, sf_dir):
    forecast = FC.recursive_forecast_linear(_inputs(spark, sf_dir), LINEAR, MEDIANS)
    return IN.forecast_view(forecast, 24)


@query
def recursive_forecast_many_series(spark, sf_dir):
    inputs = FC.forecast_inputs(_readings(spark, sf_dir, key="user_id"))
    steps = FC.recursive_linear_steps(inputs, LINEAR, MEDIANS)
    return _rounded(steps.select("city", "step", "value"))


def _forecast_checked(forecast: DataFrame, low: float, high: float) -> DataFrame:
    """Place and time of each forecast, and whether value, category and hazard flag fit together.

    The flags are of the value before it is rounded to tenths, so either end of the rounding fits.
    """
    v = F.col("predicted_aqi")

    def fits(flag: str, rule) -> Column:
        return ((F.col(flag) == rule(v - 0.051)) | (F.col(flag) == rule(v + 0.051)))

    return forecast.select(
        "city", "timestamp", "step", v.between(low - 0.05, high + 0.05).alias("in_range"),
        fits("aqi_category", scalar.forecast_category).alias("category_fits"),
        fits("is_hazardous", scalar.is_hazardous).alias("hazard_fits"))


def _value_range(spark, sf_dir):
    return _events(spark, sf_dir).agg(F.min("value"), F.max("value")).first()


@query
def recursive_forecast_trees(spark, sf_dir):
    """A forest averages measured values, so its forecasts stay in their range."""
    inputs = FC.forecast_inputs(_raw_wide(spark, sf_dir))
    nodes, medians = _nodes(spark, sf_dir, "random_forest"), _fitted(spark, sf_dir, ("random_forest",))[0].features.medians
    found = FC.recursive_forecast_trees(inputs, nodes, medians)
    return _forecast_checked(found, *_value_range(spark, sf_dir))


@query
def sequence_forecast(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    seeds = SQ.seed_windows(IN.recent_clean(_readings(spark, sf_dir)))
    steps = FC.sequence_steps(seeds, settle(SQ.fit_scalers(clean)), SEQ_WEIGHTS, SEQ_INTERCEPT, SEQ_CITY)
    return _rounded(steps.select("city", "step", "value"))


@query
def linear_attribution(spark, sf_dir):
    rows = FC.next_hour_features(_inputs(spark, sf_dir), LINEAR.columns, MEDIANS)
    return _rounded(EX.linear_attribution(rows, LINEAR, MEDIANS))


@query
def top_drivers(spark, sf_dir):
    rows = FC.next_hour_features(_inputs(spark, sf_dir), LINEAR.columns, MEDIANS)
    return _rounded(EX.explain("ridge", LINEAR, rows, MEDIANS))


@query
def driver_panel(spark, sf_dir):
    rows = FC.next_hour_features(_inputs(spark, sf_dir), LINEAR.columns, MEDIANS)
    return _rounded(IN.driver_panel(EX.explain("ridge", LINEAR, rows, MEDIANS)))


def _hand_made_tree() -> TR.TreeNodes:
    """Two splits with known covers, so attributions can be said in closed form."""
    import numpy as np

    return TR.TreeNodes(
        columns=("hour", "k"), roots=np.array([0]), feature=np.array([0, 1, -1, -1, -1]),
        threshold=np.array([11.5, 49.5, 0.0, 0.0, 0.0]), left=np.array([1, 2, -1, -1, -1]), right=np.array([4, 3, -1, -1, -1]),
        value=np.array([0.0, 0.0, 10.0, 20.0, 40.0]), cover=np.array([10.0, 6.0, 4.0, 2.0, 4.0]), weights=np.array([1.0]))


@query
def tree_attribution(spark, sf_dir):
    """Attributions of every reading by a tree whose Shapley values are known."""
    rows = _readings(spark, sf_dir).select(
        F.col("ingest_seq").cast("string").alias("city"), F.hour("timestamp").alias("hour"), "k")
    found = EX.tree_attribution(rows, _hand_made_tree())
    return _rounded(found.select(F.col("city").cast("bigint").alias("ingest_seq"), "feature", "attribution", "base", "prediction"))


@query
def tree_attribution_additivity(spark, sf_dir):
    """Next-hour rows explained by both tree families at production size: attributions add up to prediction minus base."""
    fitted = _fitted(spark, sf_dir, ("random_forest", "boosted_trees"))[0].features
    rows = FC.next_hour_features(_inputs(spark, sf_dir), fitted.columns, fitted.medians)
    out = None
    for name in ("random_forest", "boosted_trees"):
        sums = EX.tree_attribution_sums(rows, _nodes(spark, sf_dir, name))
        part = sums.select(F.lit(name).alias("model"), "city",
                           (F.abs(F.col("base") + F.col("total") - F.col("prediction")) < 1e-6).alias("additive"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def model_comparison_next_hour(spark, sf_dir):
    """The same models against the value an hour later: skill, not the same-row fit."""
    def make():
        table = PL.next_hour_target(_features_table(spark, sf_dir))
        return PL.train_and_compare(materialize(table, "next-hour"), _sizes(spark), target="next_aqi")

    trained = _once(spark, sf_dir, "next-hour", make)
    return _verdict(trained.comparison, trained.test).drop("beats_mean")


@query
def sequence_forecast_boosted(spark, sf_dir):
    """Forecasts never leave the range each city's scaler was fitted to."""
    raw = _readings(spark, sf_dir, hourly=True)
    model, scalers, cities, _ = _once(spark, sf_dir, "sequence-boosted", lambda: PL.train_sequences(raw, boosted=True, cfg=_sizes(spark)))
    nodes = TR.nodes_of(spark, model, cities, averaged=False)
    found = FC.sequence_forecast_trees(SQ.seed_windows(IN.recent_clean(raw)), scalers, nodes, cities)
    return _forecast_checked(found, *_value_range(spark, sf_dir))


@query
def sequence_kept_scalers(spark, sf_dir):
    """Trained on early days, served on late ones: the registered scalers are the early ones."""
    raw = _readings(spark, sf_dir, hourly=True)
    early = raw.filter(F.col("timestamp") < _ntz("2024-01-20 00:00:00"))
    model, scalers, cities, metrics = PL.train_sequences(early)
    registry = RG.ModelRegistry(spark, fresh_path(spark, "registry"))
    PL.register_sequence(model, cities, scalers, metrics.first().asDict(), registry)
    row = registry.pick("aqi_sequence")
    served = PL.forecast_all(raw, registry, "Sequence")
    bounds = registry.scalers(row)
    return served.join(bounds, "city").select(
        "city", "timestamp", "step", F.col("predicted_aqi").between(F.col("lo") - 0.05, F.col("hi") + 0.05).alias("in_early_range"),
        F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), F.lit(row["sequence_length"]).alias("sequence_length"))


def _registered(spark, sf_dir, *families: str) -> RG.ModelRegistry:
    """The named families registered; by default all models, the ridge a second time."""
    def make():
        registry = RG.ModelRegistry(spark, fresh_path(spark, "registry"))
        trained = _trained(spark, sf_dir, *families)
        PL.register_all(trained, registry)
        if not families:
            registry.register("aqi_ridge", "ridge", trained.models["ridge"], trained.features, {"rmse": 1e9})
        return registry
    return _once(spark, sf_dir, " ".join(("registry", *families)), make)


@query
def registry_rows(spark, sf_dir):
    return _registered(spark, sf_dir).rows().select("name", "version", "kind", F.col("rmse").isNotNull().alias("measured"))


@query
def model_choice(spark, sf_dir):
    """What each choice shown to users resolves to: name and version, or null where none is registered."""
    registry = _registered(spark, sf_dir)
    rows = []
    for choice, name in PL.MODEL_CHOICES.items():
        try:
            row = registry.pick(name)
            rows.append((choice, row["name"], row["version"]))
        except LookupError:
            rows.append((choice, None, None))
    return spark.createDataFrame(rows, "choice string, name string, version int")


@query
def registry_forecast(spark, sf_dir):
    """Forecast of every city by a model loaded from the registry."""
    found = PL.forecast_all(_raw_wide(spark, sf_dir), _registered(spark, sf_dir, "random_forest"), "Random Forest")
    return _forecast_checked(found, *_value_range(spark, sf_dir))


@query
def explain_next_hour(spark, sf_dir):
    """The explanation job on a registered model: the six strongest features of each city, ranked."""
    found = PL.explain_next_hour(_raw_wide(spark, sf_dir), _registered(spark, sf_dir, "boosted_trees"), "Boosted Trees")
    order = Window.partitionBy("city").orderBy("rank")
    falls = F.coalesce(F.abs("attribution") <= F.lag(F.abs("attribution")).over(order), F.lit(True))
    return found.withColumn("falls", falls).select("city", "rank", "falls", F.col("label").isNotNull().alias("labelled"))


@query
def backfill_job(spark, sf_dir):
    """History documents through the whole job: raw and feature tables stored, repeats harmless."""
    raw = KeyedTable(spark, fresh_path(spark, "backfill-raw"), S.RAW_READINGS)
    history = _history(spark, sf_dir)
    features = KeyedTable(spark, fresh_path(spark, "backfill-features"),
                          FT.engineer_features(spark.createDataFrame([], S.RAW_READINGS)).schema).create()
    for _ in range(2):
        PL.run_backfill(history, raw, features)
    return features.scan().select("city", "timestamp", "aqi", "hour", "day_of_week", "is_weekend", "ingest_seq")


@query
def first_run_and_empty_batches(spark, sf_dir):
    """The refresh job on tables that do not exist yet: with nothing, with all readings, with the same again, with nothing."""
    raw = KeyedTable(spark, fresh_path(spark, "first-raw"), S.RAW_READINGS)
    features = KeyedTable(spark, fresh_path(spark, "first-features"),
                          FT.engineer_features(spark.createDataFrame([], S.RAW_READINGS)).schema).create()
    rows = materialize(AD.raw_readings(_events(spark, sf_dir), hourly=True), "hourly")
    steps = []
    for step, arrived in (("nothing", rows.limit(0)), ("first", rows), ("again", rows), ("empty", rows.limit(0))):
        ran = PL.run_feature_refresh(arrived, raw, features)
        steps.append((step, ran, raw.scan().count(), features.scan().count()))
    return spark.createDataFrame(steps, "step string, ran boolean, readings bigint, features bigint")


# --- streams ---------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    schema = _events(spark, sf_dir).schema
    return ST.read_parquet_stream(spark, sf_dir, schema, "events.parquet")


@query
def stream_ingest(spark, sf_dir):
    table = KeyedTable(spark, fresh_path(spark, "stream-raw"), S.RAW_READINGS).create()
    stream = AD.raw_readings(_event_stream(spark, sf_dir), hourly=True)
    ST.ingest_into(stream, table, fresh_path(spark, "stream-raw-progress")).awaitTermination()
    return table.scan().select("city", "timestamp", "aqi", "ingest_seq")


@query
def stream_hourly_mean(spark, sf_dir):
    """Hours the watermark has closed equal the batch means; open ones are not written yet."""
    out = fresh_path(spark, "stream-hours")
    means = ST.hourly_means(AD.readings(_event_stream(spark, sf_dir)))
    ST.write_available(means, out, fresh_path(spark, "stream-hours-progress"))
    return _rounded(spark.read.schema(means.schema).parquet(out))


@query
def stream_hourly_mean_late(spark, sf_dir):
    """Hours as a stream leaves them that gets every fifth reading after all others, days late."""
    rows, folder = AD.readings(_events(spark, sf_dir)), fresh_path(spark, "late-events")
    late = F.col("k") % 5 == 0
    hours = KeyedTable(spark, fresh_path(spark, "hours"), ST.HOURS, ST.HOURS_SPEC).create()
    progress = fresh_path(spark, "hours-progress")
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(folder)
        ST.hourly_means_into(ST.read_parquet_stream(spark, folder, rows.schema, "*.parquet"), hours, progress).awaitTermination()
    return _rounded(ST.stored_means(hours))


@query
def stream_alerts(spark, sf_dir):
    out = fresh_path(spark, "stream-alerts")
    found = ST.alerts(AD.readings(_event_stream(spark, sf_dir)), _us(AS_OF)).select(
        "city", "timestamp", "aqi", "hazardous", "stale")
    ST.write_available(found, out, fresh_path(spark, "stream-alerts-progress"))
    return spark.read.schema(found.schema).parquet(out)
