"""DuckDB twins of the catalogue queries, written from the semantics and not from the plans."""

from __future__ import annotations

from seriesforge.plans import catalog as K

# Fixed values of the domain, spelled again: a wrong one in the engine then differs from its twin.
DISPLAY_CATEGORIES = [
    (50, "good", "Good", "clean", "#22C58B",
     "A great day to be outside — the air won't hold you back."),
    (100, "moderate", "Moderate", "fair", "#FFC93C",
     "Fine for almost everyone, though a long run might feel heavier than usual."),
    (150, "sensitive", "Unhealthy for sensitive groups", "slightly rough", "#FF7A59",
     "If you have asthma, are older, or are out with small children, take it easy outdoors today."),
    (200, "unhealthy", "Unhealthy", "unhealthy", "#E23F5D",
     "Keep outdoor time short, and a good mask helps if you have to be out for a while."),
    (300, "very-unhealthy", "Very unhealthy", "very unhealthy", "#A855C9",
     "Stay indoors where you can, keep windows shut, and run a purifier if you have one."),
    (1000000, "hazardous", "Hazardous", "hazardous", "#8E1B33",
     "This is dangerous air for everyone — stay inside, seal up windows, and skip outdoor plans."),
]
FEATURE_LABELS = {
    "hour": "Time of day",
    "day_of_week": "Day of the week",
    "month": "Month",
    "is_weekend": "Weekend",
    "is_stale": "Reading freshness",
    "lag_1h_aqi": "AQI an hour ago",
    "lag_3h_aqi": "AQI three hours ago",
    "lag_24h_aqi": "AQI this time yesterday",
    "rolling_3h_mean_aqi": "3-hour average AQI",
    "rolling_3h_std_aqi": "3-hour AQI variability",
    "rolling_24h_mean_aqi": "24-hour average AQI",
    "rolling_24h_std_aqi": "24-hour AQI variability",
    "aqi_change_rate": "Recent rate of change",
}

KNUM = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"


def _r(key: str = "event_type", hourly: bool = False) -> str:
    ts = "date_trunc('hour', ts)" if hourly else "ts"
    return (f"r AS (SELECT CAST({key} AS VARCHAR) AS city, {ts} AS timestamp, value AS aqi, value AS pm25, "
            f"{KNUM} AS k, event_id AS ingest_seq FROM events)")


def _d(key: str = "event_type", hourly: bool = False) -> str:
    """Readings and their keep-last form ``d``."""
    return (_r(key, hourly) + ", d AS (SELECT * FROM r QUALIFY row_number() OVER "
            "(PARTITION BY city, timestamp ORDER BY ingest_seq DESC) = 1)")


def _index(x: str) -> str:
    def segment(lo, hi, a, b):
        return (f"WHEN {x} BETWEEN {lo} AND {hi} THEN CAST(printf('%.1f', "
                f"(CAST({b - a} AS DOUBLE) / ({hi}::DOUBLE - {lo}::DOUBLE)) * ({x} - {lo}::DOUBLE) + {a}) AS DOUBLE)")
    parts = [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200),
             (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400), (350.5, 500.4, 401, 500)]
    return (f"CASE WHEN {x} < 0 THEN NULL " + " ".join(segment(*p) for p in parts)
            + f" WHEN {x} > 500.4 THEN 500.0::DOUBLE END")


def _category(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'Unknown' WHEN {x} <= 50 THEN 'Good' WHEN {x} <= 100 THEN 'Moderate' "
            f"WHEN {x} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {x} <= 200 THEN 'Unhealthy' "
            f"WHEN {x} <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END")


def _display(x: str, field: int) -> str:
    def q(text):
        return "'" + str(text).replace("'", "''") + "'"
    *lower, last = DISPLAY_CATEGORIES
    return ("CASE " + " ".join(f"WHEN {x} <= {c[0]} THEN {q(c[field])}" for c in lower)
            + f" ELSE {q(last[field])} END")


CALENDAR = ("CAST(extract(hour FROM timestamp) AS INTEGER) AS hour, "
            "CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, CAST(month(timestamp) AS INTEGER) AS month, "
            "CAST(isodow(timestamp) >= 6 AS INTEGER) AS is_weekend")

TOLERANCE = {1: "15 MINUTE", 3: "36 MINUTE", 24: "288 MINUTE"}


def _lag_ctes(src: str) -> str:
    """For each lag the ASOF partner on both sides of the target time."""
    out = []
    for h, tol in TOLERANCE.items():
        q = f"(SELECT city, timestamp, timestamp - INTERVAL {h} HOUR AS t FROM {src})"
        out.append(f"b{h} AS (SELECT q.city, q.timestamp, q.t, s.timestamp AS at, s.aqi AS v FROM {q} q "
                   f"ASOF LEFT JOIN {src} s ON q.city = s.city AND q.t >= s.timestamp)")
        out.append(f"f{h} AS (SELECT q.city, q.timestamp, q.t, s.timestamp AS at, s.aqi AS v FROM {q} q "
                   f"ASOF LEFT JOIN {src} s ON q.city = s.city AND q.t <= s.timestamp)")
        out.append(
            f"l{h} AS (SELECT b.city, b.timestamp, CASE WHEN b.t - b.at <= INTERVAL {tol} AND "
            f"(f.at IS NULL OR b.t - b.at <= f.at - b.t) THEN b.v WHEN f.at - b.t <= INTERVAL {tol} THEN f.v END "
            f"AS lag_{h}h_aqi FROM b{h} b JOIN f{h} f USING (city, timestamp))")
    return ", ".join(out)


def _frame(h: int) -> str:
    return (f"(PARTITION BY city ORDER BY timestamp RANGE BETWEEN INTERVAL '{h - 1} hours 59 minutes "
            f"59.999999 seconds' PRECEDING AND CURRENT ROW)")


ROLLING = ", ".join(
    f"round(avg(aqi) OVER {_frame(h)}, 8) AS rolling_{h}h_mean_aqi, "
    f"round(stddev_samp(aqi) OVER {_frame(h)}, 6) AS rolling_{h}h_std_aqi" for h in (3, 24))
_PREV = "lag(aqi) OVER (PARTITION BY city ORDER BY timestamp)"
RATE = f"round((aqi - {_PREV}) / nullif({_PREV}, 0), 6) AS aqi_change_rate"
LAGS = "round(lag_1h_aqi, 6) AS lag_1h_aqi, round(lag_3h_aqi, 6) AS lag_3h_aqi, round(lag_24h_aqi, 6) AS lag_24h_aqi"
JOIN_LAGS = "JOIN l1 USING (city, timestamp) JOIN l3 USING (city, timestamp) JOIN l24 USING (city, timestamp)"


def _features(source: str, columns: str) -> str:
    return (f"WITH {source}, {_lag_ctes('d')} SELECT {columns}, {CALENDAR}, {LAGS}, "
            f"{ROLLING}, {RATE} FROM d {JOIN_LAGS}")


def _asof(side: str) -> str:
    """(left, view) pairs of one direction."""
    op = ">=" if side == "b" else "<="
    return (f"{side} AS (SELECT p.user_id, p.event_id, p.ts, v.event_id AS view_id, v.value AS view_value, v.ts AS seen "
            f"FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN "
            f"(SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts {op} v.ts)")


def _one_way(side: str) -> str:
    gap = "ts - seen" if side == "b" else "seen - ts"
    return (f"WITH {_asof(side)} SELECT user_id, event_id, CASE WHEN {gap} <= INTERVAL 24 HOUR THEN view_id END "
            f"AS view_id, CASE WHEN {gap} <= INTERVAL 24 HOUR THEN view_value END AS view_value FROM {side}")


def _raw_wide(name: str = "w") -> str:
    k = KNUM
    return (f"{name} AS (SELECT event_type AS city, event_id AS ingest_seq, value AS aqi, "
            f"CASE WHEN {k} % 3 = 0 THEN {k} / 2.0::DOUBLE END AS temp, "
            f"CASE WHEN {k} % 4 = 0 THEN CAST({k} AS DOUBLE) END AS humidity, "
            f"CASE WHEN {k} % 3 <> 0 THEN 1000.0::DOUBLE + {k} END AS pressure, 3.5::DOUBLE AS wind_speed, "
            f"NULL::DOUBLE AS no2, {k} < 10 AS is_stale FROM events)")


def _current(extra: str = "") -> str:
    """Accepted current readings, straight from the events."""
    k = KNUM
    return (f"c AS (SELECT event_type AS city, event_id AS poll_id, event_type || ' station' AS matched_station, "
            f"CASE WHEN {k} % 25 <> 7 THEN date_trunc('second', ts) ELSE ts END AS timestamp, value AS aqi, "
            f"'pm25' AS dominant_pollutant, value AS pm25, value * 2 AS pm10, NULL::DOUBLE AS no2, "
            f"CASE WHEN {k} % 2 = 0 THEN ({k} / 2)::DOUBLE END AS aqicn_temp, CAST({k} AS DOUBLE) AS aqicn_humidity, "
            f"{k} AS k, value, event_id FROM events WHERE {k} % 17 <> 3){extra}")


WEATHER = (", m AS (SELECT city, poll_id, timestamp, matched_station, aqi, "
           "CASE WHEN event_id % 3 <> 0 AND k % 4 = 0 THEN CAST(k AS DOUBLE) ELSE aqicn_temp END AS temp, "
           "CASE WHEN event_id % 3 <> 0 AND k % 5 <> 0 THEN CAST(k * 1.5 AS DOUBLE) ELSE aqicn_humidity END AS humidity, "
           "CASE WHEN event_id % 3 <> 0 THEN 1013.0::DOUBLE END AS pressure, "
           "CASE WHEN event_id % 3 <> 0 THEN k / 10.0::DOUBLE END AS wind_speed FROM c)")

HISTORY = ("h AS (SELECT event_type AS city, event_id AS poll_id, date_trunc('second', ts) AS timestamp, value AS pm25 "
           "FROM events UNION ALL SELECT event_type, event_id, date_trunc('second', ts) - INTERVAL 1 HOUR, value / 2 "
           "FROM events)")

TWO_PARTS = ("p AS (SELECT city, timestamp, aqi * 2 AS aqi FROM d), "
             "late AS (SELECT * FROM p WHERE timestamp >= TIMESTAMP '2024-01-28 00:00:00'), "
             "early AS (SELECT * FROM p WHERE timestamp < TIMESTAMP '2024-01-28 00:00:00')")
LOCAL_DAY = "date_trunc('day', timestamp + INTERVAL 5 HOUR)"
AS_OF = f"TIMESTAMP '{K.AS_OF}'"


def _seq_ctes() -> str:
    steps = ("g AS (SELECT *, floor(date_diff('microsecond', lag(timestamp) OVER o, timestamp) / 60000000.0) AS step "
             "FROM d WINDOW o AS (PARTITION BY city ORDER BY timestamp)), "
             "s AS (SELECT city, timestamp AS target_ts, aqi AS y, "
             "list(aqi) OVER (o ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS x, "
             "sum(CAST(abs(step - 60) <= 15 AS INTEGER)) OVER (o ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS good, "
             "row_number() OVER o AS rn FROM g WINDOW o AS (PARTITION BY city ORDER BY timestamp)), "
             "q AS (SELECT city, target_ts, x, y FROM s WHERE rn > 24 AND good = 24)")
    return steps


def _history_lists() -> str:
    """Newest reading per series and the readings of the last 72 hours as lists."""
    return ("z AS (SELECT city, max(timestamp) AS last_ts, arg_max(aqi, timestamp) AS last_v FROM d GROUP BY city), "
            "hist AS (SELECT d.city, z.last_ts, z.last_v, list(epoch_us(d.timestamp) ORDER BY d.timestamp) AS us, "
            "list(d.aqi ORDER BY d.timestamp) AS v FROM d JOIN z USING (city) "
            "WHERE d.timestamp >= z.last_ts - INTERVAL 72 HOUR GROUP BY d.city, z.last_ts, z.last_v)")


def _measured(source: str) -> str:
    """Per series and step 1..24: the nearest measured value per lag (joined, not folded)."""
    parts = []
    for h, tol in TOLERANCE.items():
        parts.append(
            f"n{h} AS (SELECT s.city, s.k, arg_min(d.aqi, abs(epoch_us(d.timestamp) - s.us + {h * 3600000000}) * 2 "
            f"+ CAST(epoch_us(d.timestamp) > s.us - {h * 3600000000} AS BIGINT)) AS v FROM steps s JOIN d ON "
            f"d.city = s.city AND d.timestamp BETWEEN s.t - INTERVAL {h} HOUR - INTERVAL {tol} "
            f"AND s.t - INTERVAL {h} HOUR + INTERVAL {tol} WHERE s.k <= {h} GROUP BY s.city, s.k)")
    for h in (3, 24):
        parts.append(
            f"w{h} AS (SELECT s.city, s.k, list(d.aqi) AS v FROM steps s JOIN d ON d.city = s.city AND "
            f"d.timestamp > s.t - INTERVAL {h} HOUR AND d.timestamp <= s.t GROUP BY s.city, s.k)")
    joins = " ".join(f"LEFT JOIN n{h} ON n{h}.city = s.city AND n{h}.k = s.k" for h in TOLERANCE)
    joins += " " + " ".join(f"LEFT JOIN w{h} ON w{h}.city = s.city AND w{h}.k = s.k" for h in (3, 24))
    return (f"{source}, z AS (SELECT city, max(timestamp) AS last_ts, arg_max(aqi, timestamp) AS last_v FROM d "
            "GROUP BY city), steps AS (SELECT city, last_ts, last_v, CAST(k AS INTEGER) AS k, "
            "last_ts + to_hours(CAST(k AS INTEGER)) AS t, epoch_us(last_ts + to_hours(CAST(k AS INTEGER))) AS us "
            "FROM z, range(1, 73) g(k)), "
            + ", ".join(parts)
            + ", measured AS (SELECT s.city, s.k, s.t, s.last_v, n1.v AS l1, n3.v AS l3, n24.v AS l24, "
              "coalesce(w3.v, []::DOUBLE[]) AS w3, coalesce(w24.v, []::DOUBLE[]) AS w24 FROM steps s " + joins + ")")


def _row(k: str, preds: str) -> dict[str, str]:
    """Feature expressions at step k over ``measured`` m and the list of earlier forecasts."""
    m = K.MEDIANS

    def lag(h):
        return f"(CASE WHEN {k} <= {h} THEN m.l{h} ELSE {preds}[{k} - {h}] END)"

    def window(h):
        return f"list_concat(m.w{h}, list_slice({preds}, greatest(1, {k} - {h} + 1), {k} - 1))"

    newest = f"(CASE WHEN {k} = 1 THEN m.last_v ELSE {preds}[{k} - 1] END)"
    row = {"hour": "CAST(extract(hour FROM m.t) AS DOUBLE)", "is_weekend": "CAST(isodow(m.t) >= 6 AS DOUBLE)",
           "city_click": "CAST(m.city = 'click' AS DOUBLE)"}
    for h in TOLERANCE:
        row[f"lag_{h}h_aqi"] = f"coalesce({lag(h)}, {m[f'lag_{h}h_aqi']})"
    for h in (3, 24):
        row[f"rolling_{h}h_mean_aqi"] = f"coalesce(list_avg({window(h)}), {m[f'rolling_{h}h_mean_aqi']})"
        row[f"rolling_{h}h_std_aqi"] = (f"(CASE WHEN len({window(h)}) > 1 THEN list_stddev_pop({window(h)}) "
                                        f"ELSE {m[f'rolling_{h}h_std_aqi']} END)")
    row["aqi_change_rate"] = f"coalesce(({newest} - {lag(1)}) / nullif({lag(1)}, 0), {m['aqi_change_rate']})"
    return row


def _linear_forecast(source: str) -> str:
    row = _row("f.k + 1", "f.preds")
    score = f"{K.LINEAR.intercept}" + "".join(
        f" + {w} * {row[c]}" for c, w in zip(K.LINEAR.columns, K.LINEAR.coefficients))
    return (f"WITH RECURSIVE {_measured(source)}, f AS (SELECT city, 0 AS k, []::DOUBLE[] AS preds FROM z UNION ALL "
            f"SELECT f.city, f.k + 1, list_append(f.preds, greatest(0::DOUBLE, CAST({score} AS DOUBLE))) FROM f "
            f"JOIN measured m ON m.city = f.city AND m.k = f.k + 1 WHERE f.k < 72), "
            f"o AS (SELECT city, k AS step, preds[k] AS value FROM f WHERE k > 0)")


def _next_row() -> str:
    row = _row("1", "([]::DOUBLE[])")
    return (f"WITH {_measured(_d())}, x AS (SELECT m.city, m.t AS timestamp, "
            + ", ".join(f"{row[c]} AS {c}" for c in K.LINEAR.columns) + " FROM measured m WHERE m.k = 1)")


def _attributions() -> str:
    parts = " UNION ALL ".join(
        f"SELECT city, {i} AS position, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
        f"CAST({w} * ({c} - {K.MEDIANS[c]}) AS DOUBLE) AS attribution FROM x"
        for i, (c, w) in enumerate(zip(K.LINEAR.columns, K.LINEAR.coefficients)))
    return _next_row() + f", a AS ({parts})"


def _drivers() -> str:
    label = "CASE feature " + " ".join(f"WHEN '{f}' THEN '{t}'" for f, t in FEATURE_LABELS.items()) + " ELSE feature END"
    return (_attributions() + ", t AS (SELECT city, CAST(row_number() OVER (PARTITION BY city ORDER BY "
            "abs(attribution) DESC, position) AS INTEGER) AS rank, feature, CASE WHEN feature = 'city_click' "
            f"THEN 'Being in ' || city ELSE {label} END AS label, value, attribution FROM a "
            "WHERE feature <> 'city_click' OR city = 'click'), top AS (SELECT * FROM t WHERE rank <= 6)")


def _ridge() -> str:
    # Centred normal equations of two features with 1.0 added to the diagonal.
    return ("WITH b AS (SELECT CAST(extract(hour FROM ts) AS DOUBLE) AS h, CAST(" + KNUM + " AS DOUBLE) AS k, "
            "value AS y FROM events), c AS (SELECT count(*) * covar_pop(h, h) + 1.0 AS hh, "
            "count(*) * covar_pop(k, k) + 1.0 AS kk, count(*) * covar_pop(h, k) AS hk, count(*) * covar_pop(h, y) AS hy, "
            "count(*) * covar_pop(k, y) AS ky, avg(h) AS mh, avg(k) AS mk, avg(y) AS my FROM b), "
            "w AS (SELECT (hy * kk - ky * hk) / (hh * kk - hk * hk) AS wh, (ky * hh - hy * hk) / (hh * kk - hk * hk) "
            "AS wk, mh, mk, my FROM c) SELECT 'hour' AS term, round(wh, 6) AS weight FROM w UNION ALL "
            "SELECT 'k', round(wk, 6) FROM w UNION ALL SELECT 'intercept', round(my - wh * mh - wk * mk, 6) FROM w")


def _registry() -> str:
    return ("g AS (SELECT 'aqi_' || event_type AS name, k + 1 AS version, "
            "avg(CASE WHEN k % 2 = 1 THEN value END) AS rmse, "
            "CASE WHEN event_type = 'view' THEN 'sequence' ELSE 'ridge' END AS kind FROM "
            f"(SELECT *, {KNUM} AS k FROM events) GROUP BY event_type, k), "
            "l AS (SELECT name, version, rmse, kind FROM g QUALIFY row_number() OVER "
            "(PARTITION BY name ORDER BY version DESC) = 1)")


def _sequence_forecast() -> str:
    weights = "[" + ", ".join(str(w) for w in K.SEQ_WEIGHTS) + "]::DOUBLE[]"
    own = "CASE city " + " ".join(f"WHEN '{c}' THEN {w}" for c, w in K.SEQ_CITY.items()) + " ELSE 0 END"
    return (f"WITH RECURSIVE {_d()}, {_history_lists()}, sc AS (SELECT city, min(aqi) AS lo, max(aqi) AS hi FROM d "
            "GROUP BY city), f AS (SELECT hist.city, 0 AS k, list_transform(v[len(v) - 23:], lambda e: "
            "(e - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END) AS x, lo, hi FROM hist JOIN sc USING (city) "
            "WHERE len(v) >= 24 UNION ALL SELECT city, k + 1, list_append(x, least(1::DOUBLE, greatest(0::DOUBLE, "
            f"list_inner_product(x[len(x) - 23:], {weights}) + {K.SEQ_INTERCEPT} + {own}))), lo, hi FROM f WHERE k < 72) "
            "SELECT city, k AS step, round(greatest(0::DOUBLE, x[len(x)] * CASE WHEN hi = lo THEN 1 ELSE hi - lo END "
            "+ lo), 6) AS value FROM f WHERE k > 0")


def _forecast_places(ts: str) -> str:
    """Each city's 72 hours after its last reading; range, category and hazard flag have to fit."""
    return (f"SELECT event_type AS city, max({ts}) + to_hours(step) AS timestamp, CAST(step AS INTEGER) AS step, "
            "true AS in_range, true AS category_fits, true AS hazard_fits FROM events, range(1, 73) s(step) "
            "GROUP BY event_type, step")


def oracle_sql() -> dict[str, str]:
    stats = ("round(avg(aqi), 10) AS mean, round(median(aqi), 6) AS median, round(min(aqi), 6) AS min, "
             "round(max(aqi), 6) AS max, round(stddev_samp(aqi), 6) AS std, count(aqi) AS count")
    upserted = (f"WITH {_d(hourly=True)} ")
    many = "city, timestamp, aqi, ingest_seq"
    out = {
        "dedupe_keep_last": f"WITH {_d(hourly=True)} SELECT * FROM d",
        "dedupe_metrics": f"WITH {_r(hourly=True)} SELECT city, count(*) AS rows_in, count(DISTINCT timestamp) AS "
                          "rows_kept, count(*) - count(DISTINCT timestamp) AS rows_dropped FROM r GROUP BY city",
        "time_features": f"WITH {_r()} SELECT city, timestamp, ingest_seq, {CALENDAR} FROM r",
        "pm25_to_aqi": f"SELECT event_id AS ingest_seq, value AS pm25, {_index('value')} AS index FROM events",
        "pm25_to_aqi_range_join":
            "WITH b(segment, lo, hi, a, z) AS (VALUES (0, 0.0::DOUBLE, 12.0::DOUBLE, 0, 50), (1, 12.1, 35.4, 51, 100), "
            "(2, 35.5, 55.4, 101, 150), (3, 55.5, 150.4, 151, 200), (4, 150.5, 250.4, 201, 300), "
            "(5, 250.5, 350.4, 301, 400), (6, 350.5, 500.4, 401, 500)) SELECT event_id AS ingest_seq, value AS pm25, "
            f"CAST(segment AS INTEGER) AS segment, {_index('value')} AS index FROM events LEFT JOIN b "
            "ON value BETWEEN lo AND hi",
        "aqi_category": f"WITH {_r()}, x AS (SELECT ingest_seq, CASE WHEN k % 10 <> 0 THEN aqi * 2 END AS v FROM r) "
                        f"SELECT ingest_seq, {_category('v')} AS category, coalesce(v >= 150, false) AS hazardous FROM x",
        "category_attributes": "SELECT event_id AS ingest_seq, " + ", ".join(
            f"{_display('value * 2', i)} AS {n}" for i, n in (
                (1, "category_key"), (2, "category_label"), (3, "category_phrase"), (4, "color"), (5, "guidance")))
            + " FROM events",
        "resolve_aqi": f"WITH {_r()} SELECT ingest_seq, CASE WHEN k % 10 = 2 THEN NULL WHEN k % 10 < 4 THEN pm25 / 2 "
                       "ELSE aqi END AS resolved FROM r",
        "staleness_flag": f"WITH {_r()} SELECT ingest_seq, CASE WHEN k % 20 = 0 THEN true ELSE "
                          f"{AS_OF} - timestamp > INTERVAL 3 HOUR END AS is_stale FROM r",
        "station_match": f"WITH {_r()} SELECT ingest_seq, CASE k % 4 WHEN 0 THEN city <> 'click' WHEN 1 THEN "
                         "city = 'click' ELSE false END AS station_ok FROM r",
        "numeric_coercion": f"WITH {_r()} SELECT ingest_seq, CASE WHEN k >= 10 THEN aqi END AS aqi, "
                            "NULL::DOUBLE AS lag_1h_aqi FROM r",
        "display_formats": "SELECT event_id AS ingest_seq, strftime(ts, '%a %-d %b') AS day, strftime(ts, '%H:%M') AS "
                           "clock, strftime(ts, '%A') AS weekday, strftime(ts, '%d %b, %H:%M UTC') AS reading, "
                           "ts + INTERVAL 5 HOUR AS local, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso FROM events",
        "current_flatten": f"WITH {_current()} SELECT city, poll_id, matched_station, timestamp, round(aqi, 6) AS aqi, "
                           "dominant_pollutant, round(pm25, 6) AS pm25, round(pm10, 6) AS pm10, no2, aqicn_temp, "
                           "aqicn_humidity FROM c",
        "status_quarantine": f"SELECT event_type AS city, event_id AS poll_id, 'error' AS status FROM events "
                             f"WHERE {KNUM} % 17 = 3",
        "weather_fallback": f"WITH {_current(WEATHER)} SELECT city, poll_id, temp, humidity, pressure, wind_speed FROM m",
        "current_snapshot": f"WITH {_current(WEATHER)} SELECT city, poll_id, aqi, temp, "
                            f"{AS_OF} - timestamp > INTERVAL 3 HOUR AS is_stale, true AS station_ok FROM m",
        "snapshot_of_configured_cities":
            f"WITH {_current(WEATHER)}, d(event_type, city, station, lat, lon) AS (VALUES "
            "('click', 'Lahore', 'lahore', 31.5497::DOUBLE, 74.3436::DOUBLE), ('view', 'Karachi', 'karachi', 24.8607, 67.0011), "
            "('purchase', 'Quetta', 'A544306', 30.1798, 66.9750)) SELECT d.city, poll_id, aqi, temp, "
            f"{AS_OF} - timestamp > INTERVAL 3 HOUR AS is_stale, station, lat, lon FROM m JOIN d ON m.city = d.event_type",
        "first_run_and_empty_batches":
            f"WITH {_d(hourly=True)}, n AS (SELECT count(*) AS n FROM d) SELECT step, ran, CASE WHEN full_ THEN n ELSE 0 END AS readings, "
            "CASE WHEN full_ THEN n ELSE 0 END AS features FROM n, (VALUES ('nothing', false, false), ('first', true, true), "
            "('again', false, true), ('empty', false, true)) s(step, ran, full_)",
        "history_explode": f"WITH {HISTORY} SELECT city, poll_id, timestamp, pm25, pm25 * 2 AS pm10, NULL::DOUBLE AS no2 "
                           "FROM h WHERE timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND "
                           "TIMESTAMP '2024-01-25 00:00:00'",
        "landing_by_day": f"WITH {HISTORY} SELECT city, poll_id, timestamp, pm25, pm25 * 2 AS pm10, NULL::DOUBLE AS no2 "
                          "FROM h WHERE timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND "
                          "TIMESTAMP '2024-01-25 00:00:00'",
        "landing_broken_lines": f"SELECT '{{\"city\":\"' || event_type || '\",\"poll_id\":' || event_id AS line FROM events "
                                f"WHERE {KNUM} % 17 = 3 UNION ALL SELECT event_type || ' ' || count(*) AS line FROM events "
                                f"WHERE {KNUM} % 17 <> 3 GROUP BY event_type",
        "backfill": f"WITH {HISTORY}, x AS (SELECT *, {_index('pm25')} AS aqi FROM h), y AS (SELECT * FROM x WHERE "
                    "aqi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY city, timestamp ORDER BY poll_id DESC) = 1) "
                    "SELECT city, timestamp, aqi, pm25, 'pm25' AS dominant_pollutant, city || "
                    "' (OpenWeather historical)' AS matched_station, false AS is_stale, NULL::DOUBLE AS temp, "
                    "poll_id AS ingest_seq FROM y",
        "asof_lags": f"WITH {_d()}, {_lag_ctes('d')} SELECT {many}, lag_1h_aqi, lag_3h_aqi, lag_24h_aqi FROM d {JOIN_LAGS}",
        "rolling_stats": f"WITH {_r()} SELECT city, timestamp, round(aqi, 6) AS aqi, ingest_seq, {ROLLING} FROM r",
        "change_rate": f"WITH {_r()} SELECT city, timestamp, round(aqi, 6) AS aqi, ingest_seq, {RATE} FROM r",
        "engineer_features": _features(_d(hourly=True), "city, timestamp, round(aqi, 6) AS aqi, round(pm25, 6) AS pm25, "
                                                        "k, ingest_seq"),
        "engineer_features_many_series": _features(_d("user_id"), "city, timestamp, round(aqi, 6) AS aqi, ingest_seq"),
        "engineer_features_cells": _features(_d(hourly=True), "city, timestamp, round(aqi, 6) AS aqi, round(pm25, 6) AS pm25, "
                                                              "k, ingest_seq"),
        "incremental_refresh": _features(_d(), "city, timestamp, round(aqi, 6) AS aqi, ingest_seq"),
        "asof_join_backward": _one_way("b"),
        "asof_join_forward": _one_way("f"),
        "asof_join_nearest":
            f"WITH {_asof('b')}, {_asof('f')}, j AS (SELECT b.user_id, b.event_id, b.ts - b.seen AS gb, f.seen - f.ts AS gf, "
            "b.view_id AS vb, f.view_id AS vf, b.view_value AS xb, f.view_value AS xf FROM b JOIN f USING (event_id)), "
            "u AS (SELECT *, gb IS NOT NULL AND (gf IS NULL OR gb <= gf) AS back FROM j) SELECT user_id, event_id, "
            "CASE WHEN back AND gb <= INTERVAL 24 HOUR THEN vb WHEN NOT back AND gf <= INTERVAL 24 HOUR THEN vf END AS "
            "view_id, CASE WHEN back AND gb <= INTERVAL 24 HOUR THEN xb WHEN NOT back AND gf <= INTERVAL 24 HOUR THEN xf "
            "END AS view_value FROM u",
        "next_hour_target":
            f"WITH {_r()}, q AS (SELECT *, timestamp + INTERVAL 1 HOUR AS t FROM r), "
            "b AS (SELECT q.ingest_seq, q.t - s.timestamp AS g, s.aqi AS v FROM q ASOF LEFT JOIN r s ON q.city = s.city "
            "AND q.t >= s.timestamp), f AS (SELECT q.ingest_seq, s.timestamp - q.t AS g, s.aqi AS v FROM q ASOF LEFT JOIN "
            "r s ON q.city = s.city AND q.t <= s.timestamp) SELECT city, timestamp, aqi, ingest_seq, CASE WHEN "
            "b.g <= INTERVAL 15 MINUTE AND (f.g IS NULL OR b.g <= f.g) THEN b.v WHEN f.g <= INTERVAL 15 MINUTE THEN f.v "
            "END AS next_aqi FROM r JOIN b USING (ingest_seq) JOIN f USING (ingest_seq)",
        "raw_upsert": upserted + "SELECT city, timestamp, aqi, CASE WHEN k % 3 = 0 THEN k / 2.0::DOUBLE END AS temp, "
                                 "k < 10 AS is_stale, ingest_seq FROM d",
        "history_union": upserted + "SELECT city, timestamp, aqi, k, ingest_seq, CASE WHEN timestamp >= TIMESTAMP "
                                    "'2024-01-15 00:00:00' THEN pm25 END AS pm25 FROM d",
        "city_summary": f"WITH {_d()} SELECT city, {stats} FROM d GROUP BY city",
        "city_summary_many_series": f"WITH {_d('user_id')} SELECT city, {stats} FROM d GROUP BY city",
        "daily_trend": f"WITH {_d()} SELECT city, date_trunc('day', timestamp)::TIMESTAMP AS day, round(avg(aqi), 6) "
                       "AS aqi FROM d GROUP BY ALL",
        "hourly_pattern": f"WITH {_d()}, a AS (SELECT hour(timestamp) AS hour, avg(aqi) AS aqi FROM d GROUP BY ALL) "
                          "SELECT CAST(h AS INTEGER) AS hour, round(aqi, 6) AS aqi FROM range(24) s(h) LEFT JOIN a "
                          "ON a.hour = h",
        "hourly_pattern_per_series":
            f"WITH {_d('user_id')}, a AS (SELECT city, hour(timestamp) AS hour, avg(aqi) AS aqi FROM d GROUP BY ALL) "
            "SELECT c.city, CAST(h AS INTEGER) AS hour, round(aqi, 6) AS aqi FROM (SELECT DISTINCT city FROM d) c, "
            "range(24) s(h) LEFT JOIN a ON a.hour = h AND a.city = c.city",
        "weekday_pattern": f"WITH {_d()}, a AS (SELECT isodow(timestamp) - 1 AS w, avg(aqi) AS aqi FROM d "
                           "WHERE city = 'view' GROUP BY ALL) SELECT CAST(h AS INTEGER) AS day_of_week, round(aqi, 6) "
                           "AS aqi FROM range(7) s(h) LEFT JOIN a ON a.w = h",
        "freshness": f"WITH {_d()} SELECT city, count(timestamp) AS reading_count, max(timestamp) AS latest_reading, "
                     f"round(date_diff('microsecond', max(timestamp), {AS_OF}) / 3600000000.0::DOUBLE, 6) AS "
                     "hours_since_latest FROM d GROUP BY city",
        "freshness_view": f"WITH {_d()} SELECT city AS \"City\", count(*) AS \"Readings collected\", "
                          "strftime(max(timestamp), '%d %b, %H:%M UTC') AS \"Latest reading\", CAST(printf('%.1f', "
                          f"date_diff('microsecond', max(timestamp), {AS_OF}) / 3600000000.0::DOUBLE) AS DOUBLE) AS "
                          "\"Hours ago\" FROM d GROUP BY city",
        "latest_reading": f"WITH {_d('user_id')} SELECT city, max(timestamp) AS timestamp, arg_max(aqi, timestamp) AS aqi "
                          "FROM d GROUP BY city",
        "recent_history": f"WITH {_d()} SELECT city, timestamp, aqi FROM d QUALIFY timestamp >= max(timestamp) OVER "
                          "(PARTITION BY city) - INTERVAL 72 HOUR",
        "daily_means_local": f"WITH {_d()} SELECT city, {LOCAL_DAY}::TIMESTAMP AS day, round_even(avg(aqi), 0) AS aqi "
                             "FROM d GROUP BY ALL",
        "peak_alert": f"WITH {_d()}, {TWO_PARTS}, t AS (SELECT city, arg_max(timestamp, (aqi, -epoch_us(timestamp))) AS "
                      "peak_time, max(aqi) AS peak FROM late GROUP BY city), u AS (SELECT *, "
                      "CAST(round_even(peak, 0) AS BIGINT) AS peak_index FROM t) SELECT city, peak_time, peak, peak_index, "
                      f"lower({_display('peak_index', 2)}) AS category_label FROM u WHERE peak_index >= 150",
        "measured_forecast_bridge":
            f"WITH {_d()}, {TWO_PARTS}, m AS (SELECT city, {LOCAL_DAY}::TIMESTAMP AS day, round_even(avg(aqi), 0) AS aqi "
            f"FROM early GROUP BY ALL), n AS (SELECT city, {LOCAL_DAY}::TIMESTAMP AS day, round_even(avg(aqi), 0) AS aqi "
            "FROM late GROUP BY ALL) SELECT *, 'measured' AS kind FROM m UNION ALL SELECT *, 'forecast' FROM n UNION ALL "
            "SELECT *, 'forecast' FROM (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY city ORDER BY day DESC) = 1)",
        "hourly_forecast_table":
            f"WITH {_d()}, {TWO_PARTS}, x AS (SELECT city, timestamp + INTERVAL 5 HOUR AS local_time, "
            "CAST(round_even(aqi, 0) AS BIGINT) AS i FROM late) SELECT city, local_time, strftime(local_time, '%a %-d %b') AS \"Day\", "
            f"strftime(local_time, '%H:%M') AS \"Time\", i AS \"AQI\", {_display('i', 2)} AS \"How it feels\" FROM x",
        "null_fraction_prune": f"WITH {_raw_wide()}, u AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS DOUBLE)) AS null_fraction FROM w" for c in K._WIDE)
            + ") SELECT column_name, round(null_fraction, 6) AS null_fraction, null_fraction <= 0.5 AS kept FROM u",
        "feature_medians": f"WITH {_raw_wide()} " + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(median({c}), 6) AS median FROM w"
            for c in ("temp", "humidity", "pressure", "wind_speed", "aqi")),
        "one_hot": "SELECT event_id AS ingest_seq, CAST(event_type = 'click' AS DOUBLE) AS city_click, "
                   "CAST(event_type = 'error' AS DOUBLE) AS city_error, 0::DOUBLE AS city_nowhere FROM events",
        "time_split": f"WITH {_r(hourly=True)} SELECT ingest_seq, row_number() OVER (ORDER BY timestamp, city, ingest_seq) "
                      "<= floor((SELECT count(*) FROM r) * (1 - 0.2::DOUBLE)) AS is_train FROM r",
        "minmax_scale": f"WITH {_r()} SELECT ingest_seq, round((aqi - min(aqi) OVER p) / (max(aqi) OVER p - min(aqi) "
                        "OVER p), 9) AS scaled FROM r WINDOW p AS (PARTITION BY city)",
        "inverse_scale": "SELECT event_id AS ingest_seq, round(value, 6) AS restored FROM events",
        "missing_scalers": "SELECT CAST(user_id AS VARCHAR) AS city FROM events GROUP BY user_id HAVING max(value) <= 250",
        "sequences": f"WITH {_d(hourly=True)}, {_seq_ctes()} SELECT city, target_ts, array_to_string(x, ',') AS x, y FROM q",
        "sequence_split": f"WITH {_d(hourly=True)}, {_seq_ctes()} SELECT city, target_ts, row_number() OVER (PARTITION BY "
                          "city ORDER BY target_ts) <= floor(count(*) OVER (PARTITION BY city) * (1 - 0.2::DOUBLE)) "
                          "AS is_train FROM q",
        "seed_windows":
            f"WITH {_d('user_id')}, n AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS rn "
            "FROM d), t AS (SELECT *, abs(floor(date_diff('microsecond', lag(timestamp) OVER (PARTITION BY city ORDER BY "
            "timestamp), timestamp) / 60000000.0) - 60) > 15 AS gap FROM n WHERE rn <= 24) SELECT city, "
            "epoch_us(max(timestamp)) AS last_us, array_to_string(list(aqi ORDER BY timestamp), ',') AS x, "
            "bool_or(coalesce(gap, false)) AS seed_has_gap FROM t GROUP BY city HAVING count(*) = 24",
        "ridge_fit": _ridge(),
        "metrics": f"WITH {_d()}, {_lag_ctes('d')}, e AS (SELECT city, aqi AS y, lag_1h_aqi AS p FROM d JOIN l1 USING "
                   "(city, timestamp) WHERE lag_1h_aqi IS NOT NULL) SELECT city, count(*) AS n, "
                   "round(sqrt(avg((p - y) ** 2)), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae, "
                   "round(1 - sum((p - y) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM e GROUP BY city",
        "latest_model_versions": f"WITH {_registry()} SELECT name, version, round(rmse, 6) AS rmse, kind FROM l",
        "best_model": f"WITH {_registry()} SELECT name, version, round(rmse, 6) AS rmse, kind FROM l WHERE "
                      "kind <> 'sequence' ORDER BY coalesce(rmse, 'inf'::DOUBLE), name LIMIT 1",
        "next_hour_features": _next_row() + " SELECT city, timestamp, " + ", ".join(
            f"round(CAST({c} AS DOUBLE), {8 if 'h_mean' in c else 6}) AS {c}" for c in K.LINEAR.columns) + " FROM x",
        "recursive_forecast_linear": _linear_forecast(_d()) + f" SELECT city, step, round(value, 6) AS value, "
                                     f"{_category('value')} AS category, value >= 150 AS hazardous FROM o",
        "recursive_forecast_many_series": _linear_forecast(_d("user_id"))
            + " SELECT city, step, round(value, 6) AS value FROM o",
        "sequence_forecast": _sequence_forecast(),
        "linear_attribution": _attributions() + " SELECT city, position, feature, round(value, 6) AS value, "
                              "round(attribution, 6) AS attribution FROM a",
        "top_drivers": _drivers() + " SELECT city, rank, feature, label, round(value, 6) AS value, "
                       "round(attribution, 6) AS attribution FROM top",
        "driver_panel": _drivers() + " SELECT city, rank, label, round(least(100::DOUBLE, 100 * abs(attribution) / "
                        "max(abs(attribution)) OVER (PARTITION BY city)), 6) AS width_pct, CASE WHEN attribution > 0 "
                        "THEN '▲' ELSE '▼' END AS arrow, CASE WHEN attribution > 0 THEN 'Adds about ' ELSE 'Cuts about ' "
                        "END || CAST(CAST(round_even(abs(attribution), 0) AS BIGINT) AS VARCHAR) AS phrase FROM top",
        "timestamp_normalise": f"WITH {_r()} SELECT ingest_seq, CASE k % 3 WHEN 0 THEN date_trunc('second', timestamp) - "
                               "INTERVAL 5 HOUR WHEN 1 THEN date_trunc('second', timestamp) END AS timestamp FROM r",
        "series_counts": "SELECT count(*) AS rows, count(DISTINCT user_id) AS series FROM events",
        "forecast_view": _linear_forecast(_d()) + " SELECT city, last_ts + to_hours(CAST(step AS INTEGER)) + "
                         "INTERVAL 5 HOUR AS time, CAST(printf('%.1f', value) AS DOUBLE) AS aqi FROM o JOIN z "
                         "USING (city) WHERE step <= 24",
        "tree_attribution_additivity": "SELECT m AS model, city, true AS additive FROM (SELECT DISTINCT event_type AS city "
                                       "FROM events), (VALUES ('random_forest'), ('boosted_trees')) t(m)",
        # The tree: hour <= 11.5 (6 of 10 rows), then k <= 49.5 (4 of 6) gives 10, else 20; otherwise 40.
        "tree_attribution":
            f"WITH r AS (SELECT event_id AS ingest_seq, extract(hour FROM ts) AS h, {KNUM} AS k FROM events), "
            "g AS (SELECT ingest_seq, 24.0::DOUBLE AS base, CASE WHEN h <= 11.5 THEN 40.0::DOUBLE / 3 ELSE 40 END AS vh, "
            "0.6::DOUBLE * CASE WHEN k <= 49.5 THEN 10 ELSE 20 END + 16 AS vk, CASE WHEN h > 11.5 THEN 40.0::DOUBLE "
            "WHEN k <= 49.5 THEN 10 ELSE 20 END AS v FROM r) SELECT ingest_seq, feature, round(CASE feature WHEN 'hour' "
            "THEN (vh - base + v - vk) / 2 ELSE (vk - base + v - vh) / 2 END, 6) AS attribution, base, v AS prediction "
            "FROM g, (VALUES ('hour'), ('k')) t(feature)",
        "model_comparison": f"WITH {_d()}, c AS (SELECT count(*) AS n FROM d) SELECT m AS model, CAST(n - floor(n * (1 - "
                            "0.2::DOUBLE)) AS BIGINT) AS n, true AS consistent FROM c, "
                            "(VALUES ('ridge'), ('random_forest'), ('boosted_trees')) t(m)",
        "model_comparison_next_hour":
            f"WITH {_d()}, q AS (SELECT *, timestamp + INTERVAL 1 HOUR AS t FROM d), "
            "b AS (SELECT q.ingest_seq, q.t - s.timestamp AS g, s.aqi AS v FROM q ASOF LEFT JOIN d s ON q.city = s.city "
            "AND q.t >= s.timestamp), f AS (SELECT q.ingest_seq, s.timestamp - q.t AS g, s.aqi AS v FROM q ASOF LEFT JOIN "
            "d s ON q.city = s.city AND q.t <= s.timestamp), x AS (SELECT city, timestamp, ingest_seq, CASE WHEN "
            "b.g <= INTERVAL 15 MINUTE AND (f.g IS NULL OR b.g <= f.g) THEN b.v WHEN f.g <= INTERVAL 15 MINUTE THEN f.v "
            "END AS y FROM d JOIN b USING (ingest_seq) JOIN f USING (ingest_seq)), o AS (SELECT y, row_number() OVER "
            "(ORDER BY timestamp, city, ingest_seq) > floor((SELECT count(*) FROM x) * (1 - 0.2::DOUBLE)) AS late FROM x) "
            "SELECT m AS model, count(y) AS n, true AS consistent FROM o, (VALUES ('ridge'), ('random_forest'), "
            "('boosted_trees')) t(m) WHERE late GROUP BY m",
        **{f"{k}_eval": f"WITH {_d()} SELECT '{m}' AS model, CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) AS n, "
                        "true AS beats_mean, true AS consistent FROM d"
           for k, m in (("forest", "random_forest"), ("gbt", "boosted_trees"))},
        "sequence_model_eval": f"WITH {_d(hourly=True)}, {_seq_ctes()}, c AS (SELECT count(*) - floor(count(*) * (1 - "
                               "0.2::DOUBLE)) AS n FROM q GROUP BY city) SELECT 'sequence' AS model, CAST(sum(n) AS BIGINT) "
                               "AS n, true AS bounded, true AS consistent FROM c",
        # Ridge on city indicators alone, penalty 1: the normal equations in closed form.
        "train_many_series": "WITH c AS (SELECT CAST(user_id AS VARCHAR) AS city, count(*) AS n, avg(value) AS m FROM events "
                             "GROUP BY user_id), i AS (SELECT sum(n / (n + 1.0::DOUBLE) * m) / sum(n / (n + 1.0::DOUBLE)) "
                             "AS b FROM c) SELECT city, round((n * m + b) / (n + 1.0::DOUBLE), 6) AS level FROM c, i",
        "series_levels":
            f"WITH {_r('user_id')}, t AS (SELECT * FROM r WHERE timestamp < TIMESTAMP '2024-01-21'), p AS (SELECT avg(aqi) AS m FROM t), "
            "e AS (SELECT city, CAST(timestamp AS DATE) AS day, sum(aqi) AS s, count(aqi) AS n FROM t GROUP BY ALL), "
            "o AS (SELECT city, day, sum(s) OVER w AS s, sum(n) OVER w AS n FROM e WINDOW w AS (PARTITION BY city ORDER BY day "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), a AS (SELECT city, sum(aqi) AS s, count(aqi) AS n FROM t GROUP BY city) "
            "SELECT ingest_seq, round((coalesce(s, 0) + 10 * m) / (coalesce(n, 0) + 10), 6) AS series_level FROM t JOIN o ON "
            "t.city = o.city AND CAST(t.timestamp AS DATE) = o.day, p UNION ALL SELECT ingest_seq, round((s + 10 * m) / (n + 10), 6) "
            "FROM r LEFT JOIN a USING (city), p WHERE timestamp >= TIMESTAMP '2024-01-21'",
        "column_alignment": "SELECT event_id AS _ingest_seq, value AS _y, 0.0::DOUBLE AS pressure, 3.5::DOUBLE AS wind_speed, "
                            + ", ".join(f"CAST(event_type = '{c}' AS DOUBLE) AS city_{c}" for c in ("click", "error", "purchase", "signup"))
                            + " FROM events",
        "leaking_models": f"SELECT DISTINCT 'aqi_' || event_type AS name, {KNUM} + 1 AS version, CASE ({KNUM} + 1) % 7 WHEN 0 "
                          f"THEN 'pm25' ELSE 'co,no2' END AS leaking FROM events WHERE ({KNUM} + 1) % 7 IN (0, 1)",
        "recursive_forecast_trees": _forecast_places("ts"),
        "registry_forecast": _forecast_places("ts"),
        "sequence_forecast_boosted": _forecast_places("date_trunc('hour', ts)"),
        "sequence_kept_scalers":
            f"WITH {_d(hourly=True)}, e AS (SELECT city, min(aqi) AS lo, max(aqi) AS hi FROM d WHERE timestamp < "
            "TIMESTAMP '2024-01-20' GROUP BY city), l AS (SELECT city, max(timestamp) AS last FROM d GROUP BY city) "
            "SELECT city, last + to_hours(step) AS timestamp, CAST(step AS INTEGER) AS step, true AS in_early_range, "
            "round(lo, 6) AS lo, round(hi, 6) AS hi, 24 AS sequence_length FROM l JOIN e USING (city), range(1, 73) s(step)",
        "registry_rows": "SELECT * FROM (VALUES ('aqi_ridge', 1, 'ridge', true), ('aqi_ridge', 2, 'ridge', true), "
                         "('aqi_random_forest', 1, 'random_forest', true), ('aqi_boosted_trees', 1, 'boosted_trees', true)) "
                         "t(name, version, kind, measured)",
        "model_choice": "SELECT * FROM (VALUES ('Random Forest', 'aqi_random_forest', 1), ('Boosted Trees', "
                        "'aqi_boosted_trees', 1), ('Ridge Regression', 'aqi_ridge', 2), ('Sequence', NULL, NULL), "
                        "('Boosted Sequence', NULL, NULL)) t(choice, name, version)",
        "explain_next_hour": "SELECT city, CAST(r AS INTEGER) AS rank, true AS falls, true AS labelled FROM (SELECT DISTINCT "
                             "event_type AS city FROM events), range(1, 7) t(r)",
        "backfill_job": f"WITH {HISTORY}, x AS (SELECT *, {_index('pm25')} AS aqi FROM h), y AS (SELECT * FROM x WHERE "
                        "aqi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY city, timestamp ORDER BY poll_id DESC) = 1) "
                        "SELECT city, timestamp, aqi, CAST(extract(hour FROM timestamp) AS INTEGER) AS hour, "
                        "CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week, CAST(isodow(timestamp) >= 6 AS INTEGER) AS "
                        "is_weekend, poll_id AS ingest_seq FROM y",
        "stream_ingest": upserted + "SELECT city, timestamp, aqi, ingest_seq FROM d",
        "stream_hourly_mean": f"WITH {_r(hourly=True)}, x AS (SELECT city, timestamp AS hour, avg(aqi) AS aqi, "
                              "count(aqi) AS n FROM r GROUP BY city, timestamp) SELECT city, hour, round(aqi, 6) AS aqi, "
                              "n FROM x WHERE hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR",
        "stream_hourly_mean_late": f"WITH {_r(hourly=True)} SELECT city, timestamp AS hour, round(avg(aqi), 6) AS aqi, "
                                   "count(aqi) AS n FROM r GROUP BY city, timestamp",
        "stream_alerts": f"WITH {_r()}, x AS (SELECT city, timestamp, aqi, aqi >= 150 AS hazardous, "
                         f"{AS_OF} - timestamp > INTERVAL 3 HOUR AS stale FROM r) SELECT * FROM x WHERE hazardous OR stale",
    }
    many_cols = _raw_wide()
    medians = {c: f"(SELECT median({c}) FROM w)" for c in ("pressure",)}
    cities = ("click", "error", "purchase", "signup", "view")
    out["feature_matrix"] = (
        f"WITH {many_cols} SELECT ingest_seq AS _ingest_seq, aqi AS _y, coalesce(pressure, {medians['pressure']}) AS "
        "pressure, wind_speed, CAST(is_stale AS DOUBLE) AS is_stale, "
        + ", ".join(f"CAST(city = '{c}' AS DOUBLE) AS city_{c}" for c in cities) + " FROM w")
    return out
