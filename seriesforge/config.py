"""Column roles, tuning parameters and the fixed values of the domain."""

from __future__ import annotations

from dataclasses import dataclass

HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000

# --- Fixed values -----------------------------------------------------------
# (conc_low, conc_high, index_low, index_high): US EPA PM2.5 breakpoints.
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]
PM25_OVER_RANGE_INDEX = 500.0

# (upper limit, name): US EPA category names of the forecast table.
FORECAST_CATEGORIES = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
FORECAST_CATEGORY_ABOVE = "Hazardous"
FORECAST_CATEGORY_MISSING = "Unknown"

# (upper limit, key, label, phrase, colour, guidance): display categories.
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
    (1_000_000, "hazardous", "Hazardous", "hazardous", "#8E1B33",
     "This is dangerous air for everyone — stay inside, seal up windows, and skip outdoor plans."),
]

# (city, station, latitude, longitude): the configured stations.
CITIES = [
    ("Quetta", "A544306", 30.1798, 66.9750),
    ("Lahore", "lahore", 31.5497, 74.3436),
    ("Karachi", "karachi", 24.8607, 67.0011),
    ("Islamabad", "islamabad", 33.6844, 73.0479),
    ("Faisalabad", "A545326", 31.4504, 73.1350),
    ("Peshawar", "peshawar", 34.0151, 71.5249),
]

# Station names that are right although they do not mention the city.
STATION_ALIASES = {
    "quetta": ["irrigation directorate"],
    "faisalabad": ["fda-01"],
}

# Readable names of the model features.
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

POLLUTANTS = ["pm25", "pm10", "no2", "o3", "so2", "co"]
WEATHER = ["temp", "humidity", "pressure", "wind_speed"]
INLINE_WEATHER = ["aqicn_temp", "aqicn_humidity", "aqicn_pressure", "aqicn_wind"]

# Columns that never become model features.
NON_FEATURES = ["timestamp", "city", "aqi", "matched_station", "dominant_pollutant",
                *INLINE_WEATHER, *POLLUTANTS]

STALE_AFTER_HOURS = 3
HAZARD_THRESHOLD = 150
FORECAST_HORIZON = 72
HISTORY_HOURS = 72
SEQUENCE_LENGTH = 24
MAX_MISSING_FRACTION = 0.5
DISPLAY_ZONE = "Asia/Karachi"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns of a table hold the series key, event time, value and input order."""

    key: str = "city"
    ts: str = "timestamp"
    value: str = "aqi"
    seq: str = "ingest_seq"


@dataclass(frozen=True)
class FeatureConfig:
    """Lags, windows and the width of the time buckets a long series is split into."""

    lag_hours: tuple[int, ...] = (1, 3, 24)
    rolling_hours: tuple[int, ...] = (3, 24)
    lag_tolerance_fraction: float = 0.2
    min_tolerance_hours: float = 0.25
    bucket_hours: int = 96
    cell_rows: int = 1_000_000

    def tolerance_us(self, lag: int) -> int:
        return round(max(lag * self.lag_tolerance_fraction, self.min_tolerance_hours) * HOUR_US)

    @property
    def reach_us(self) -> int:
        """Longest look-back of any lag (with tolerance) or rolling window."""
        lags = [lag * HOUR_US + self.tolerance_us(lag) for lag in self.lag_hours]
        return max([*lags, *(w * HOUR_US for w in self.rolling_hours)])

    @property
    def bucket_us(self) -> int:
        return self.bucket_hours * HOUR_US


@dataclass(frozen=True)
class ModelConfig:
    """Regressor sizes; the defaults are the production sizes, ``small()`` serves unit tests."""

    ridge_alpha: float = 1.0
    forest_trees: int = 200
    forest_depth: int = 12
    boost_rounds: int = 300
    boost_depth: int = 6
    boost_rate: float = 0.05
    boost_row_fraction: float = 0.8
    boost_column_fraction: float = 0.8
    max_memory_mb: int = 512
    seed: int = 42

    @classmethod
    def small(cls) -> ModelConfig:
        return cls(forest_trees=20, forest_depth=8, boost_rounds=10, boost_depth=4)
