"""Fixed values and tunable parameters.

Everything here is plain data; operators take these as defaults and every
one of them can be overridden per call.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# FIXED VALUES — these must equal the behaviour being reproduced.
# --------------------------------------------------------------------------
LOCAL_ZONE = "America/New_York"
BRONZE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
FEED_TS_FORMAT = "MM/dd/yyyy HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"

SPEED_MIN_EXCLUSIVE = 0.0
SPEED_MAX_EXCLUSIVE = 100.0

FREE_FLOW_PERCENTILE = 0.85
FREE_FLOW_THRESHOLD = 0.67   # ratio >= this -> class 0
HEAVY_THRESHOLD = 0.40       # ratio >= this -> class 1, below -> class 2
NUM_CLASSES = 3
CLASSES = (0, 1, 2)
CLASS_LABELS = {0: "0-free flow", 1: "1-congested", 2: "2-severe"}

# lag minutes -> rows back (nominal 5 minutes per row)
LAG_ROWS = {15: 3, 30: 6, 45: 9, 60: 12}
LEAD_ROWS = 3
LEAD_MINUTES = 15
# lag minutes -> inclusive (lo, hi) tolerance window in minutes
LAG_TOLERANCE = {15: (10, 20), 30: (25, 35), 45: (40, 50), 60: (55, 65)}
LEAD_TOLERANCE = (10, 20)
# serving: carry-forward allowed when the last snapshot is at most this old
LOCF_MAX_MINUTES = 15

LOOKBACK_MINUTES = 90
DEAD_LINK_MINUTES = 120
WARMUP_MIN_LINKS = 20
ACTIVE_WINDOW_HOURS = 48
TARGET_MINUTES = 15

EXPECTED_LOOKUP_ROWS = 116
EXPECTED_COORDINATE_ROWS = 125

SAMPLE_FRACTION = 0.35
SAMPLE_SEED = 42

GOLD_WRITE_PARTITIONS = 64
GOLD_MAX_RECORDS_PER_FILE = 2_000_000

FOREST_PARAMS = dict(
    numTrees=80,
    maxDepth=12,
    minInstancesPerNode=5,
    maxBins=132,
    impurity="gini",
    featureSubsetStrategy="sqrt",
    seed=42,
    subsamplingRate=0.8,
    maxMemoryInMB=400,
)

LABEL_COL = "future_congestion_15min"
CATEGORICAL_FEATURES = ["link_id", "borough"]
NUMERIC_FEATURES = [
    "hour", "day_of_week", "month", "is_weekend", "is_holiday",
    "speed_ratio", "current_congestion",
    "past_congestion_15min", "past_speed_ratio_15min",
    "past_congestion_30min", "past_speed_ratio_30min",
    "past_congestion_45min", "past_speed_ratio_45min",
    "past_congestion_60min", "past_speed_ratio_60min",
    "congestion_trend", "speed_ratio_trend",
]
FEATURE_COLUMNS = CATEGORICAL_FEATURES + NUMERIC_FEATURES  # 19
GOLD_COLUMNS = FEATURE_COLUMNS + [LABEL_COL, "data_as_of", "year"]
SILVER_COLUMNS = ["link_id", "borough", "link_name", "data_as_of", "speed",
                  "hour", "day_of_week", "month", "is_weekend", "is_holiday"]
LOOKUP_COLUMNS = ["link_id", "free_flow_speed", "borough", "link_name"]
COORDINATE_COLUMNS = ["link_id", "lat", "lon"]
PREDICTION_COLUMNS = ["link_id", "borough", "link_name", "timestamp",
                      "target_time", "predicted_congestion", "confidence"]

# the three calendar splits of the source data
SPLIT_BOUNDS = {
    "train": "year = 2024 OR (year = 2025 AND month <= 9)",
    "val": "year = 2025 AND month BETWEEN 10 AND 12",
    "test": "year >= 2026",
}


# --------------------------------------------------------------------------
# end of the fixed values; below: parameter objects
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class TimeScale:
    """Multiplies every minute constant (tests use sparse data, see README)."""

    factor: float = 1.0

    def minutes(self, m: float) -> float:
        return m * self.factor

    def seconds(self, m: float) -> int:
        return int(round(m * self.factor * 60))

    def micros(self, m: float) -> int:
        return int(round(m * self.factor * 60_000_000))


@dataclass(frozen=True)
class GoldParams:
    lag_rows: dict = field(default_factory=lambda: dict(LAG_ROWS))
    lag_tolerance: dict = field(default_factory=lambda: dict(LAG_TOLERANCE))
    lead_rows: int = LEAD_ROWS
    lead_tolerance: tuple = LEAD_TOLERANCE
    scale: TimeScale = TimeScale()
    # width of the time buckets that split one link's series across tasks
    bucket_hours: float = 24.0


@dataclass(frozen=True)
class ServingParams:
    lag_tolerance: dict = field(default_factory=lambda: dict(LAG_TOLERANCE))
    locf_max_minutes: float = LOCF_MAX_MINUTES
    lookback_minutes: float = LOOKBACK_MINUTES
    scale: TimeScale = TimeScale()
    bucket_hours: float = 24.0
