"""Fixed values of the trip analysis: thresholds, periods, schema and calendars."""

from __future__ import annotations

# The five trip columns known before a trip ends.
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
TRIP_FEATURES = [PICKUP, DROPOFF, "trip_distance", "pulocationid", "dolocationid"]

# Landing columns and their canonical Spark types.
TRIP_COLUMN_TYPES = {
    "vendorid": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "ratecodeid": "int",
    "store_and_fwd_flag": "boolean",
    "pulocationid": "int",
    "dolocationid": "int",
    "payment_type": "int",
}
INTEGER_COLUMNS = [
    "vendorid",
    "passenger_count",
    "ratecodeid",
    "pulocationid",
    "dolocationid",
    "payment_type",
]
FLAG_COLUMN = "store_and_fwd_flag"

# Hourly weather file and its curated columns.
WEATHER_COLUMN_TYPES = {
    "datetime": "timestamp_ntz",
    "temp": "double",
    "snow": "double",
    "snowdepth": "double",
    "windgust": "double",
    "visibility": "double",
    "conditions": "string",
}
WEATHER_FEATURES = ["datetime", "temp", "snowdepth", "windgust", "visibility", "rain"]

# Zone lookup file.
ZONE_COLUMN_TYPES = {
    "LocationID": "int",
    "Borough": "string",
    "Zone": "string",
    "service_zone": "string",
}

# Study periods, both ends inclusive, as (first, last) instants.
TRIP_WINDOWS = {
    "train": {
        "pickup": ("2022-12-01 00:00:00", "2023-05-31 23:59:59"),
        "dropoff": ("2022-12-01 00:00:00", "2023-05-31 23:59:59"),
    },
    "test": {
        "pickup": ("2024-01-01 00:00:00", "2024-05-31 23:59:59"),
        "dropoff": ("2024-01-01 00:00:00", "2024-03-31 23:59:59"),
    },
}
WEATHER_WINDOWS = {
    "train": ("2022-12-01 00:00:00", "2023-05-31 23:59:59"),
    "test": ("2024-01-01 00:00:00", "2024-05-31 23:59:59"),
}
TRIP_MONTHS = {
    "train_set": {2022: [12], 2023: [1, 2, 3, 4, 5]},
    "test_set": {2024: [1, 2, 3]},
}

# Plausible ranges, inclusive unless named a cap.
ZONE_RANGE = (1, 263)
DISTANCE_RANGE_MILES = (1, 50)
DURATION_RANGE_MINUTES = (5, 120)
SPEED_CAP_MPH = 65
SLOWEST_SPEED_MPH = 3
LOW_SPEED_QUANTILE = 0.02
QUANTILE_RELATIVE_ERROR = 0.01

# Sampling and reporting sizes.
SAMPLE_FRACTION = 0.05
SAMPLE_SEED = 42
RANDOM_DAYS = 30
MIN_TRIPS_PER_DAY = 4
TOP_OUTLIERS = 20
HISTOGRAM_BINS = 30
DENSITY_GRID = 200
# Cells into which values are put before the kernel density is evaluated.
DENSITY_CELLS = 1_024

# Boroughs that get their own models, and the one left out by name.
MODEL_BOROUGHS = ["Queens", "EWR", "Bronx", "Brooklyn", "Manhattan", "Staten Island"]
EXCLUDED_BOROUGHS = ["Unknown"]

# Public holidays by effect, from 4 (main) down to 1 (observed floating).
HOLIDAYS = {
    "train": {
        "2022-12-25": 4,  # Christmas Day
        "2022-12-26": 3,  # Christmas Day (observed)
        "2023-01-01": 4,  # New Year's Day
        "2023-01-02": 3,  # New Year's Day (observed)
        "2023-01-16": 4,  # Martin Luther King Jr. Day
        "2023-02-12": 2,  # Lincoln's Birthday (floating)
        "2023-02-13": 1,  # Lincoln's Birthday (observed)
        "2023-02-20": 4,  # Presidents' Day
        "2023-05-29": 4,  # Memorial Day
    },
    "test": {
        "2024-01-01": 4,  # New Year's Day
        "2024-01-02": 3,  # New Year's Day (observed)
        "2024-01-15": 4,  # Martin Luther King Jr. Day
        "2024-02-12": 2,  # Lincoln's Birthday (floating)
        "2024-02-13": 1,  # Lincoln's Birthday (observed)
        "2024-02-19": 4,  # Presidents' Day
    },
}

# Model inputs.
CATEGORICAL_FEATURES = ["hour", "pulocationid", "dolocationid"]
NUMERIC_FEATURES = ["trip_distance", "is_weekend", "holiday_scale", "temp", "windgust"]
LABEL = "trip_duration"


def for_set(table: dict, set_name: str):
    """Value of a per-set table, refusing names other than its keys."""
    if set_name not in table:
        raise ValueError(f"set_name must be one of {sorted(table)}, got {set_name!r}")
    return table[set_name]
