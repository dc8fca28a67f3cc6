"""Projections, plausibility filters and derived columns of trips and weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.constants import (
    DISTANCE_RANGE_MILES,
    DROPOFF,
    DURATION_RANGE_MINUTES,
    PICKUP,
    SPEED_CAP_MPH,
    TRIP_FEATURES,
    TRIP_WINDOWS,
    WEATHER_FEATURES,
    WEATHER_WINDOWS,
    ZONE_RANGE,
    for_set,
)
from curbside.functions.calendar import is_weekend
from curbside.functions.trip import duration_minutes, log_minutes, speed_mph
from curbside.functions.weather import merged_snow, rain_flag

Window = tuple[str, str]


def within(instant: str, window: Window) -> Column:
    """Inclusive wall-clock window; NTZ literals keep the filter in the scan."""
    first, last = (F.lit(end).cast("timestamp_ntz") for end in window)
    return F.col(instant).between(first, last)


def select_features(trips: DataFrame, columns: list[str] = TRIP_FEATURES) -> DataFrame:
    return trips.select(*columns)


def filter_window(trips: DataFrame, pickup: Window, dropoff: Window | None = None) -> DataFrame:
    """Trips picked up and dropped off inside inclusive windows."""
    return trips.where(within(PICKUP, pickup) & within(DROPOFF, dropoff or pickup))


def filter_set_window(trips: DataFrame, set_name: str) -> DataFrame:
    """The study period of the ``train`` or ``test`` set."""
    return filter_window(trips, **for_set(TRIP_WINDOWS, set_name))


def filter_zones(trips: DataFrame, zone_range: tuple[int, int] = ZONE_RANGE) -> DataFrame:
    """Trips whose two zones are both in the lookup's range."""
    return trips.where(
        F.col("pulocationid").between(*zone_range) & F.col("dolocationid").between(*zone_range)
    )


def filter_distance(trips: DataFrame, miles: tuple[float, float] = DISTANCE_RANGE_MILES) -> DataFrame:
    return trips.where(F.col("trip_distance").between(*miles))


def add_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_duration", duration_minutes())


def filter_duration(
    trips: DataFrame, minutes: tuple[float, float] = DURATION_RANGE_MINUTES
) -> DataFrame:
    return trips.where(F.col("trip_duration").between(*minutes))


def add_speed(trips: DataFrame) -> DataFrame:
    return trips.withColumn("speed", speed_mph())


def filter_speed_cap(trips: DataFrame, cap: float = SPEED_CAP_MPH) -> DataFrame:
    """Trips strictly slower than the cap."""
    return trips.where(F.col("speed") < cap)


def add_log_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("log_trip_duration", log_minutes())


def flag_weekend(trips: DataFrame, instant: str = PICKUP) -> DataFrame:
    return trips.withColumn("is_weekend", is_weekend(instant))


def timed_trips(trips: DataFrame) -> DataFrame:
    """Duration and speed added, implausible values of both removed."""
    return filter_speed_cap(add_speed(filter_duration(add_duration(trips))))


def preprocess_weather(weather: DataFrame) -> DataFrame:
    """Snow merged into its depth, rain flagged, used columns kept."""
    return weather.withColumns({"snowdepth": merged_snow(), "rain": rain_flag()}).select(
        *WEATHER_FEATURES
    )


def drop_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a NULL or NaN in any (listed) column."""
    return df.dropna("any", subset=columns)


def filter_weather_window(weather: DataFrame, window: Window) -> DataFrame:
    """Complete weather rows inside an inclusive window."""
    return drop_missing(weather).where(within("datetime", window))


def filter_weather(weather: DataFrame, set_name: str) -> DataFrame:
    return filter_weather_window(weather, for_set(WEATHER_WINDOWS, set_name))
