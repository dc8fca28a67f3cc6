"""From conformed trips to curated, merged and summarised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbside.constants import (
    HOLIDAYS,
    SLOWEST_SPEED_MPH,
    TRIP_WINDOWS,
    WEATHER_WINDOWS,
    ZONE_RANGE,
    for_set,
)
from curbside.operators.cleaning import (
    add_log_duration,
    filter_distance,
    filter_weather_window,
    filter_window,
    filter_zones,
    flag_weekend,
    preprocess_weather,
    select_features,
    timed_trips,
)
from curbside.operators.holidays import calendar_table, flag_holiday
from curbside.operators.joins import join_weather, join_zones
from curbside.operators.outliers import filter_speed_outliers
from curbside.operators.sampling import trips_on_random_days
from curbside.functions.calendar import calendar_date
from curbside.sources.tables import read_trips, read_weather, write_by_borough, write_table


def clean_trips(
    trips: DataFrame, pickup, dropoff=None, zone_range: tuple[int, int] = ZONE_RANGE
) -> DataFrame:
    """Trips inside the window, zone, distance, duration and speed limits."""
    # Cheapest rules first: a row's later conditions are not evaluated once one fails.
    plausible = filter_window(filter_distance(filter_zones(trips, zone_range)), pickup, dropoff)
    return timed_trips(plausible)


def curate_trips(
    cleaned: DataFrame,
    calendar: DataFrame,
    bounds: DataFrame | None = None,
    slowest: float = SLOWEST_SPEED_MPH,
) -> DataFrame:
    """Cleaned trips without speed outliers, with log duration and calendar flags."""
    kept = filter_speed_outliers(cleaned, bounds, slowest)
    return flag_holiday(flag_weekend(add_log_duration(kept)), calendar)


def curate_weather(weather: DataFrame, window) -> DataFrame:
    return filter_weather_window(preprocess_weather(weather), window)


def merge_trips(curated: DataFrame, weather: DataFrame, zones: DataFrame) -> DataFrame:
    """Curated trips with the weather of their hour and their pickup borough."""
    return join_zones(join_weather(curated, weather), zones)


def borough_summary(merged: DataFrame) -> DataFrame:
    """Trips, averages and shares per borough."""
    return merged.groupBy("Borough").agg(
        F.count(F.lit(1)).alias("trips"),
        F.avg("trip_duration").alias("avg_duration"),
        F.avg("speed").alias("avg_speed"),
        F.avg("trip_distance").alias("avg_distance"),
        F.count_if("is_weekend").alias("weekend_trips"),
        F.count_if("is_holiday").alias("holiday_trips"),
        F.sum("rain").cast("bigint").alias("rain_trips"),
    )


def curate_set(
    spark, raw: str, weather_csv: str, zones: DataFrame, output: str, set_name: str, seed: int = 42
) -> None:
    """Raw trips and landing weather of one set to curated and analysis tables.

    Tables written below ``output``: ``staged/<set>`` (cleaned trips, read again
    for the speed bounds and for the outlier filter), ``curated/<set>``,
    ``weather/<set>`` and ``analysis/<set>`` by borough. The test set keeps
    trips of random days only.
    """
    trips = select_features(read_trips(spark, f"{raw}/set_name={set_name}_set"))
    staged = f"{output}/staged/{set_name}"
    write_table(clean_trips(trips, **for_set(TRIP_WINDOWS, set_name)), staged)

    calendar = calendar_table(spark, for_set(HOLIDAYS, set_name))
    curated = curate_trips(read_trips(spark, staged), calendar)
    if set_name == "test":
        # The days are drawn among those that still have trips after the outlier filter.
        curated_all = f"{output}/staged/{set_name}_all_days"
        write_table(curated.withColumn("date", calendar_date()), curated_all)
        curated = trips_on_random_days(read_trips(spark, curated_all), seed=seed)
    write_table(curated, f"{output}/curated/{set_name}")

    weather = curate_weather(read_weather(spark, weather_csv), for_set(WEATHER_WINDOWS, set_name))
    write_table(weather, f"{output}/weather/{set_name}")
    merged = merge_trips(
        read_trips(spark, f"{output}/curated/{set_name}"),
        read_trips(spark, f"{output}/weather/{set_name}"),
        zones,
    )
    write_by_borough(merged, f"{output}/analysis/{set_name}")
