"""Quality reports: NULLs, ranges and descriptive statistics in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from curbside.constants import DROPOFF, PICKUP

TRIP_REPORT_TIMES = [PICKUP, DROPOFF]
TRIP_REPORT_NUMBERS = ["trip_distance", "pulocationid", "dolocationid"]
WEATHER_REPORT_TIMES = ["datetime"]
WEATHER_REPORT_NUMBERS = ["temp", "snowdepth", "windgust", "visibility"]


def _numbers(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _times(df: DataFrame) -> list[str]:
    kinds = (DateType, TimestampType, TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


PROFILE_CELLS = {
    "nulls": "bigint",
    "count": "bigint",
    "earliest": "timestamp_ntz",
    "latest": "timestamp_ntz",
    "mean": "double",
    "stddev": "double",
    "min": "double",
    "max": "double",
}


def profile(
    df: DataFrame,
    columns: list[str] | None = None,
    times: list[str] | None = None,
    numbers: list[str] | None = None,
) -> DataFrame:
    """One row per column from a single aggregate over ``df``.

    Columns: ``column_name``, ``nulls`` and ``count`` (of values), ``earliest``
    and ``latest`` for times, and ``mean``, ``stddev`` (of a sample), ``min``
    and ``max`` for numbers. NaN is a value here, not a NULL.
    """
    names = df.columns if columns is None else columns
    times = _times(df) if times is None else times
    numbers = _numbers(df) if numbers is None else numbers

    aggregates = []
    rows = []
    for i, name in enumerate(names):
        column = F.col(f"`{name}`")
        number = column.cast("double")
        parts = {"nulls": F.count_if(column.isNull()), "count": F.count(column)}
        if name in times:
            parts["earliest"] = F.min(column.cast("timestamp_ntz"))
            parts["latest"] = F.max(column.cast("timestamp_ntz"))
        if name in numbers:
            parts["mean"] = F.avg(number)
            parts["stddev"] = F.stddev_samp(number)
            parts["min"] = F.min(number)
            parts["max"] = F.max(number)
        aggregates += [part.alias(f"{label}_{i}") for label, part in parts.items()]
        cells = [F.lit(name).alias("column_name")]
        for label, kind in PROFILE_CELLS.items():
            cell = F.col(f"{label}_{i}") if label in parts else F.lit(None)
            cells.append(cell.cast(kind).alias(label))
        rows.append(F.struct(*cells))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs of every column, one row per column."""
    return profile(df, times=[], numbers=[]).select("column_name", "nulls")


def time_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """First and last instant of each column."""
    return profile(df, columns, columns, []).select("column_name", "earliest", "latest")


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, sample stddev, min and max of each numeric column."""
    columns = _numbers(df) if columns is None else columns
    table = profile(df, columns, [], columns)
    return table.select("column_name", "count", "mean", "stddev", "min", "max")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def trip_quality(trips: DataFrame) -> DataFrame:
    """NULLs everywhere, ranges of both instants, statistics of distance and zones."""
    return profile(trips, trips.columns, TRIP_REPORT_TIMES, TRIP_REPORT_NUMBERS)


def weather_quality(weather: DataFrame) -> DataFrame:
    """NULLs everywhere, range of the readings, statistics of the four measures."""
    return profile(weather, weather.columns, WEATHER_REPORT_TIMES, WEATHER_REPORT_NUMBERS)
