"""Public holidays as a calendar table joined by date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbside.constants import HOLIDAYS, PICKUP, for_set
from curbside.functions.calendar import calendar_date
from curbside.operators.joins import lookup_join


def calendar_table(spark: SparkSession, scales: dict[str, int]) -> DataFrame:
    """``{'yyyy-MM-dd': scale}`` as a table (date, scale) with one row per date."""
    # A VALUES list has a known size and needs no job; a parallelized list has neither.
    listed = ", ".join(
        f"(date '{date.fromisoformat(day)}', {int(scale)})" for day, scale in scales.items()
    )
    return spark.sql(f"select * from values {listed} as calendar(date, scale)")


def holiday_calendar(spark: SparkSession, set_name: str) -> DataFrame:
    return calendar_table(spark, for_set(HOLIDAYS, set_name))


def flag_holiday(trips: DataFrame, calendar: DataFrame, instant: str = PICKUP) -> DataFrame:
    """Add ``is_holiday`` and ``holiday_scale`` (0 on ordinary days) by pickup date.

    The calendar has one row per date. A NULL instant counts as an ordinary day.
    """
    keyed = trips.withColumn("_date", calendar_date(instant))
    listed = calendar.select(F.col("date").alias("_date"), F.col("scale").alias("_scale"))
    return lookup_join(keyed, listed, ["_date"], "left").select(
        *trips.columns,
        F.col("_scale").isNotNull().alias("is_holiday"),
        F.coalesce("_scale", F.lit(0)).alias("holiday_scale"),
    )
