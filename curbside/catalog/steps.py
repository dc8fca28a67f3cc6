"""Intermediate tables shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbside.catalog import views
from curbside.constants import LABEL, NUMERIC_FEATURES, PICKUP
from curbside.operators.cleaning import add_duration, add_speed, preprocess_weather
from curbside.plans import flows
from curbside.sources.tables import read_boroughs, write_by_borough
from curbside.workspace import stage_path


MODEL_INPUTS = ["pulocationid", "dolocationid", *NUMERIC_FEATURES, "visibility", LABEL, "speed"]


def timed(spark: SparkSession, sf: str) -> DataFrame:
    return add_duration(views.trips(spark, sf))


def speeds(spark: SparkSession, sf: str) -> DataFrame:
    return add_speed(timed(spark, sf))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return flows.clean_trips(
        views.trips(spark, sf), views.STUDY_WINDOW, zone_range=views.ZONES
    )


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return flows.curate_trips(cleaned(spark, sf), views.calendar(spark))


def fair_weather(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess_weather(views.weather(spark, sf))


def complete_weather(spark: SparkSession, sf: str) -> DataFrame:
    return flows.curate_weather(views.weather(spark, sf), views.STUDY_WINDOW)


def merged(spark: SparkSession, sf: str) -> DataFrame:
    return flows.merge_trips(
        curated(spark, sf), complete_weather(spark, sf), views.zones(spark, sf)
    )


def split(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trips picked up before and from the start of the test period."""
    start = F.lit(views.TEST_START).cast("timestamp_ntz")
    return table.where(F.col(PICKUP) < start), table.where(F.col(PICKUP) >= start)


def stored_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Merged train and test trips, stored by set and borough.

    Models and scores read each side several times; a stored table is computed
    once, and a fit for one borough reads that borough's directory only.
    """
    path = stage_path(spark, "analysis")
    columns = ["event_id", "day", "hour", *MODEL_INPUTS]
    is_test = F.col(PICKUP) >= F.lit(views.TEST_START).cast("timestamp_ntz")
    set_name = F.when(is_test, "test").otherwise("train").alias("set_name")
    placed = merged(spark, sf).select(*columns, set_name, "Borough")
    write_by_borough(placed, path, "set_name")
    both = read_boroughs(spark, path, schema=placed.schema)
    return tuple(both.where(F.col("set_name") == name) for name in ("train", "test"))
