"""Grouped summaries of cleaned trips and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.constants import (
    DENSITY_CELLS,
    DENSITY_GRID,
    EXCLUDED_BOROUGHS,
    HISTOGRAM_BINS,
    LABEL,
    MIN_TRIPS_PER_DAY,
    PICKUP,
)
from curbside.functions.binning import equal_width_bin, floored_bin, truncated_bin
from curbside.functions.calendar import calendar_date


def avg_speed_by_bin(trips: DataFrame, feature: str, size: int, truncate: bool = True) -> DataFrame:
    """Average speed per bin of a feature, in bin order.

    Bins truncate toward zero by default; ``truncate=False`` floors instead.
    """
    label = (truncated_bin if truncate else floored_bin)(feature, size)
    return (
        trips.groupBy(label.alias("bin"))
        .agg(F.avg("speed").alias("avg_speed"), F.count(F.lit(1)).alias("trips"))
        .orderBy("bin")
    )


def trips_per_day(trips: DataFrame, instant: str = PICKUP) -> DataFrame:
    """Trips of every day (text); dates become text only after they are counted."""
    counted = trips.groupBy(calendar_date(instant).alias("date")).agg(
        F.count(F.lit(1)).alias("trip_count")
    )
    return counted.select(F.col("date").cast("string").alias("day"), "trip_count")


def days_with_trips(trips: DataFrame, at_least: int = MIN_TRIPS_PER_DAY) -> DataFrame:
    """Days that reach a number of trips."""
    return trips_per_day(trips).where(F.col("trip_count") >= at_least)


def distinct_dates(trips: DataFrame, instant: str = PICKUP) -> DataFrame:
    return trips.select(calendar_date(instant).alias("date")).distinct()


def known_boroughs(zones: DataFrame, excluded: list[str] = EXCLUDED_BOROUGHS) -> DataFrame:
    """Distinct boroughs of the lookup apart from those left out by name."""
    return zones.where(~F.col("Borough").isin(excluded)).select("Borough").distinct()


def trips_per_borough(trips: DataFrame, *also_by: str) -> DataFrame:
    """Trips of every borough at once, optionally split further, say by set."""
    return trips.groupBy(*also_by, "Borough").agg(F.count(F.lit(1)).alias("trips"))


def hourly_speed(predictions: DataFrame, day: str | None = None, *also_by: str) -> DataFrame:
    """Average actual and predicted speed per hour, of one day (text) or of all."""
    chosen = predictions if day is None else predictions.where(F.col("day") == day)
    return chosen.groupBy(*also_by, "hour").agg(
        F.avg("speed").alias("avg_actual_speed"),
        F.avg("predicted_speed").alias("avg_predicted_speed"),
    )


def compare_hourly(
    linear: DataFrame, forest: DataFrame, day: str | None = None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Hourly actual speed beside the speeds two models predict."""
    first = hourly_speed(linear, day, *keys).withColumnRenamed(
        "avg_predicted_speed", "avg_linear_speed"
    )
    second = (
        hourly_speed(forest, day, *keys)
        .drop("avg_actual_speed")
        .withColumnRenamed("avg_predicted_speed", "avg_forest_speed")
    )
    return first.join(second, [*keys, "hour"], "full")


def mean_absolute_error(
    predictions: DataFrame, *by: str, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """MAE of all predictions or of each group."""
    gap = F.abs(F.col(label) - F.col(prediction))
    return predictions.groupBy(*by).agg(
        F.avg(gap).alias("mae"), F.count(F.lit(1)).alias("predictions")
    )


def density_histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width density histogram: (bin, bin_start, bin_end, rows, density).

    All bins are listed, empty ones with density 0; the areas add up to 1. A
    column holding one value gets a single bin of width 1 around it.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    edge = values.agg(
        F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count("_x").alias("_n")
    )
    # Both sides of the joins below have a fixed size: one row of edges, ``bins`` rows.
    counts = (
        values.crossJoin(F.broadcast(edge.select("_lo", "_hi")))
        .groupBy(equal_width_bin(F.col("_x"), F.col("_lo"), F.col("_hi"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    single = F.col("_lo") == F.col("_hi")
    width = F.when(single, F.lit(1.0)).otherwise((F.col("_hi") - F.col("_lo")) / F.lit(bins))
    start = F.when(single, F.col("_lo") - F.lit(0.5)).otherwise(F.col("_lo"))
    last = F.when(single, F.lit(0)).otherwise(F.lit(bins - 1))
    listed = (
        edge.where("_n > 0")
        .withColumns({"_width": width, "_start": start})
        .select("*", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    )
    rows = F.coalesce("rows", F.lit(0)).cast("long")
    return listed.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("_start") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_start") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        rows.alias("rows"),
        (rows / (F.col("_n") * F.col("_width"))).alias("density"),
    )


def kde_curve(
    df: DataFrame,
    column: str,
    grid: int = DENSITY_GRID,
    bandwidth: float | None = None,
    cells: int = DENSITY_CELLS,
) -> DataFrame:
    """Gaussian kernel density at ``grid`` points from minimum to maximum.

    The bandwidth defaults to Scott's rule, stddev · N^(-1/5). Values are first
    put into ``cells`` equally spaced places by linear binning: each counts for
    the places left and right of it, more for the nearer one. The kernel is
    evaluated for places times points, whatever the rows or distinct values.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    chosen = (
        F.stddev_samp("_x") * F.pow(F.count("_x"), F.lit(-0.2))
        if bandwidth is None
        else F.lit(float(bandwidth))
    )
    marks = values.agg(
        F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count("_x").alias("_n"), chosen.alias("_h")
    )
    span = F.col("_hi") - F.col("_lo")
    place = F.coalesce(F.try_divide(F.col("_x") - F.col("_lo"), span), F.lit(0.0)) * F.lit(cells - 1)
    left = F.least(F.floor("_place"), F.lit(cells - 1)).cast("int")
    share = F.col("_place") - left
    sides = F.array(
        F.struct(left.alias("_cell"), (1 - share).alias("_w")),
        F.struct((left + 1).alias("_cell"), share.alias("_w")),
    )
    weighted = (
        values.crossJoin(F.broadcast(marks.select("_lo", "_hi")))  # marks are one row
        .withColumn("_place", place)
        .select("_lo", "_hi", F.inline(sides))
        .where("_w > 0")
        .groupBy("_cell")
        .agg(F.sum("_w").alias("_w"))
    )
    step = span / F.lit(grid - 1)
    points = F.transform(
        F.sequence(F.lit(0), F.lit(grid - 1)),
        lambda i: F.struct(i.alias("point"), (F.col("_lo") + i * step).alias("x")),
    )
    centre = F.col("_lo") + F.col("_cell") * span / F.lit(cells - 1)
    return (
        weighted.crossJoin(F.broadcast(marks))
        .select(centre.alias("_x"), "_w", "_n", "_h", F.inline(points))
        .groupBy("point", "x", "_n", "_h")
        .agg(F.sum(F.col("_w") * _kernel()).alias("_sum"))
        .select("point", "x", F.try_divide("_sum", F.col("_n") * F.col("_h")).alias("density"))
    )


def _kernel() -> Column:
    """Standard normal density at the scaled distance of value and grid point."""
    scaled = F.try_divide(F.col("x") - F.col("_x"), F.col("_h"))
    return F.exp(-scaled * scaled / F.lit(2.0)) / F.sqrt(F.lit(2.0) * F.pi())
