"""Outliers by the interquartile rule whose factor grows with the row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.constants import LOW_SPEED_QUANTILE, SLOWEST_SPEED_MPH, TOP_OUTLIERS
from curbside.operators.joins import lookup_join
from curbside.operators.quantiles import approx_quantiles, exact_quantiles

QUARTILES = [0.25, 0.75]


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: list[float],
    by: list[str] | None = None,
    method: str = "exact",
) -> DataFrame:
    """Quantiles by ``method``: ``exact`` or ``approx``."""
    if method not in ("exact", "approx"):
        raise ValueError(f"method must be 'exact' or 'approx', got {method!r}")
    find = exact_quantiles if method == "exact" else approx_quantiles
    return find(df, column, probabilities, by)


def scale_factor(rows: str = "n") -> Column:
    """sqrt(ln N) - 0.5, the distance from the quartiles in interquartile ranges."""
    return F.sqrt(F.ln(F.col(rows))) - F.lit(0.5)


def iqr_bounds(
    df: DataFrame, column: str, by: list[str] | None = None, method: str = "exact"
) -> DataFrame:
    """Rows (by…, n, q1, q3, lower_bound, upper_bound); one row without groups.

    An empty input gives NULL bounds, or no row when grouped.
    """
    by = by or []
    found = quantiles(df, column, QUARTILES, by, method)
    low, high = QUARTILES
    spread = F.col("q3") - F.col("q1")
    return (
        found.groupBy(*by)
        .agg(
            F.max("n").alias("n"),
            F.max(F.when(F.col("probability") == low, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("probability") == high, F.col("quantile"))).alias("q3"),
        )
        .withColumns(
            {
                "lower_bound": F.col("q1") - scale_factor() * spread,
                "upper_bound": F.col("q3") + scale_factor() * spread,
            }
        )
    )


def with_bounds(df: DataFrame, bounds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``df`` with the bounds of its group, or the only bounds there are."""
    edges = bounds.select(*(by or []), "lower_bound", "upper_bound")
    if by:
        return lookup_join(df, edges, by, null_safe=True)
    return df.crossJoin(F.broadcast(edges))  # an ungrouped aggregate: exactly one row


def is_outlier(column: str) -> Column:
    return (F.col(column) < F.col("lower_bound")) | (F.col(column) > F.col("upper_bound"))


def flag_outliers(
    df: DataFrame, column: str, bounds: DataFrame | None = None, by: list[str] | None = None
) -> DataFrame:
    """Add ``is_outlier``: strictly outside the bounds, by default ``df``'s own."""
    bounds = iqr_bounds(df, column, by) if bounds is None else bounds
    return with_bounds(df, bounds, by).select(*df.columns, is_outlier(column).alias("is_outlier"))


def top_outliers(
    df: DataFrame,
    column: str,
    tie_break: list[str] | None = None,
    bounds: DataFrame | None = None,
    rows: int = TOP_OUTLIERS,
) -> DataFrame:
    """The largest outliers, ties settled by the given or by all columns."""
    flagged = flag_outliers(df, column, bounds).where("is_outlier").drop("is_outlier")
    return flagged.orderBy(F.col(column).desc(), *(tie_break or df.columns)).limit(rows)


def filter_speed_outliers(
    trips: DataFrame, bounds: DataFrame | None = None, slowest: float = SLOWEST_SPEED_MPH
) -> DataFrame:
    """Trips from ``slowest`` to the upper bound, both included.

    The bounds are the trips' own unless another set's are given.
    """
    bounds = iqr_bounds(trips, "speed") if bounds is None else bounds
    kept = F.col("speed").between(F.lit(slowest), F.col("upper_bound"))
    return with_bounds(trips, bounds).where(kept).select(*trips.columns)


def low_speed_trips(
    trips: DataFrame, probability: float = LOW_SPEED_QUANTILE, method: str = "exact"
) -> DataFrame:
    """Trips slower than a low quantile of speed, with that quantile as ``low_speed``."""
    found = quantiles(trips, "speed", [probability], method=method)
    limit = found.agg(F.max("quantile").alias("low_speed"))
    return trips.crossJoin(F.broadcast(limit)).where(F.col("speed") < F.col("low_speed"))
