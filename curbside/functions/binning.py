"""Bins of a numeric column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def truncated_bin(value: str, size: int) -> Column:
    """Bin label rounded toward zero, so (-size, size) is a single bin."""
    return F.try_divide(F.col(value), F.lit(size)).try_cast("int") * F.lit(size)


def floored_bin(value: str, size: int) -> Column:
    """Bin label rounded down, so negative values get bins of their own."""
    return F.floor(F.try_divide(F.col(value), F.lit(size))).try_cast("int") * F.lit(size)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin among ``bins`` equal widths of [low, high]; the last is closed.

    The index never decreases as the value grows, so it keeps the order of values.
    """
    share = F.try_divide(value - low, high - low)
    index = F.least(F.floor(share * F.lit(bins)).cast("int"), F.lit(bins - 1))
    return F.when(value.isNotNull(), F.when(high > low, index).otherwise(0))
