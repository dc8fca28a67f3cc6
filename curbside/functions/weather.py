"""Derived weather readings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def merged_snow(depth: str = "snowdepth", fall: str = "snow") -> Column:
    """Fresh snow where it exceeds the depth, else the depth.

    A NULL depth stays NULL, which is why this is not ``greatest``.
    """
    return F.when(F.col(depth) < F.col(fall), F.col(fall)).otherwise(F.col(depth))


def rain_flag(conditions: str = "conditions") -> Column:
    """1 where the text names ``Rain`` (case-sensitive), else 0, also for NULL."""
    return F.when(F.col(conditions).contains("Rain"), 1).otherwise(0)
