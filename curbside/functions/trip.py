"""Duration and speed of a trip."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from curbside.constants import DROPOFF, PICKUP


def duration_minutes(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    """Minutes between two instants, each first floored to the whole second."""
    return (F.unix_timestamp(F.col(dropoff)) - F.unix_timestamp(F.col(pickup))) / F.lit(60)


def speed_mph(distance: str = "trip_distance", minutes: str = "trip_duration") -> Column:
    """Miles per hour; NULL where the duration is zero."""
    return F.try_divide(F.col(distance), F.col(minutes) / F.lit(60))


def predicted_speed_mph(distance: str = "trip_distance", prediction: str = "prediction") -> Column:
    """Speed implied by a predicted duration; NULL where the prediction is zero."""
    return speed_mph(distance, prediction)


def log_minutes(minutes: str = "trip_duration") -> Column:
    """Natural logarithm of a duration; NULL for zero and below."""
    return F.ln(F.col(minutes))
