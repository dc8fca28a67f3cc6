"""Day, hour and weekend of an instant."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from curbside.constants import PICKUP

SATURDAY, SUNDAY = 7, 1


def day_of_week(instant: str = PICKUP) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(F.col(instant))


def is_weekend(instant: str = PICKUP) -> Column:
    return day_of_week(instant).isin(SUNDAY, SATURDAY)


def calendar_date(instant: str = PICKUP) -> Column:
    return F.to_date(F.col(instant))


def day_text(instant: str = PICKUP) -> Column:
    """Date as ``yyyy-MM-dd`` text."""
    return calendar_date(instant).cast("string")


def hour_of_day(instant: str = PICKUP) -> Column:
    return F.hour(F.col(instant))


def hour_slot(instant: str = PICKUP) -> Column:
    """Number of the wall-clock hour since 1970, one long for (day, hour).

    Two instants share a slot exactly when they share ``day_text`` and
    ``hour_of_day``; a long key hashes faster than a text and an int.
    """
    seconds = F.unix_timestamp(F.col(instant).cast("timestamp_ntz"))
    return F.floor(seconds / F.lit(3600))
