"""Samples and random days that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.constants import (
    MIN_TRIPS_PER_DAY,
    RANDOM_DAYS,
    SAMPLE_FRACTION,
    SAMPLE_SEED,
)
from curbside.operators.joins import keep_dates
from curbside.operators.stats import days_with_trips, distinct_dates

# Fixed value: hexadecimal digits of a hash that are read as a number.
HASH_DIGITS = 15


def seeded_hash(key: Column, seed: int) -> Column:
    """md5 of ``key:seed`` as text; orders keys at random but repeatably."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))


def sample_by_hash(
    df: DataFrame,
    key: str | None = None,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Bernoulli sample without replacement, decided by a hash of the row's key.

    Whether a row is drawn does not depend on how the input is partitioned.
    Without a key the whole row is hashed, so equal rows are drawn together.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must be from 0 to 1, got {fraction}")
    drawn = seeded_hash(F.col(key) if key else F.to_json(F.struct("*")), seed)
    number = F.conv(F.substring(drawn, 1, HASH_DIGITS), 16, 10).cast("bigint")
    return df.where(number < F.lit(round(fraction * 16**HASH_DIGITS)))


def first_rows(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*order).limit(rows)


def random_dates(trips: DataFrame, days: int = RANDOM_DAYS, seed: int = SAMPLE_SEED) -> DataFrame:
    """``days`` distinct pickup dates at random, or all where there are fewer."""
    return distinct_dates(trips).orderBy(seeded_hash(F.col("date"), seed)).limit(days)


def trips_on_random_days(
    trips: DataFrame, days: int = RANDOM_DAYS, seed: int = SAMPLE_SEED
) -> DataFrame:
    return keep_dates(trips, random_dates(trips, days, seed))


def random_day(
    trips: DataFrame, at_least: int = MIN_TRIPS_PER_DAY, seed: int = SAMPLE_SEED
) -> DataFrame:
    """One random day (row ``day``, ``trip_count``) with enough trips; no row if none."""
    return days_with_trips(trips, at_least).orderBy(seeded_hash(F.col("day"), seed)).limit(1)
