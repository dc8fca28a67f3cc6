"""A whole set from landing files to the per-borough table, checked by hand and against numpy."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_core import rows
from curbside.plans import flows
from curbside.sources import tables


def landing_trips(spark):
    """Forty January days' worth of trips, one a zone outside the lookup, one too fast."""
    base = datetime(2024, 1, 1, 0, 10)
    listed = []
    for i in range(40 * 12):
        start = base + timedelta(hours=2 * i)
        minutes = 10 + i % 20
        listed.append((1, start, start + timedelta(minutes=minutes), 2.0 + i % 5, "Y", 1 + i % 3, 2))
    listed.append((1, base, base + timedelta(minutes=10), 3.0, "N", 265, 2))
    listed.append((1, base, base + timedelta(minutes=6), 40.0, "N", 1, 2))
    listed.append((1, base, base + timedelta(minutes=60), 1.0, None, 1, 2))
    return spark.createDataFrame(
        listed,
        "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
        "trip_distance double, store_and_fwd_flag string, PULocationID long, DOLocationID long",
    )


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("flow")
    landing, raw, output = (str(root / name) for name in ("landing", "raw", "data"))
    trips = landing_trips(spark)
    for month in (1, 2):
        trips.where(F.month("tpep_pickup_datetime") == month).write.parquet(
            tables.month_path(landing, "test_set", 2024, month)
        )
    tables.integrate_months(spark, landing, raw, "test_set", {2024: [1, 2]})
    weather = root / "weather.csv"
    hours = [datetime(2024, 1, 1) + timedelta(hours=h) for h in range(45 * 24)]
    weather.write_text(
        "datetime,temp,snow,snowdepth,windgust,visibility,conditions\n"
        + "".join(f"{h.isoformat()},{h.hour},0,0,{h.day},10,{'Rain' if h.hour < 6 else 'Clear'}\n" for h in hours)
    )
    zones = spark.createDataFrame(
        [(1, "Queens", "a", "x"), (2, "Bronx", "b", "x"), (3, "N/A", "c", "x")],
        "LocationID int, Borough string, Zone string, service_zone string",
    )
    flows.curate_set(spark, raw, str(weather), zones, output, "test")
    return output


def test_test_set_keeps_thirty_whole_days(spark, written):
    everyday = tables.read_trips(spark, f"{written}/staged/test_all_days")
    curated = tables.read_trips(spark, f"{written}/curated/test")
    per_day = {r["date"]: r["count"] for r in everyday.groupBy("date").count().collect()}
    kept = {r["date"]: r["count"] for r in curated.groupBy("date").count().collect()}
    assert len(per_day) == 40 and len(kept) == 30
    assert all(per_day[day] == n for day, n in kept.items())


def test_outliers_are_gone_and_flags_are_set(spark, written):
    curated = tables.read_trips(spark, f"{written}/staged/test_all_days")
    assert curated.count() == 480
    assert curated.where("speed >= 65 or speed < 3").count() == 0
    staged = tables.read_trips(spark, f"{written}/staged/test")
    speeds = np.array([r["speed"] for r in staged.collect()])
    q1, q3 = np.quantile(speeds, [0.25, 0.75])
    upper = q3 + (np.sqrt(np.log(len(speeds))) - 0.5) * (q3 - q1)
    assert curated.count() == ((speeds >= 3) & (speeds <= upper)).sum()
    holidays = curated.where("is_holiday").select(F.col("date").cast("string"), "holiday_scale").distinct()
    assert rows(holidays) == [("2024-01-01", 4), ("2024-01-02", 3), ("2024-01-15", 4)]
    assert curated.where("is_weekend != (dayofweek(date) in (1, 7))").count() == 0


def test_merged_table_has_weather_and_borough(spark, written):
    merged = tables.read_boroughs(spark, f"{written}/analysis/test")
    assert merged.count() == 30 * 12
    assert merged.where("temp != hour or windgust != day(date)").count() == 0
    assert merged.where("(rain = 1) != (hour < 6)").count() == 0
    assert merged.columns[:2] == ["day", "hour"]
    queens = tables.read_boroughs(spark, f"{written}/analysis/test", ["Queens"])
    assert queens.count() == merged.where("pulocationid = 1").count() > 0
    summary = flows.borough_summary(merged)
    assert sum(r["trips"] for r in summary.collect()) == merged.count()
