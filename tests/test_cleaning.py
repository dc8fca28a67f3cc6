"""Hand-made edge rows of the filters and derived columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers_core import rows
from curbside.constants import HOLIDAYS, TRIP_WINDOWS
from curbside.functions import binning, calendar, trip, weather
from curbside.operators import cleaning, holidays, joins, stats
from curbside.plans import flows


def trips_at(spark, *pairs):
    """Trips of the given (pickup, dropoff) texts, otherwise plausible."""
    table = spark.createDataFrame(
        [(i, p, d) for i, (p, d) in enumerate(pairs)], "id int, p string, d string"
    )
    return table.select(
        "id",
        F.col("p").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("d").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.lit(2.0).alias("trip_distance"),
        F.lit(10).alias("pulocationid"),
        F.lit(20).alias("dolocationid"),
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_train_window_is_inclusive_to_the_second(spark):
    inside, edge, late = "2022-12-01 00:00:00", "2023-05-31 23:59:59", "2023-05-31 23:59:59.5"
    trips = trips_at(spark, (inside, inside), (edge, edge), (late, late), (inside, late))
    assert ids(cleaning.filter_set_window(trips, "train")) == [0, 1]


def test_test_window_takes_different_pickup_and_dropoff_ends(spark):
    trips = trips_at(
        spark,
        ("2024-03-31 23:00:00", "2024-03-31 23:59:59"),
        ("2024-03-31 23:00:00", "2024-04-01 00:00:00"),
        ("2024-05-31 23:59:59", "2024-03-31 10:00:00"),
    )
    assert ids(cleaning.filter_set_window(trips, "test")) == [0, 2]


@pytest.mark.parametrize("call", [cleaning.filter_set_window, cleaning.filter_weather])
def test_unknown_set_is_refused(spark, call):
    with pytest.raises(ValueError, match="set_name"):
        call(trips_at(spark), "validation")
    with pytest.raises(ValueError, match="set_name"):
        holidays.holiday_calendar(spark, "validation")


def test_zone_range(spark):
    table = spark.createDataFrame(
        [(i, z, 5) for i, z in enumerate([0, 1, 263, 264])] + [(9, 5, 264), (8, None, 5)],
        "id int, pulocationid int, dolocationid int",
    )
    assert ids(cleaning.filter_zones(table)) == [1, 2]


def test_distance_range(spark):
    table = spark.createDataFrame(
        list(enumerate([0.99, 1.0, 50.0, 50.01])), "id int, trip_distance double"
    )
    assert ids(cleaning.filter_distance(table)) == [1, 2]


def test_duration_range_and_floor(spark):
    start = "2024-01-01 10:00:00"
    trips = cleaning.add_duration(
        trips_at(
            spark,
            (start, "2024-01-01 10:04:59"),
            (start, "2024-01-01 10:05:00"),
            (start, "2024-01-01 12:00:00"),
            (start, "2024-01-01 12:00:01"),
            ("2024-01-01 10:00:00.9", "2024-01-01 10:10:00.1"),
        )
    )
    assert ids(cleaning.filter_duration(trips)) == [1, 2, 4]
    assert trips.where("id = 4").first()["trip_duration"] == 10.0


def test_speed_cap_is_strict_and_zero_minutes_have_no_speed(spark):
    table = spark.createDataFrame([(0, 64.99), (1, 65.0)], "id int, speed double")
    assert ids(cleaning.filter_speed_cap(table)) == [0]
    stopped = spark.createDataFrame([(3.0, 0.0), (3.0, 30.0)], "trip_distance double, trip_duration double")
    assert [r[0] for r in stopped.select(trip.speed_mph()).collect()] == [None, 6.0]


def test_predicted_speed_of_zero_prediction_is_null(spark):
    table = spark.createDataFrame([(3.0, 0.0), (3.0, 6.0)], "trip_distance double, prediction double")
    assert [r[0] for r in table.select(trip.predicted_speed_mph()).collect()] == [None, 30.0]


def test_log_of_nothing_is_null(spark):
    table = spark.createDataFrame([(0.0,), (1.0,), (-2.0,)], "trip_duration double")
    assert [r[0] for r in table.select(trip.log_minutes()).collect()] == [None, 0.0, None]


def test_cleaning_gives_the_known_counts(spark):
    from curbside.catalog import views

    sf = "/root/testdata/sf0.01"
    trips = views.trips(spark, sf)
    timed = cleaning.filter_window(trips, views.SHORT_WINDOW)
    placed = cleaning.filter_zones(timed, views.ZONES)
    far = cleaning.filter_distance(placed)
    lasting = cleaning.filter_duration(cleaning.add_duration(far))
    capped = cleaning.filter_speed_cap(cleaning.add_speed(lasting))
    assert [df.count() for df in (timed, placed, far, lasting, capped)] == [
        8328,
        6606,
        6289,
        5121,
        3726,
    ]
    whole = flows.clean_trips(trips, views.SHORT_WINDOW, zone_range=views.ZONES)
    assert whole.count() == 3726


def test_weekend(spark):
    trips = trips_at(spark, *[(f"2024-01-0{d} 12:00:00",) * 2 for d in (6, 7, 8)])
    assert rows(cleaning.flag_weekend(trips), "id", "is_weekend") == [(0, True), (1, True), (2, False)]
    numbers = trips.select("id", calendar.day_of_week().alias("d"))
    assert rows(numbers) == [(0, 7), (1, 1), (2, 2)]


def test_holiday_scale_and_null_pickup(spark):
    trips = trips_at(spark, ("2024-01-01 08:00:00",) * 2, ("2024-01-03 08:00:00",) * 2, (None, None))
    flagged = holidays.flag_holiday(trips, holidays.holiday_calendar(spark, "test"))
    assert rows(flagged, "id", "is_holiday", "holiday_scale") == [
        (0, True, 4),
        (1, False, 0),
        (2, False, 0),
    ]


def test_calendar_lists_every_holiday_once(spark):
    for name, scales in HOLIDAYS.items():
        table = holidays.holiday_calendar(spark, name)
        assert {(str(r["date"]), r["scale"]) for r in table.collect()} == set(scales.items())
        first, last = TRIP_WINDOWS[name]["pickup"]
        assert all(first[:10] <= day <= last[:10] for day in scales)


def test_snow_keeps_null_depth(spark):
    table = spark.createDataFrame(
        [(0, 1.0, 2.0), (1, 3.0, 2.0), (2, None, 2.0), (3, 1.0, None)],
        "id int, snowdepth double, snow double",
    )
    assert rows(table.select("id", weather.merged_snow().alias("s"))) == [
        (0, 2.0),
        (1, 3.0),
        (2, None),
        (3, 1.0),
    ]


def test_rain_is_case_sensitive(spark):
    table = spark.createDataFrame(
        [(0, "Rain, Overcast"), (1, "rain"), (2, None)], "id int, conditions string"
    )
    assert rows(table.select("id", weather.rain_flag().alias("r"))) == [(0, 1), (1, 0), (2, 0)]


def test_bins_truncate_or_floor(spark):
    table = spark.createDataFrame([(-5.1,), (-3.5,), (3.5,), (5.0,)], "v double")
    found = table.select(binning.truncated_bin("v", 5), binning.floored_bin("v", 5)).collect()
    assert [r[0] for r in found] == [-5, 0, 0, 5]
    assert [r[1] for r in found] == [-10, -5, 0, 5]


WEATHER = "datetime timestamp_ntz, temp double, snow double, snowdepth double, windgust double, visibility double, conditions string"


def hourly(spark, *listed):
    from datetime import datetime

    return spark.createDataFrame(
        [
            (datetime.fromisoformat(t), float(v) if v is not None else None, 0.0, 0.0, 1.0, 9.0, "Clear")
            for t, v in listed
        ],
        WEATHER,
    )


def test_weather_filter_drops_nulls_nans_and_other_periods(spark):
    table = cleaning.preprocess_weather(
        hourly(
            spark,
            ("2024-01-01 00:00:00", 1),
            ("2024-01-01 01:00:00", None),
            ("2024-01-01 02:00:00", float("nan")),
            ("2024-06-01 00:00:00", 1),
        )
    )
    assert cleaning.filter_weather(table, "test").count() == 1
    assert table.columns == ["datetime", "temp", "snowdepth", "windgust", "visibility", "rain"]


def test_weather_join_drops_uncovered_hours_and_doubles_repeated_ones(spark):
    trips = trips_at(
        spark,
        ("2024-01-01 02:59:59", "2024-01-01 03:10:00"),
        ("2024-01-01 03:00:00", "2024-01-01 03:10:00"),
        ("2024-01-01 04:30:00", "2024-01-01 04:40:00"),
        ("2024-01-02 02:30:00", "2024-01-02 02:40:00"),
    )
    weather_rows = hourly(
        spark, ("2024-01-01 02:00:00", 1), ("2024-01-01 04:00:00", 2), ("2024-01-01 04:00:00", 3)
    )
    merged = joins.join_weather(trips, weather_rows)
    assert merged.columns[:2] == ["day", "hour"]
    assert "datetime" not in merged.columns
    assert rows(merged, "id", "day", "hour", "temp") == [
        (0, "2024-01-01", 2, 1.0),
        (2, "2024-01-01", 4, 2.0),
        (2, "2024-01-01", 4, 3.0),
    ]


@pytest.mark.parametrize("zone", ["Etc/UTC", "Asia/Kolkata", "America/New_York"])
def test_weather_join_reads_wall_clock_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        trips = trips_at(spark, ("2024-03-10 02:30:00", "2024-03-10 02:40:00"))
        merged = joins.join_weather(trips, hourly(spark, ("2024-03-10 02:00:00", 7)))
        assert rows(merged, "id", "day", "hour", "temp") == [(0, "2024-03-10", 2, 7.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def zone_table(spark):
    return spark.createDataFrame(
        [(10, "Queens", "A", "x"), (11, "Unknown", "B", "x"), (12, "N/A", "C", "x")],
        "LocationID int, Borough string, Zone string, service_zone string",
    )


def test_zone_join_keeps_only_the_borough(spark):
    trips = trips_at(spark, ("2024-01-01 02:00:00",) * 2)
    placed = joins.join_zones(trips, zone_table(spark))
    assert placed.columns == [*trips.columns, "Borough"]
    assert placed.first()["Borough"] == "Queens"
    assert joins.join_zones(trips.withColumn("pulocationid", F.lit(99)), zone_table(spark)).count() == 0


def test_known_boroughs_leave_unknown_out(spark):
    assert rows(stats.known_boroughs(zone_table(spark))) == [("N/A",), ("Queens",)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_gives_the_same_rows_with_and_without_broadcast(spark, how, null_safe):
    # One key holds a third of the facts, in equal copies; one key is NULL.
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"),
        F.lit("same").alias("note"),
    )
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "d")], "k bigint, v string")
    small = joins.lookup_join(facts, lookup, ["k"], how, null_safe=null_safe)
    large = joins.lookup_join(facts, lookup, ["k"], how, limit=0, null_safe=null_safe)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    pair = facts.alias("f").join(
        lookup.alias("l"),
        F.col("f.k").eqNullSafe(F.col("l.k")) if null_safe else F.col("f.k") == F.col("l.k"),
        how,
    )
    assert pair.count() == small.count()
