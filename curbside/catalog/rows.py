"""Queries that keep, drop or extend single rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbside.catalog import steps, views
from curbside.catalog.registry import query
from curbside.functions import calendar, trip
from curbside.functions.binning import floored_bin, truncated_bin
from curbside.functions.weather import merged_snow, rain_flag
from curbside.models.duration import apply_line, univariate_line
from curbside.operators import cleaning, outliers
from curbside.operators.stats import known_boroughs as list_known_boroughs, trips_per_borough
from curbside.operators.joins import join_zones, keep_dates, lookup_join


@query(
    "select_features",
    """select tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, pulocationid,
         dolocationid from trips""",
)
def select_features(spark, sf):
    return cleaning.select_features(views.trips(spark, sf))


@query(
    "filter_time_window",
    """select event_id, tpep_pickup_datetime, tpep_dropoff_datetime from trips
       where tpep_pickup_datetime
           between timestamp '2024-01-01' and timestamp '2024-01-25 23:59:59'
         and tpep_dropoff_datetime
           between timestamp '2024-01-01' and timestamp '2024-01-25 23:59:59'""",
)
def filter_time_window(spark, sf):
    kept = cleaning.filter_window(views.trips(spark, sf), views.SHORT_WINDOW)
    return kept.select("event_id", "tpep_pickup_datetime", "tpep_dropoff_datetime")


@query(
    "filter_test_window",
    """select event_id, tpep_pickup_datetime, tpep_dropoff_datetime from trips
       where tpep_pickup_datetime
           between timestamp '2024-01-01' and timestamp '2024-05-31 23:59:59'
         and tpep_dropoff_datetime
           between timestamp '2024-01-01' and timestamp '2024-03-31 23:59:59'""",
)
def filter_test_window(spark, sf):
    kept = cleaning.filter_set_window(views.trips(spark, sf), "test")
    return kept.select("event_id", "tpep_pickup_datetime", "tpep_dropoff_datetime")


@query(
    "filter_zones",
    """select event_id, pulocationid, dolocationid from trips
       where pulocationid between 1 and 24 and dolocationid between 1 and 24""",
)
def filter_zones(spark, sf):
    kept = cleaning.filter_zones(views.trips(spark, sf), views.ZONES)
    return kept.select("event_id", "pulocationid", "dolocationid")


@query(
    "filter_distance",
    "select event_id, trip_distance from trips where trip_distance between 1 and 50",
)
def filter_distance(spark, sf):
    return cleaning.filter_distance(views.trips(spark, sf)).select("event_id", "trip_distance")


@query(
    "filter_duration",
    "select event_id, trip_duration from timed where trip_duration between 5 and 120",
)
def filter_duration(spark, sf):
    return cleaning.filter_duration(steps.timed(spark, sf)).select("event_id", "trip_duration")


@query("filter_speed_cap", "select event_id, speed from speeds where speed < 65")
def filter_speed_cap(spark, sf):
    return cleaning.filter_speed_cap(steps.speeds(spark, sf)).select("event_id", "speed")


@query(
    "filter_speed_iqr",
    """select event_id, speed from cleaned cross join bounds
       where speed between 3 and upper_bound""",
)
def filter_speed_iqr(spark, sf):
    return outliers.filter_speed_outliers(steps.cleaned(spark, sf)).select("event_id", "speed")


@query(
    "filter_speed_train_bounds",
    """select event_id, speed from cleaned cross join (
         select q3 + (sqrt(ln(n)) - 0.5) * (q3 - q1) as upper_bound from (
           select count(*) as n, quantile_cont(speed, 0.25) as q1, quantile_cont(speed, 0.75) as q3
           from cleaned where tpep_pickup_datetime < timestamp '2024-01-20'))
       where tpep_pickup_datetime >= timestamp '2024-01-20' and speed between 3 and upper_bound""",
)
def filter_speed_train_bounds(spark, sf):
    cleaned = steps.cleaned(spark, sf)
    train, test = steps.split(cleaned)
    bounds = outliers.iqr_bounds(train, "speed")
    return outliers.filter_speed_outliers(test, bounds).select("event_id", "speed")


@query(
    "flag_outliers",
    """select event_id, value, value < q1 - f * (q3 - q1) or value > q3 + f * (q3 - q1) as is_outlier
       from events cross join (
         select sqrt(ln(count(*))) - 0.5 as f, quantile_cont(value, 0.25) as q1,
           quantile_cont(value, 0.75) as q3 from events)""",
)
def flag_outliers(spark, sf):
    values = views.events(spark, sf).select("event_id", "value")
    return outliers.flag_outliers(values, "value")


@query(
    "flag_outliers_by_type",
    """select event_id, event_type, value,
         value < q1 - f * (q3 - q1) or value > q3 + f * (q3 - q1) as is_outlier
       from events join (
         select event_type, sqrt(ln(count(*))) - 0.5 as f, quantile_cont(value, 0.25) as q1,
           quantile_cont(value, 0.75) as q3 from events group by event_type) using (event_type)""",
)
def flag_outliers_by_type(spark, sf):
    values = views.events(spark, sf).select("event_id", "event_type", "value")
    return outliers.flag_outliers(values, "value", by=["event_type"])


@query(
    "low_speed_trips",
    """select event_id, speed, round(low_speed, 6) as low_speed from cleaned cross join (
         select quantile_cont(speed, 0.02) as low_speed from cleaned) where speed < low_speed""",
)
def low_speed_trips(spark, sf):
    return outliers.low_speed_trips(steps.cleaned(spark, sf)).select(
        "event_id", "speed", F.round("low_speed", 6).alias("low_speed")
    )


WEATHER_SQL = "select datetime, temp, snowdepth, windgust, visibility, rain from"


@query(
    "filter_weather_window",
    f"""{WEATHER_SQL} fair_weather
       where temp is not null and snowdepth is not null and windgust is not null
         and visibility is not null
         and datetime between timestamp '2024-01-01' and timestamp '2024-01-25 23:59:59'""",
)
def filter_weather_window(spark, sf):
    return cleaning.filter_weather_window(steps.fair_weather(spark, sf), views.SHORT_WINDOW)


@query(
    "drop_missing",
    """select * from weather where temp is not null and snow is not null
       and snowdepth is not null and windgust is not null and visibility is not null""",
)
def drop_missing(spark, sf):
    return cleaning.drop_missing(views.weather(spark, sf))


@query("preprocess_weather", f"{WEATHER_SQL} fair_weather")
def preprocess_weather(spark, sf):
    return steps.fair_weather(spark, sf)


@query(
    "merge_snow",
    """select datetime, snow, snowdepth,
         case when snowdepth < snow then snow else snowdepth end as merged_depth from weather""",
)
def merge_snow(spark, sf):
    return views.weather(spark, sf).select(
        "datetime", "snow", "snowdepth", merged_snow().alias("merged_depth")
    )


@query(
    "flag_rain",
    """select datetime, conditions,
         case when contains(conditions, 'Rain') then 1 else 0 end as rain from weather""",
)
def flag_rain(spark, sf):
    return views.weather(spark, sf).select("datetime", "conditions", rain_flag().alias("rain"))


@query(
    "semi_join_dates",
    """select event_id, tpep_pickup_datetime from trips
       where cast(tpep_pickup_datetime as date) in (select date from calendar)""",
)
def semi_join_dates(spark, sf):
    kept = keep_dates(views.trips(spark, sf), views.calendar(spark))
    return kept.select("event_id", "tpep_pickup_datetime")


@query(
    "known_boroughs",
    """select Borough, count(*) as trips from trips join zones on pulocationid = LocationID
       where Borough not in ('EUROPE') group by Borough""",
)
def known_boroughs(spark, sf):
    known = list_known_boroughs(views.zones(spark, sf), ["EUROPE"])
    placed = join_zones(views.trips(spark, sf), views.zones(spark, sf))
    return trips_per_borough(lookup_join(placed, known, ["Borough"], "left_semi"))


@query("trip_duration", "select event_id, trip_duration from timed")
def trip_duration(spark, sf):
    return steps.timed(spark, sf).select("event_id", "trip_duration")


@query("trip_speed", "select event_id, speed from speeds")
def trip_speed(spark, sf):
    return steps.speeds(spark, sf).select("event_id", "speed")


LINE_SQL = """(select regr_slope(trip_duration, trip_distance) as slope,
    regr_intercept(trip_duration, trip_distance) as intercept from train)"""


@query(
    "predicted_speed",
    f"""select event_id, round(intercept + slope * trip_distance, 6) as prediction,
         round(trip_distance / ((intercept + slope * trip_distance) / 60), 6) as predicted_speed
       from test cross join {LINE_SQL}""",
)
def predicted_speed(spark, sf):
    train, test = steps.stored_split(spark, sf)
    scored = apply_line(test, univariate_line(train))
    return scored.select(
        "event_id",
        F.round("prediction", 6).alias("prediction"),
        F.round("predicted_speed", 6).alias("predicted_speed"),
    )


@query(
    "log_duration",
    """select event_id, round(case when trip_duration > 0 then ln(trip_duration) end, 6)
         as log_trip_duration from timed""",
)
def log_duration(spark, sf):
    logged = cleaning.add_log_duration(steps.timed(spark, sf))
    return logged.select("event_id", F.round("log_trip_duration", 6).alias("log_trip_duration"))


@query(
    "day_of_week",
    """select event_id, cast(dayofweek(tpep_pickup_datetime) + 1 as int) as day_of_week
       from trips""",
)
def day_of_week(spark, sf):
    return views.trips(spark, sf).select("event_id", calendar.day_of_week().alias("day_of_week"))


@query(
    "flag_weekend",
    "select event_id, dayofweek(tpep_pickup_datetime) in (0, 6) as is_weekend from trips",
)
def flag_weekend(spark, sf):
    return cleaning.flag_weekend(views.trips(spark, sf)).select("event_id", "is_weekend")


@query("to_date", "select event_id, cast(tpep_pickup_datetime as date) as date from trips")
def to_date(spark, sf):
    return views.trips(spark, sf).select("event_id", calendar.calendar_date().alias("date"))


@query(
    "day_hour_keys",
    """select event_id, strftime(tpep_pickup_datetime, '%Y-%m-%d') as day,
         cast(hour(tpep_pickup_datetime) as int) as hour from trips""",
)
def day_hour_keys(spark, sf):
    return views.trips(spark, sf).select(
        "event_id", calendar.day_text().alias("day"), calendar.hour_of_day().alias("hour")
    )


@query(
    "truncating_bin",
    """select datetime, cast(trunc(temp / 2) as int) * 2 as temp_bin,
         cast(floor(temp / 2) as int) * 2 as temp_floor_bin,
         cast(trunc(visibility / 25) as int) * 25 as visibility_bin from weather""",
)
def truncating_bin(spark, sf):
    return views.weather(spark, sf).select(
        "datetime",
        truncated_bin("temp", 2).alias("temp_bin"),
        floored_bin("temp", 2).alias("temp_floor_bin"),
        truncated_bin("visibility", 25).alias("visibility_bin"),
    )
