"""Trip, zone, weather and calendar tables derived from the driver's tables.

The driver's tables hold no taxi trips, so ``events`` is read as trips: the
event is the pickup, its value the minutes until dropoff, and identifiers give
zones and distance. ``nation`` and ``region`` are the zone lookup. ``SQL`` holds
the same definitions for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbside.constants import DROPOFF, HOLIDAYS, PICKUP, WEATHER_COLUMN_TYPES
from curbside.functions.calendar import hour_slot
from curbside.operators.holidays import calendar_table
from curbside.sources.schema import struct_of
from curbside.sources.tables import read_trips

ZONES = (1, 24)
SHORT_WINDOW = ("2024-01-01 00:00:00", "2024-01-25 23:59:59")
STUDY_WINDOW = ("2024-01-01 00:00:00", "2024-01-30 23:59:59")
TEST_START = "2024-01-20 00:00:00"
# Declared, so that no job is spent on reading them from file footers.
EVENTS = struct_of(
    {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    }
)
NATION = struct_of({"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"})
REGION = struct_of({"r_regionkey": "int", "r_name": "string"})
# Holidays of the test set inside the events' month.
CALENDAR = {day: scale for day, scale in HOLIDAYS["test"].items() if day < "2024-02-01"}


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_trips(spark, f"{sf}/events.parquet", schema=EVENTS)


def _dropoff() -> Column:
    """The dropoff instant, as a one-row generator.

    Conditions on a generated column are not rewritten into conditions on its
    inputs, so the costly addition runs once per event instead of once per
    condition, as if the dropoff were stored.
    """
    seconds = F.round(F.col("value") * 60).cast("bigint")
    return F.inline(F.array(F.struct(F.timestamp_add("SECOND", seconds, "ts").alias(DROPOFF))))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "event_id",
        F.col("ts").alias(PICKUP),
        _dropoff(),
        ((F.col("event_id") % 5200) / F.lit(100.0)).alias("trip_distance"),
        (F.col("user_id") % 27).cast("int").alias("pulocationid"),
        (F.col("event_id") % 27).cast("int").alias("dolocationid"),
    )


def landing(spark: SparkSession, sf: str) -> DataFrame:
    """Trips as a month lands: mixed-case names, wide types, a text flag."""
    kind = F.col("event_type")
    flag = (
        F.when(kind == "view", "Y").when(kind == "click", "N").when(kind == "error", "X")
    )
    return events(spark, sf).select(
        "event_id",
        (F.col("user_id") % 3).alias("VendorID"),
        F.col("ts").alias(PICKUP),
        _dropoff(),
        (F.col("event_id") % 9 + F.lit(0.7)).alias("passenger_count"),
        ((F.col("event_id") % 5200) / F.lit(100.0)).alias("trip_distance"),
        F.when(kind != "signup", (F.col("event_id") % 7).cast("double")).alias("RatecodeID"),
        flag.alias("store_and_fwd_flag"),
        (F.col("user_id") % 27).alias("PULocationID"),
        (F.col("event_id") % 27).alias("DOLocationID"),
        (F.col("event_id") % 4 * F.lit(1_000_000_000)).alias("payment_type"),
    )


def zones(spark: SparkSession, sf: str) -> DataFrame:
    nation = spark.read.schema(NATION).parquet(f"{sf}/nation.parquet")
    region = spark.read.schema(REGION).parquet(f"{sf}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def boroughs(spark: SparkSession, sf: str) -> list[str]:
    """The region table is the fixed list of boroughs here, one row each."""
    region = spark.read.schema(REGION).parquet(f"{sf}/region.parquet")
    return [row["r_name"] for row in region.sort("r_name").collect()]


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """One row per hour that has events; some measures are NULL in some hours."""
    kind, value = F.col("event_type"), F.col("value")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (
        events(spark, sf)
        .groupBy(hour_slot("ts").alias("slot"))
        .agg(
            (F.min("value") - 5).alias("temp"),
            F.min(F.when(kind == "error", value)).alias("snow"),
            F.min(F.when(kind == "view", value)).alias("snowdepth"),
            F.max(F.when(kind == "signup", value)).alias("windgust"),
            F.max("value").alias("visibility"),
            F.when(F.count_if(kind == "purchase") > 0, "Rain, Overcast")
            .otherwise("Clear")
            .alias("conditions"),
        )
        .withColumn("datetime", F.timestamp_add("HOUR", F.col("slot"), epoch))
        .select(*WEATHER_COLUMN_TYPES)
    )


def calendar(spark: SparkSession) -> DataFrame:
    return calendar_table(spark, CALENDAR)


# The oracle's side of the views above and of the tables most queries start from.
CALENDAR_SQL = ", ".join(f"(date '{day}', {scale})" for day, scale in CALENDAR.items())
SQL = f"""
trips as (
  select event_id, ts as tpep_pickup_datetime,
    ts + to_seconds(cast(round(value * 60) as bigint)) as tpep_dropoff_datetime,
    (event_id % 5200) / 100.0 as trip_distance,
    cast(user_id % 27 as int) as pulocationid, cast(event_id % 27 as int) as dolocationid
  from events),
landing as (
  select event_id, user_id % 3 as VendorID, ts as tpep_pickup_datetime,
    ts + to_seconds(cast(round(value * 60) as bigint)) as tpep_dropoff_datetime,
    cast(event_id % 9 as double) + cast(0.7 as double) as passenger_count,
    (event_id % 5200) / 100.0 as trip_distance,
    case when event_type <> 'signup' then cast(event_id % 7 as double) end as RatecodeID,
    case event_type when 'view' then 'Y' when 'click' then 'N' when 'error' then 'X' end
      as store_and_fwd_flag,
    user_id % 27 as PULocationID, event_id % 27 as DOLocationID,
    (event_id % 4) * 1000000000 as payment_type
  from events),
conformed as (
  select event_id, cast(VendorID as int) as vendorid, tpep_pickup_datetime, tpep_dropoff_datetime,
    cast(trunc(passenger_count) as int) as passenger_count, trip_distance,
    cast(trunc(RatecodeID) as int) as ratecodeid,
    case store_and_fwd_flag when 'Y' then true when 'N' then false end as store_and_fwd_flag,
    cast(PULocationID as int) as pulocationid, cast(DOLocationID as int) as dolocationid,
    try_cast(payment_type as int) as payment_type
  from landing),
zones as (
  select n_nationkey as LocationID, r_name as Borough, n_name as Zone
  from nation join region on n_regionkey = r_regionkey),
weather as (
  select date_trunc('hour', ts) as datetime, min(value) - 5 as temp,
    min(case when event_type = 'error' then value end) as snow,
    min(case when event_type = 'view' then value end) as snowdepth,
    max(case when event_type = 'signup' then value end) as windgust,
    max(value) as visibility,
    case when count(*) filter (where event_type = 'purchase') > 0
      then 'Rain, Overcast' else 'Clear' end as conditions
  from events group by 1),
calendar(date, scale) as (values {CALENDAR_SQL}),
timed as (
  select *, (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000)
    / 60 as trip_duration
  from trips),
speeds as (
  select *, case when trip_duration <> 0 then trip_distance / (trip_duration / 60) end as speed
  from timed),
cleaned as (
  select * from speeds
  where tpep_pickup_datetime between timestamp '2024-01-01' and timestamp '2024-01-30 23:59:59'
    and tpep_dropoff_datetime between timestamp '2024-01-01' and timestamp '2024-01-30 23:59:59'
    and pulocationid between 1 and 24 and dolocationid between 1 and 24
    and trip_distance between 1 and 50 and trip_duration between 5 and 120 and speed < 65),
quartiles as (
  select count(*) as n, quantile_cont(speed, 0.25) as q1, quantile_cont(speed, 0.75) as q3
  from cleaned),
bounds as (
  select n, q1, q3, q1 - (sqrt(ln(n)) - 0.5) * (q3 - q1) as lower_bound,
    q3 + (sqrt(ln(n)) - 0.5) * (q3 - q1) as upper_bound
  from quartiles),
curated as (
  select c.*, ln(trip_duration) as log_trip_duration,
    dayofweek(tpep_pickup_datetime) in (0, 6) as is_weekend,
    k.scale is not null as is_holiday, coalesce(k.scale, 0) as holiday_scale
  from cleaned c cross join bounds b
  left join calendar k on cast(c.tpep_pickup_datetime as date) = k.date
  where speed between 3 and b.upper_bound),
fair_weather as (
  select datetime, temp, case when snowdepth < snow then snow else snowdepth end as snowdepth,
    windgust, visibility, case when conditions like '%Rain%' then 1 else 0 end as rain
  from weather),
complete_weather as (
  select * from fair_weather
  where temp is not null and snowdepth is not null and windgust is not null
    and visibility is not null
    and datetime between timestamp '2024-01-01' and timestamp '2024-01-30 23:59:59'),
merged as (
  select strftime(c.tpep_pickup_datetime, '%Y-%m-%d') as day,
    cast(hour(c.tpep_pickup_datetime) as int) as hour,
    c.*, w.temp, w.snowdepth, w.windgust, w.visibility, w.rain, z.Borough
  from curated c
  join complete_weather w on date_trunc('hour', c.tpep_pickup_datetime) = w.datetime
  join zones z on c.pulocationid = z.LocationID),
train as (select * from merged where tpep_pickup_datetime < timestamp '2024-01-20'),
test as (select * from merged where tpep_pickup_datetime >= timestamp '2024-01-20')
"""


def with_views(select: str) -> str:
    return f"with {SQL.strip()}\n{select.strip()}"
