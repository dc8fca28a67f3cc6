"""Queries on sources, sinks and schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbside.catalog import steps, views
from curbside.catalog.registry import query
from curbside.constants import PICKUP
from curbside.operators.joins import join_zones
from curbside.sources import schema, tables
from curbside.sources.landing import take_in_months
from curbside.sources.publication import publish_table, read_published
from curbside.workspace import stage_path

# How a NULL integer or boolean is shown differs between clients, so the queries
# below give -1 and the text 'null' for them, on both sides.
SHOWN_SQL = """vendorid, tpep_pickup_datetime, tpep_dropoff_datetime,
    coalesce(passenger_count, -1) as passenger_count, trip_distance,
    coalesce(ratecodeid, -1) as ratecodeid,
    coalesce(cast(store_and_fwd_flag as varchar), 'null') as store_and_fwd_flag,
    pulocationid, dolocationid, coalesce(payment_type, -1) as payment_type"""


def shown(df: DataFrame) -> DataFrame:
    if schema.FLAG_COLUMN in df.columns:
        text = F.col(schema.FLAG_COLUMN).cast("string")
        df = df.withColumn(schema.FLAG_COLUMN, F.coalesce(text, F.lit("null")))
    return df.fillna(-1, [c for c in schema.INTEGER_COLUMNS if c in df.columns])


@query(
    "scan_trips",
    """select event_id, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance,
         pulocationid, dolocationid from trips""",
)
def scan_trips(spark, sf):
    return views.trips(spark, sf)


@query("scan_with_schema", "select value, ts, event_id from events")
def scan_with_schema(spark, sf):
    wanted = schema.struct_of({"value": "double", "ts": "timestamp_ntz", "event_id": "bigint"})
    return tables.read_trips(spark, f"{sf}/event*.parquet", schema=wanted)


@query(
    "scan_csv_weather",
    "select datetime, temp, snow, snowdepth, windgust, visibility, conditions from weather",
)
def scan_csv_weather(spark, sf):
    path = stage_path(spark, "weather-csv")
    views.weather(spark, sf).write.csv(path, header=True)
    return tables.read_weather(spark, path)


@query(
    "scan_csv_zones",
    "select LocationID, Borough, Zone, 'Boro Zone' as service_zone from zones",
)
def scan_csv_zones(spark, sf):
    path = stage_path(spark, "zones-csv")
    views.zones(spark, sf).write.csv(path, header=True)
    return tables.read_zones(spark, path)


@query(
    "write_roundtrip",
    """select event_id, tpep_pickup_datetime, trip_distance, trip_duration, speed from cleaned""",
)
def write_roundtrip(spark, sf):
    path = stage_path(spark, "cleaned")
    kept = steps.cleaned(spark, sf).select(
        "event_id", "tpep_pickup_datetime", "trip_distance", "trip_duration", "speed"
    )
    tables.write_table(kept, path)
    return tables.read_trips(spark, path)


def _by_borough(spark, sf) -> str:
    path = stage_path(spark, "boroughs")
    placed = join_zones(steps.cleaned(spark, sf), views.zones(spark, sf))
    tables.write_by_borough(placed.select("event_id", "pulocationid", "speed", "Borough"), path)
    return path


@query(
    "split_boroughs",
    """select event_id, pulocationid, speed, Borough
       from cleaned join zones on pulocationid = LocationID""",
)
def split_boroughs(spark, sf):
    return tables.read_boroughs(spark, _by_borough(spark, sf))


@query(
    "read_borough_partition",
    """select event_id, pulocationid, speed, Borough
       from cleaned join zones on pulocationid = LocationID where Borough in ('ASIA', 'EUROPE')""",
)
def read_borough_partition(spark, sf):
    return tables.read_boroughs(spark, _by_borough(spark, sf), ["ASIA", "EUROPE"])


# Thirds of the events' month stand in for three landing months.
LANDED_MONTHS = {2024: [1, 2, 3]}


def _landing_months(spark, sf) -> list[DataFrame]:
    """Three months whose columns differ in order, names and types, one lacking a column."""
    whole = views.landing(spark, sf)
    third = F.least(F.floor((F.dayofmonth("tpep_pickup_datetime") - 1) / 10), F.lit(2))
    first, second, last = (whole.where(third == i) for i in range(3))
    second = second.select(*reversed(second.columns)).withColumn(
        "passenger_count", F.col("passenger_count").cast("string")
    )
    last = schema.lowercase_columns(last).drop("ratecodeid")
    return [first, second, last]


@query(
    "schema_integration",
    f"""select {SHOWN_SQL}, 'train_set' as set_name, 2024 as year,
         cast(least((day(tpep_pickup_datetime) - 1) // 10, 2) + 1 as int) as month
       from (select * replace (
               case when day(tpep_pickup_datetime) <= 20 then ratecodeid end as ratecodeid)
             from conformed)""",
)
def schema_integration(spark, sf):
    landing, raw = stage_path(spark, "landing"), stage_path(spark, "raw")
    paths = tables.month_paths(landing, "train_set", LANDED_MONTHS)
    for month, path in zip(_landing_months(spark, sf), paths):
        month.write.parquet(path)
    tables.integrate_months(spark, landing, raw, "train_set", LANDED_MONTHS)
    return shown(tables.read_trips(spark, raw))


@query(
    "landing_rerun",
    f"""select {SHOWN_SQL}, 'train_set' as set_name, 2024 as year,
         cast(least((day(tpep_pickup_datetime) - 1) // 10, 2) + 1 as int) as month
       from (select * replace (
               case when day(tpep_pickup_datetime) <= 20 then ratecodeid end as ratecodeid)
             from conformed)""",
)
def landing_rerun(spark, sf):
    """Months taken in one after the other; the first lands again with other files before the last run."""
    landing, raw = stage_path(spark, "landing"), stage_path(spark, "raw")
    paths = tables.month_paths(landing, "train_set", LANDED_MONTHS)
    months = list(zip(_landing_months(spark, sf), paths))
    first, path = months[0]
    first.where("event_id % 2 = 0").write.parquet(path)
    take_in_months(spark, landing, raw, "train_set", {2024: [1]})
    for month, path in months:
        month.write.mode("overwrite").parquet(path)
    take_in_months(spark, landing, raw, "train_set", LANDED_MONTHS)
    return shown(tables.read_trips(spark, raw))


@query("published_trips", "select event_id, tpep_pickup_datetime, trip_distance from trips where event_id % 3 <> 0")
def published_trips(spark, sf):
    """A published table replaced by a part of itself, as a plain overwrite could not."""
    path = stage_path(spark, "published")
    trips = views.trips(spark, sf).select("event_id", PICKUP, "trip_distance")
    publish_table(trips, path)
    publish_table(read_published(spark, path).where("event_id % 3 <> 0"), path)
    return read_published(spark, path)


@query(
    "clustered_months",
    f"""select {SHOWN_SQL}, 'train_set' as set_name, 2024 as year,
         cast(least((day(tpep_pickup_datetime) - 1) // 10, 2) + 1 as int) as month
       from (select * replace (
               case when day(tpep_pickup_datetime) <= 20 then ratecodeid end as ratecodeid)
             from conformed)
       where tpep_pickup_datetime between timestamp '2024-01-08' and timestamp '2024-01-13 12:00:00'""",
)
def clustered_months(spark, sf):
    """Days out of two months that were clustered by pickup."""
    landing, raw = stage_path(spark, "landing"), stage_path(spark, "raw")
    paths = tables.month_paths(landing, "train_set", LANDED_MONTHS)
    for month, path in zip(_landing_months(spark, sf), paths):
        month.write.parquet(path)
    tables.integrate_months(spark, landing, raw, "train_set", LANDED_MONTHS, clustered_by=PICKUP)
    first, last = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-08 00:00:00", "2024-01-13 12:00:00"))
    return shown(tables.read_trips(spark, raw).where(F.col(PICKUP).between(first, last)))


@query(
    "boroughs_of_zones",
    """select event_id, Borough from merged
       where Borough in (select Borough from zones where LocationID in (3, 7))""",
)
def boroughs_of_zones(spark, sf):
    """Trips of the boroughs that two zones lie in; only their directories are read."""
    path = stage_path(spark, "analysis")
    tables.write_by_borough(steps.merged(spark, sf).select("event_id", "Borough"), path)
    named = views.zones(spark, sf).where(F.col("LocationID").isin(3, 7))
    return tables.read_boroughs_of(spark, path, named).select("event_id", "Borough")


@query(
    "canonical_schema",
    """select * from (
         select 0 as position, 'event_id' as column_name, 'bigint' as data_type,
           count(event_id) as non_null from conformed
         union all select 1, 'vendorid', 'int', count(vendorid) from conformed
         union all select 2, 'tpep_pickup_datetime', 'timestamp_ntz',
           count(tpep_pickup_datetime) from conformed
         union all select 3, 'tpep_dropoff_datetime', 'timestamp_ntz',
           count(tpep_dropoff_datetime) from conformed
         union all select 4, 'passenger_count', 'int', count(passenger_count) from conformed
         union all select 5, 'trip_distance', 'double', count(trip_distance) from conformed
         union all select 6, 'ratecodeid', 'int', count(ratecodeid) from conformed
         union all select 7, 'store_and_fwd_flag', 'boolean', count(store_and_fwd_flag)
           from conformed
         union all select 8, 'pulocationid', 'int', count(pulocationid) from conformed
         union all select 9, 'dolocationid', 'int', count(dolocationid) from conformed
         union all select 10, 'payment_type', 'int', count(payment_type) from conformed)""",
)
def canonical_schema(spark, sf):
    landing = views.landing(spark, sf)
    return schema.schema_rows(schema.conform_schema(landing, schema.canonical_schema(landing)))


@query(
    "cast_ints",
    """select event_id, vendorid, passenger_count, coalesce(ratecodeid, -1) as ratecodeid,
         pulocationid, dolocationid, coalesce(payment_type, -1) as payment_type from conformed""",
)
def cast_ints(spark, sf):
    lowered = schema.lowercase_columns(views.landing(spark, sf))
    return shown(schema.narrow_integers(lowered).select("event_id", *schema.INTEGER_COLUMNS))


@query(
    "yn_to_boolean",
    """select event_id, coalesce(cast(store_and_fwd_flag as varchar), 'null') as store_and_fwd_flag
       from conformed""",
)
def yn_to_boolean(spark, sf):
    flagged = schema.flag_to_boolean(views.landing(spark, sf))
    return shown(flagged.select("event_id", "store_and_fwd_flag"))


@query(
    "lowercase_columns",
    """select event_id, VendorID as vendorid, tpep_pickup_datetime, tpep_dropoff_datetime,
         passenger_count, trip_distance, RatecodeID as ratecodeid, store_and_fwd_flag,
         PULocationID as pulocationid, DOLocationID as dolocationid, payment_type from landing""",
)
def lowercase_columns(spark, sf):
    return schema.lowercase_columns(views.landing(spark, sf))


@query("conform_schema", f"select {SHOWN_SQL} from conformed")
def conform_schema(spark, sf):
    return shown(schema.conform_schema(views.landing(spark, sf)))


@query(
    "schema_diff",
    """select * from (
         select 'event_id' as column_name, 'bigint' as left_type, count(event_id) as left_non_null,
           cast(null as varchar) as right_type, 0 as right_non_null,
           'left only' as status from conformed
         union all select 'vendorid', 'bigint', count(*), 'int', count(vendorid), 'type differs'
           from conformed
         union all select 'tpep_pickup_datetime', 'timestamp_ntz', count(*), 'timestamp_ntz',
           count(*), 'same' from conformed
         union all select 'tpep_dropoff_datetime', 'timestamp_ntz', count(*), 'timestamp_ntz',
           count(*), 'same' from conformed
         union all select 'passenger_count', 'double', count(*), 'int', count(passenger_count),
           'type differs' from conformed
         union all select 'trip_distance', 'double', count(*), 'double', count(*), 'same'
           from conformed
         union all select 'ratecodeid', 'double', count(ratecodeid), 'int', count(ratecodeid),
           'type differs' from conformed
         union all select 'store_and_fwd_flag', 'string',
           (select count(store_and_fwd_flag) from landing), 'boolean', count(store_and_fwd_flag),
           'type differs' from conformed
         union all select 'pulocationid', 'bigint', count(*), 'int', count(pulocationid),
           'type differs' from conformed
         union all select 'dolocationid', 'bigint', count(*), 'int', count(dolocationid),
           'type differs' from conformed
         union all select 'payment_type', 'bigint', count(*), 'int', count(payment_type),
           'type differs' from conformed)""",
)
def schema_diff(spark, sf):
    landing = views.landing(spark, sf)
    return schema.schema_diff(landing, schema.conform_schema(landing))
