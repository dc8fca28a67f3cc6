"""Queries on joins, aggregates, reports and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbside.catalog import steps, views
from curbside.catalog.registry import query
from curbside.constants import DROPOFF, PICKUP, QUANTILE_RELATIVE_ERROR
from curbside.models.duration import (
    apply_line,
    borough_lines,
    fitted_lines,
    linear_regression,
    predict_on,
    stump,
    univariate_line,
)
from curbside.operators import holidays, joins, outliers, quality, sampling, stats
from curbside.operators.quantile_state import count_state, refined_quantiles
from curbside.operators.quantiles import approx_quantiles, exact_quantiles
from curbside.sources import schema
from curbside.workspace import staged


def rounded(df, *columns, digits=6):
    """The named double columns to the digits of the oracle comparison."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


# --- joins -------------------------------------------------------------------


@query(
    "join_weather",
    """select strftime(tpep_pickup_datetime, '%Y-%m-%d') as day,
         cast(hour(tpep_pickup_datetime) as int) as hour, event_id, trip_duration,
         temp, snowdepth, windgust, visibility, rain
       from cleaned join complete_weather
         on date_trunc('hour', tpep_pickup_datetime) = datetime""",
)
def join_weather(spark, sf):
    trips = steps.cleaned(spark, sf).select("event_id", PICKUP, "trip_duration")
    return joins.join_weather(trips, steps.complete_weather(spark, sf)).drop(PICKUP)


@query(
    "join_zones",
    """select event_id, pulocationid, Borough from trips
       join zones on pulocationid = LocationID""",
)
def join_zones(spark, sf):
    trips = views.trips(spark, sf).select("event_id", "pulocationid")
    return joins.join_zones(trips, views.zones(spark, sf))


@query(
    "flag_holiday",
    """select event_id, scale is not null as is_holiday, coalesce(scale, 0) as holiday_scale
       from trips left join calendar on cast(tpep_pickup_datetime as date) = date""",
)
def flag_holiday(spark, sf):
    flagged = holidays.flag_holiday(views.trips(spark, sf), views.calendar(spark))
    return flagged.select("event_id", "is_holiday", "holiday_scale")


def _line_sql(feature: str) -> str:
    return f"""(select regr_slope(trip_duration, {feature}) as slope,
      regr_intercept(trip_duration, {feature}) as intercept from train)"""


def _predicted_sql(feature: str) -> str:
    return f"""(select day, hour, Borough, trip_duration, speed,
        intercept + slope * {feature} as prediction,
        trip_distance / ((intercept + slope * {feature}) / 60) as predicted_speed
      from test cross join {_line_sql(feature)})"""


def _predictions(spark, sf, *features):
    """Test trips predicted by one line per feature, fitted on the train trips."""
    train, test = steps.stored_split(spark, sf)
    return [apply_line(test, univariate_line(train, name), name) for name in features]


# The cut of hours with the least squared error on both sides, and the means beside it:
# a tree of depth one.
STUMP_SQL = """(select cut, low, high from (
    select cut, avg(trip_duration) filter (where hour <= cut) as low,
      avg(trip_duration) filter (where hour > cut) as high,
      var_pop(trip_duration) filter (where hour <= cut) * count(*) filter (where hour <= cut)
        + var_pop(trip_duration) filter (where hour > cut) * count(*) filter (where hour > cut) as error
    from train cross join (select distinct hour as cut from train) group by cut
    having count(*) filter (where hour > cut) > 0)
  order by error, cut limit 1)"""


@query(
    "hourly_pred_vs_actual",
    f"""select day, hour, round(avg_actual_speed, 6) as avg_actual_speed,
         round(avg_linear_speed, 6) as avg_linear_speed,
         round(avg_forest_speed, 6) as avg_forest_speed
       from (select day, hour, avg(speed) as avg_actual_speed,
               avg(predicted_speed) as avg_linear_speed
             from {_predicted_sql("trip_distance")} group by day, hour)
       full join (select day, hour, avg(trip_distance / (if(hour <= cut, low, high) / 60))
               as avg_forest_speed
             from test cross join {STUMP_SQL} group by day, hour) using (day, hour)""",
)
def hourly_pred_vs_actual(spark, sf):
    """A fitted linear regression beside a fitted forest, both small enough for SQL to follow."""
    train, test = steps.stored_split(spark, sf)
    linear = predict_on(train, test, ["trip_distance"], linear_regression("features"))
    forest = predict_on(train, test, ["hour"], stump())
    table = stats.compare_hourly(linear, forest, keys=("day",))
    return rounded(table, "avg_actual_speed", "avg_linear_speed", "avg_forest_speed")


@query(
    "rf_stump",
    f"""select distinct hour, round(if(hour <= cut, low, high), 6) as prediction
       from test cross join {STUMP_SQL}""",
)
def rf_stump(spark, sf):
    train, test = steps.stored_split(spark, sf)
    predicted = predict_on(train, test, ["hour"], stump()).select("hour", "prediction").distinct()
    return rounded(predicted, "prediction")


@query(
    "hourly_speed",
    f"""select hour, round(avg(speed), 6) as avg_actual_speed,
         round(avg(predicted_speed), 6) as avg_predicted_speed
       from {_predicted_sql("trip_distance")} where day = '2024-01-22' group by hour""",
)
def hourly_speed(spark, sf):
    (predictions,) = _predictions(spark, sf, "trip_distance")
    table = stats.hourly_speed(predictions, "2024-01-22")
    return rounded(table, "avg_actual_speed", "avg_predicted_speed")


@query(
    "mae",
    f"""select Borough, round(avg(abs(trip_duration - prediction)), 6) as mae,
         count(*) as predictions from {_predicted_sql("trip_distance")} group by Borough""",
)
def mae(spark, sf):
    (predictions,) = _predictions(spark, sf, "trip_distance")
    return rounded(stats.mean_absolute_error(predictions, "Borough"), "mae")


@query(
    "linreg_univariate",
    """select round(regr_slope(trip_duration, trip_distance), 6) as slope,
         round(regr_intercept(trip_duration, trip_distance), 6) as intercept,
         count(*) as n from train""",
)
def linreg_univariate(spark, sf):
    train, _ = steps.split(steps.merged(spark, sf))
    line = fitted_lines(train, ["trip_distance"]).withColumnRenamed("trip_distance", "slope")
    return rounded(line.select("slope", "intercept", "n"), "slope", "intercept")


@query(
    "linreg_one_column",
    """select Borough, round(regr_slope(trip_duration, trip_distance), 6) as trip_distance,
         round(regr_intercept(trip_duration, trip_distance), 6) as intercept, count(*) as n
       from train group by Borough""",
)
def linreg_one_column(spark, sf):
    train, _ = steps.stored_split(spark, sf)
    lines = borough_lines(train, ["trip_distance"], views.boroughs(spark, sf))
    return rounded(lines, "trip_distance", "intercept")


@query(
    "linreg_two_columns",
    """select Borough, round(b1, 6) as trip_distance, round(b2, 6) as temp,
         round(my - b1 * m1 - b2 * m2, 6) as intercept, n
       from (select *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) as b1,
               (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) as b2
             from (select Borough, count(*) as n, avg(trip_duration) as my,
                     avg(trip_distance) as m1, avg(temp) as m2,
                     var_pop(trip_distance) as s11, var_pop(temp) as s22,
                     covar_pop(trip_distance, temp) as s12,
                     covar_pop(trip_distance, trip_duration) as s1y,
                     covar_pop(temp, trip_duration) as s2y
                   from train group by Borough))""",
)
def linreg_two_columns(spark, sf):
    train, _ = steps.stored_split(spark, sf)
    lines = borough_lines(train, ["trip_distance", "temp"], views.boroughs(spark, sf))
    return rounded(lines, "trip_distance", "temp", "intercept")


# --- quality -----------------------------------------------------------------


def _null_sql(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as nulls from {table}" for c in columns
    )


@query("null_counts", _null_sql("conformed", schema.TRIP_SCHEMA.names))
def null_counts(spark, sf):
    return quality.null_counts(schema.conform_schema(views.landing(spark, sf)))


@query(
    "time_range",
    """select 'tpep_pickup_datetime' as column_name, min(tpep_pickup_datetime) as earliest,
         max(tpep_pickup_datetime) as latest from trips
       union all select 'tpep_dropoff_datetime', min(tpep_dropoff_datetime),
         max(tpep_dropoff_datetime) from trips""",
)
def time_range(spark, sf):
    return quality.time_range(views.trips(spark, sf), [PICKUP, DROPOFF])


def _describe_sql(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"""select '{c}' as column_name, count({c}) as count, round(avg({c}), 6) as mean,
          round(stddev_samp({c}), 6) as stddev, cast(min({c}) as double) as min,
          cast(max({c}) as double) as max from {table}"""
        for c in columns
    )


@query(
    "describe_numeric",
    _describe_sql("speeds", ["trip_distance", "pulocationid", "trip_duration", "speed"]),
)
def describe_numeric(spark, sf):
    columns = ["trip_distance", "pulocationid", "trip_duration", "speed"]
    return rounded(quality.describe_numeric(steps.speeds(spark, sf), columns), "mean", "stddev")


@query(
    "row_counts",
    """select 'trips' as step, count(*) as row_count from trips
       union all select 'cleaned', count(*) from cleaned
       union all select 'curated', count(*) from curated
       union all select 'weather', count(*) from weather""",
)
def row_counts(spark, sf):
    tables = {
        "trips": views.trips(spark, sf),
        "cleaned": steps.cleaned(spark, sf),
        "curated": steps.curated(spark, sf),
        "weather": views.weather(spark, sf),
    }
    counted = [quality.row_count(df).select(F.lit(n).alias("step"), "row_count") for n, df in tables.items()]
    first, *others = counted
    for other in others:
        first = first.unionByName(other)
    return first


def _profile_sql(table: str, columns: list[str], times: list[str], numbers: list[str]) -> str:
    rows = []
    for c in columns:
        time = f"min({c}), max({c})" if c in times else "null::timestamp, null::timestamp"
        number = (
            f"round(avg({c}), 6), round(stddev_samp({c}), 6), min({c})::double, max({c})::double"
            if c in numbers
            else "null::double, null::double, null::double, null::double"
        )
        rows.append(f"select '{c}', count(*) - count({c}), count({c}), {time}, {number} from {table}")
    return f"""select * from ({" union all ".join(rows)})
      as t(column_name, nulls, count, earliest, latest, mean, stddev, min, max)"""


@query(
    "quality_report",
    _profile_sql(
        "trips",
        ["event_id", PICKUP, DROPOFF, "trip_distance", "pulocationid", "dolocationid"],
        quality.TRIP_REPORT_TIMES,
        quality.TRIP_REPORT_NUMBERS,
    ),
)
def quality_report(spark, sf):
    return rounded(quality.trip_quality(views.trips(spark, sf)), "mean", "stddev")


@query(
    "weather_quality",
    _profile_sql(
        "fair_weather",
        ["datetime", "temp", "snowdepth", "windgust", "visibility", "rain"],
        quality.WEATHER_REPORT_TIMES,
        quality.WEATHER_REPORT_NUMBERS,
    ),
)
def weather_quality(spark, sf):
    return rounded(quality.weather_quality(steps.fair_weather(spark, sf)), "mean", "stddev")


# --- quantiles and outliers --------------------------------------------------

QUARTILE_SQL = """
  select p as probability, n, round(case p when 0.25 then q1 else q3 end, 6) as quantile
  from {source} cross join (values (0.25::double), (0.75::double)) as t(p)"""


@query("speed_quartiles", QUARTILE_SQL.format(source="quartiles"))
def speed_quartiles(spark, sf):
    return rounded(exact_quantiles(steps.cleaned(spark, sf), "speed", [0.25, 0.75]), "quantile")


@query("speed_quartiles_narrowed", QUARTILE_SQL.format(source="quartiles"))
def speed_quartiles_narrowed(spark, sf):
    """A coarse sketch, which leaves many values around each rank even here."""
    found = exact_quantiles(steps.cleaned(spark, sf), "speed", [0.25, 0.75], accuracy=20)
    return rounded(found, "quantile")


@query("speed_quartiles_merged", QUARTILE_SQL.format(source="quartiles"))
def speed_quartiles_merged(spark, sf):
    """From the states of single days, stored and merged; of the trips only two ranges are read again."""
    trips = staged(steps.cleaned(spark, sf).select(F.to_date(PICKUP).alias("day"), "speed"), "speeds")
    days = staged(count_state(trips, "speed", ["day"]), "speed-states")
    return rounded(refined_quantiles(days, trips, "speed", [0.25, 0.75]), "quantile")


@query(
    "value_quartiles_by_type",
    "select event_type, probability, n, quantile from ("
    + QUARTILE_SQL.replace("select p", "select event_type, p").format(
        source="""(select event_type, count(*) as n, quantile_cont(value, 0.25) as q1,
          quantile_cont(value, 0.75) as q3 from events group by event_type)"""
    )
    + ")",
)
def value_quartiles_by_type(spark, sf):
    values = views.events(spark, sf).select("event_type", "value")
    found = exact_quantiles(values, "value", [0.25, 0.75], ["event_type"])
    return rounded(found, "quantile")


@query(
    "value_quartiles_by_type_merged",
    "select event_type, probability, n, quantile from ("
    + QUARTILE_SQL.replace("select p", "select event_type, p").format(
        source="""(select event_type, count(*) as n, quantile_cont(value, 0.25) as q1,
          quantile_cont(value, 0.75) as q3 from events group by event_type)"""
    )
    + ")",
)
def value_quartiles_by_type_merged(spark, sf):
    values = views.events(spark, sf).select("event_type", F.to_date("ts").alias("day"), "value")
    days = staged(count_state(values, "value", ["event_type", "day"]), "value-states")
    return rounded(refined_quantiles(days, values, "value", [0.25, 0.75], ["event_type"]), "quantile")


@query(
    "speed_quartiles_approx",
    """select p as probability, count(*) as n, true as within_error
       from cleaned cross join (values (0.25::double), (0.75::double)) as t(p) group by p""",
)
def speed_quartiles_approx(spark, sf):
    """Whether the ranks that each approximate quantile takes up reach its own within the error."""
    speeds = steps.cleaned(spark, sf)
    found = approx_quantiles(speeds, "speed", [0.25, 0.75])
    below = F.count_if(F.col("speed") < F.col("quantile"))
    up_to = F.count_if(F.col("speed") <= F.col("quantile"))
    slack = F.lit(QUANTILE_RELATIVE_ERROR) * F.col("n") + 1
    wanted = F.col("probability") * F.col("n")
    # Found quantiles are two rows.
    return (
        speeds.select("speed")
        .crossJoin(F.broadcast(found))
        .groupBy("probability", "n")
        .agg(below.alias("below"), up_to.alias("up_to"))
        .select(
            "probability",
            "n",
            ((F.col("below") - slack <= wanted) & (wanted <= F.col("up_to") + slack)).alias("within_error"),
        )
    )


BOUNDS_SQL = """select '{c}' as measure, n, round(q1, 6) as q1, round(q3, 6) as q3,
    round(q1 - (sqrt(ln(n)) - 0.5) * (q3 - q1), 6) as lower_bound,
    round(q3 + (sqrt(ln(n)) - 0.5) * (q3 - q1), 6) as upper_bound
  from (select count(*) as n, quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3
        from {t})"""


@query(
    "iqr_bounds",
    " union all ".join(BOUNDS_SQL.format(c=c, t=t) for c, t in (("speed", "cleaned"), ("value", "events"))),
)
def iqr_bounds(spark, sf):
    speed = outliers.iqr_bounds(steps.cleaned(spark, sf), "speed")
    value = outliers.iqr_bounds(views.events(spark, sf), "value")
    both = speed.withColumn("measure", F.lit("speed")).unionByName(
        value.withColumn("measure", F.lit("value"))
    )
    return rounded(both, "q1", "q3", "lower_bound", "upper_bound")


@query(
    "iqr_bounds_by_type",
    """select event_type, n, round(q1, 6) as q1, round(q3, 6) as q3,
         round(q1 - (sqrt(ln(n)) - 0.5) * (q3 - q1), 6) as lower_bound,
         round(q3 + (sqrt(ln(n)) - 0.5) * (q3 - q1), 6) as upper_bound
       from (select event_type, count(*) as n, quantile_cont(value, 0.25) as q1,
               quantile_cont(value, 0.75) as q3 from events group by event_type)""",
)
def iqr_bounds_by_type(spark, sf):
    bounds = outliers.iqr_bounds(views.events(spark, sf), "value", ["event_type"])
    return rounded(bounds, "q1", "q3", "lower_bound", "upper_bound")


@query(
    "top_outliers",
    """select event_id, value from events cross join (
         select sqrt(ln(count(*))) - 0.5 as f, quantile_cont(value, 0.25) as q1,
           quantile_cont(value, 0.75) as q3 from events)
       where value < q1 - f * (q3 - q1) or value > q3 + f * (q3 - q1)
       order by value desc, event_id limit 20""",
)
def top_outliers(spark, sf):
    values = views.events(spark, sf).select("event_id", "value")
    return outliers.top_outliers(values, "value", ["event_id"])


# --- summaries ---------------------------------------------------------------


@query(
    "avg_speed_by_bin",
    """select cast(trunc(temp / 2) as int) * 2 as bin, round(avg(speed), 6) as avg_speed,
         count(*) as trips from merged group by 1""",
)
def avg_speed_by_bin(spark, sf):
    return rounded(stats.avg_speed_by_bin(steps.merged(spark, sf), "temp", 2), "avg_speed")


DAY_SQL = "strftime(tpep_pickup_datetime, '%Y-%m-%d')"


@query("trips_per_day", f"select {DAY_SQL} as day, count(*) as trip_count from cleaned group by 1")
def trips_per_day(spark, sf):
    return stats.trips_per_day(steps.cleaned(spark, sf))


@query(
    "days_min_trips",
    f"""select {DAY_SQL} as day, count(*) as trip_count from cleaned group by 1
       having count(*) >= 125""",
)
def days_min_trips(spark, sf):
    return stats.days_with_trips(steps.cleaned(spark, sf), 125)


@query("distinct_dates", "select distinct cast(tpep_pickup_datetime as date) as date from trips")
def distinct_dates(spark, sf):
    return stats.distinct_dates(views.trips(spark, sf))


@query(
    "trips_per_borough",
    """select case when tpep_pickup_datetime < timestamp '2024-01-20' then 'train' else 'test' end
         as set_name, Borough, count(*) as trips
       from cleaned join zones on pulocationid = LocationID group by 1, 2""",
)
def trips_per_borough(spark, sf):
    placed = joins.join_zones(steps.cleaned(spark, sf), views.zones(spark, sf))
    split = F.lit(views.TEST_START).cast("timestamp_ntz")
    set_name = F.when(F.col(PICKUP) < split, "train").otherwise("test")
    return stats.trips_per_borough(placed.withColumn("set_name", set_name), "set_name")


@query(
    "density_histogram",
    """select bin, round(lo + bin * (hi - lo) / 30, 6) as bin_start,
         round(lo + (bin + 1) * (hi - lo) / 30, 6) as bin_end, coalesce(rows, 0) as rows,
         round(coalesce(rows, 0) / (n * (hi - lo) / 30), 6) as density
       from (select cast(range as int) as bin from range(30))
       cross join (select min(value) as lo, max(value) as hi, count(*) as n from events)
       left join (
         select least(cast(floor((value - lo) / (hi - lo) * 30) as int), 29) as bin,
           count(*) as rows
         from events cross join (select min(value) as lo, max(value) as hi from events)
         group by 1) using (bin)""",
)
def density_histogram(spark, sf):
    table = stats.density_histogram(views.events(spark, sf), "value")
    return rounded(table, "bin_start", "bin_end", "density")


@query(
    "kde_curve",
    """select * from (with marks as (
         select min(trip_duration) as lo, max(trip_duration) as hi, count(*) as n,
           stddev_samp(trip_duration) * count(*) ** -0.2 as h from cleaned),
       placed as (
         select (trip_duration - lo) / (hi - lo) * 1023 as place from cleaned cross join marks),
       cells as (
         select cell, sum(w) as w from (
           select cast(floor(place) as int) as cell, 1 - (place - floor(place)) as w from placed
           union all select cast(floor(place) as int) + 1, place - floor(place) from placed)
         where w > 0 group by cell)
       select point, round(x, 6) as x,
         round(sum(w * exp(-0.5 * ((x - v) / h) * ((x - v) / h)) / sqrt(2 * pi()))
           / (any_value(n) * any_value(h)), 6) as density
       from (select lo + cell * (hi - lo) / 1023 as v, w from cells cross join marks)
       cross join (
         select cast(range as int) as point, lo + range * (hi - lo) / 199 as x, n, h
         from range(200) cross join marks)
       group by point, x)""",
)
def kde_curve(spark, sf):
    return rounded(stats.kde_curve(steps.cleaned(spark, sf), "trip_duration"), "x", "density")


# --- samples -----------------------------------------------------------------


@query(
    "sample_hash",
    """select event_id, speed from cleaned
       where cast('0x' || substr(md5(concat(event_id, ':42')), 1, 15) as bigint)
         < 57646075230342352""",
)
def sample_hash(spark, sf):
    drawn = sampling.sample_by_hash(steps.cleaned(spark, sf), "event_id")
    return drawn.select("event_id", "speed")


@query(
    "first_rows",
    """select event_id, tpep_pickup_datetime, trip_duration, speed from cleaned
       order by tpep_pickup_datetime, event_id limit 5""",
)
def first_rows(spark, sf):
    first = sampling.first_rows(steps.cleaned(spark, sf), [PICKUP, "event_id"])
    return first.select("event_id", PICKUP, "trip_duration", "speed")


@query(
    "random_days",
    """select event_id, cast(tpep_pickup_datetime as date) as date from cleaned
       where cast(tpep_pickup_datetime as date) in (
         select d from (select distinct cast(tpep_pickup_datetime as date) as d from cleaned)
         order by md5(concat(cast(d as varchar), ':42')) limit 10)""",
)
def random_days(spark, sf):
    drawn = sampling.trips_on_random_days(steps.cleaned(spark, sf), days=10)
    return drawn.select("event_id", F.to_date(PICKUP).alias("date"))


@query(
    "random_day_min_trips",
    f"""select day, trip_count from (
         select {DAY_SQL} as day, count(*) as trip_count from cleaned group by 1
         having count(*) >= 4)
       order by md5(concat(day, ':42')) limit 1""",
)
def random_day_min_trips(spark, sf):
    return sampling.random_day(steps.cleaned(spark, sf))
