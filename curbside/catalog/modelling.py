"""Queries on features, models and whole flows."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from curbside.catalog import steps, views
from curbside.catalog.aggregates import rounded
from curbside.catalog.registry import query
from curbside.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from curbside.functions.trip import predicted_speed_mph
from curbside.models import duration, features, grouped
from curbside.models.fitted import fit_models
from curbside.plans import flows
from curbside.workspace import staged

# Test rows with the rank of each category among the train rows (most frequent first,
# ties by text) and the number of categories. A value unseen in training has no rank.
RANKS_SQL = "from test\n" + "\n".join(
    f"""left join (
      select {c}, row_number() over (order by count(*) desc, cast({c} as varchar)) - 1 as {c}_rank
      from train group by {c}) using ({c})
    cross join (select count(distinct {c}) as {c}_size from train)"""
    for c in CATEGORICAL_FEATURES
)


@query(
    "string_index",
    f"""select event_id, {', '.join(f'cast(coalesce({c}_rank, {c}_size) as double) as {c}_index' for c in CATEGORICAL_FEATURES)}
       {RANKS_SQL}""",
)
def string_index(spark, sf):
    train, test = steps.stored_split(spark, sf)
    indexed = features.string_indexer().fit(train).transform(test)
    return indexed.select("event_id", *[features.indexed(c) for c in CATEGORICAL_FEATURES])


def _ones(column: str):
    """Position of the 1 in a one-hot vector, -1 if there is none, and the vector's size."""
    array = vector_to_array(F.col(features.encoded(column)))
    return [
        (F.array_position(array, 1.0) - 1).cast("bigint").alias(f"{column}_slot"),
        F.size(array).cast("bigint").alias(f"{column}_size"),
    ]


@query(
    "one_hot",
    f"""select event_id, {', '.join(f'coalesce({c}_rank, -1) as {c}_slot, {c}_size' for c in CATEGORICAL_FEATURES)}
       {RANKS_SQL}""",
)
def one_hot(spark, sf):
    train, test = steps.stored_split(spark, sf)
    indexer = features.string_indexer().fit(train)
    encoder = features.one_hot_encoder().fit(indexer.transform(train))
    encoded = encoder.transform(indexer.transform(test))
    return encoded.select("event_id", *[c for name in CATEGORICAL_FEATURES for c in _ones(name)])


def _vector_cells(column: str):
    """Size, non-zero count and the five numeric cells at the vector's end."""
    array = vector_to_array(F.col(column))
    size = F.size(array)
    numbers = ["trip_distance", "is_weekend", "holiday_scale", "temp", "windgust"]
    return [
        size.cast("bigint").alias("size"),
        *[
            F.round(F.element_at(array, i - len(numbers)), 6).alias(f"{name}_cell")
            for i, name in enumerate(numbers)
        ],
    ]


SIZE_SQL = " + ".join(f"{c}_size" for c in CATEGORICAL_FEATURES)


@query(
    "assemble",
    f"""select event_id, {SIZE_SQL} + 5 as size, round(trip_distance, 6) as trip_distance_cell,
         cast(is_weekend as double) as is_weekend_cell,
         cast(holiday_scale as double) as holiday_scale_cell, round(temp, 6) as temp_cell,
         round(windgust, 6) as windgust_cell
       {RANKS_SQL}""",
)
def assemble(spark, sf):
    train, test = steps.stored_split(spark, sf)
    _, prepared, _ = features.prepare_features(train, test)
    return prepared.select("event_id", *_vector_cells(features.ASSEMBLED))


@query(
    "standard_scale",
    f"""select event_id, {SIZE_SQL} + 5 as size,
         round(trip_distance / sd_distance, 6) as trip_distance_cell,
         round(case when sd_weekend > 0 then cast(is_weekend as double) / sd_weekend else 0 end, 6)
           as is_weekend_cell,
         round(case when sd_scale > 0 then holiday_scale / sd_scale else 0 end, 6)
           as holiday_scale_cell,
         round(temp / sd_temp, 6) as temp_cell, round(windgust / sd_windgust, 6) as windgust_cell
       {RANKS_SQL}
       cross join (
         select stddev_samp(trip_distance) as sd_distance,
           stddev_samp(cast(is_weekend as double)) as sd_weekend,
           stddev_samp(holiday_scale) as sd_scale, stddev_samp(temp) as sd_temp,
           stddev_samp(windgust) as sd_windgust from train)""",
)
def standard_scale(spark, sf):
    train, test = steps.stored_split(spark, sf)
    _, prepared, _ = features.prepare_features(train, test)
    return prepared.select("event_id", *_vector_cells(features.SCALED))


def features_sql(by: str) -> str:
    """Rows (grp, column, value, trips, slot, scale) of train, grouped by an expression."""
    levels = " union all ".join(
        f"""select {by} as grp, {i} as part, '{c}' as col, cast({c} as varchar) as value, count(*) as trips
          from train group by all"""
        for i, c in enumerate(CATEGORICAL_FEATURES)
    )
    numbers = " union all ".join(
        f"""select {by} as grp, {i} as place, '{c}' as col, stddev_samp(cast({c} as double)) as deviation, count(*) as trips
          from train group by all"""
        for i, c in enumerate(NUMERIC_FEATURES)
    )
    return f"""levels as ({levels}),
      totals as (select {by} as grp, count(*) as n from train group by all),
      ranked as (
        select grp, col, value, trips, cast(row_number() over (partition by grp order by part, trips desc, value) - 1 as int) as slot,
          sqrt(trips / n * (1 - trips / n) * n / greatest(n - 1, 1)) as deviation
        from levels join totals using (grp)),
      numbered as (
        select grp, col, null as value, trips, cast(size + place as int) as slot, deviation
        from ({numbers}) join (select grp, count(*) as size from ranked group by grp) using (grp)),
      dictionary as (
        select * exclude (deviation), case when deviation > 0 then 1 / deviation else 0 end as scale
        from (select * from ranked union all select * from numbered))"""


def _cells_sql(by: str, table: str, set_name: str) -> str:
    """Rows (set_name, grp, event_id, col, value, x): the inputs of each trip, one by one."""
    categories = " union all ".join(
        f"select '{set_name}' as set_name, {by} as grp, event_id, '{c}' as col, cast({c} as varchar) as value, 1.0::double as x from {table}"
        for c in CATEGORICAL_FEATURES
    )
    numbers = " union all ".join(
        f"select '{set_name}', {by}, event_id, '{c}', null, cast({c} as double) from {table}" for c in NUMERIC_FEATURES
    )
    return f"{categories} union all {numbers}"


@query(
    "prepare_features",
    f"""select * from (with {features_sql('Borough')},
        cells as ({_cells_sql('Borough', 'train', 'train')} union all {_cells_sql('Borough', 'test', 'test')})
      select set_name, grp as Borough, event_id, slot, round(x * scale, 6) as cell
      from cells join dictionary using (grp, col)
      where cells.value is not distinct from dictionary.value and x * scale <> 0)""",
)
def prepare_features(spark, sf):
    """Scaled features of every borough's trips as their cells other than zero, from one dictionary."""
    train, test = steps.stored_split(spark, sf)
    table = staged(grouped.dictionary(staged(grouped.moments(train), "moments")), "dictionary")
    both = [
        side.select(F.lit(name).alias("set_name"), "Borough", "event_id", *CATEGORICAL_FEATURES, *NUMERIC_FEATURES)
        for name, side in (("train", train), ("test", test))
    ]
    cells = grouped.encode(both[0].unionByName(both[1]), table)
    cells = cells.select("set_name", "Borough", "event_id", F.inline("features"))
    return cells.select("set_name", "Borough", "event_id", "slot", F.round("value", 6).alias("cell"))


def lines_sql(by: str) -> str:
    """The table ``scored`` (grp, event_id, prediction) of test, by least squares solved here.

    Gauss-Jordan elimination over the products of all columns; a column that depends
    on earlier ones has no pivot left and gets no effect. Then every category's
    effects are moved, together with the intercept, so that they balance by their
    levels' variances: the solution of least length.
    """
    constant = f"select 'train' as set_name, {by} as grp, event_id, '' as col, null as value, 1.0::double as x from train"
    label = f"select 'train', {by}, event_id, 'label', null, trip_duration from train"
    numbers = ", ".join(f"'{c}'" for c in NUMERIC_FEATURES)
    return f"""inputs as ({_cells_sql(by, 'train', 'train')} union all {constant} union all {label}),
      totals as (select {by} as grp, count(*) as n from train group by all),
      names as (
        select grp, col, value, count(*) as trips, row_number() over (partition by grp
            order by case when col = '' then 0 when col in ({numbers}) then 1 when col = 'label' then 3 else 2 end, col, value) as i
        from inputs group by grp, col, value),
      wide as (select i.grp, event_id, n.i, x from inputs i join names n
        on n.grp = i.grp and n.col = i.col and n.value is not distinct from i.value),
      products as (
        select a.grp, a.i, b.i as j, sum(a.x * b.x) as p
        from wide a join wide b on a.grp = b.grp and a.event_id = b.event_id group by all),
      matrix as (
        select grp, i, list(coalesce(p, 0) order by j) as r
        from (select a.grp, a.i, b.i as j from names a join names b using (grp)) left join products using (grp, i, j)
        group by grp, i),
      solved as (
        with recursive steps as (
          select grp, 0 as k, count(*) - 1 as d, list(r order by i) as m from matrix group by grp
          union all
          select grp, k + 1, d, case when abs(m[k + 1][k + 1]) < 1e-6 then m else list_transform(m, lambda r, i:
              case when i = k + 1 then list_transform(r, lambda x: x / lead)
              else list_transform(list_zip(r, own), lambda z: z[1] - r[k + 1] / lead * z[2]) end) end
          from (select *, m[k + 1] as own, m[k + 1][k + 1] as lead from steps) where k < d)
        select grp, i, case when abs(m[i][i]) < 1e-6 then 0 else m[i][d + 1] end as effect
        from steps, unnest(range(1, d + 1)) as t(i) where k = d),
      effects as (
        select grp, col, value, effect, trips / n * (1 - trips / n) as spread
        from solved join names using (grp, i) join totals using (grp)),
      moved as (
        select grp, col, coalesce(sum(spread * effect) / nullif(sum(spread), 0), 0) as shift
        from effects where value is not null group by grp, col),
      balanced as (
        select grp, col, value, effect - coalesce(shift, 0) as effect from effects left join moved using (grp, col) where col <> ''
        union all
        select grp, '', null, effect + (select sum(shift) from moved m where m.grp = e.grp) from effects e where col = ''),
      asked as ({_cells_sql(by, 'test', 'test')} union all {constant.replace("'train'", "'test'").replace('from train', 'from test')}),
      scored as (
        select a.grp, event_id, sum(x * coalesce(effect, 0)) as prediction
        from asked a semi join totals t on t.grp = a.grp left join balanced b
          on b.grp = a.grp and b.col = a.col and b.value is not distinct from a.value
        group by all)"""


@query(
    "predict",
    f"""select * from (with {lines_sql("'all'")}
      select event_id, trip_duration, round(prediction, 4) as prediction,
        round(case when prediction <> 0 then trip_distance / (prediction / 60) end, 4) as predicted_speed
      from test join scored using (event_id))""",
)
def predict(spark, sf):
    """A linear model of all trips, as a table, applied to the test trips."""
    train, test = steps.stored_split(spark, sf)
    model = fit_models(train, {"linear": duration.linear_regression()}, [])
    scored = model.score(test).withColumn("predicted_speed", predicted_speed_mph())
    return rounded(scored.select("event_id", "trip_duration", "prediction", "predicted_speed"), "prediction", "predicted_speed", digits=4)


@query(
    "linreg_borough",
    f"""select * from (with {lines_sql("Borough")}
      select Borough, 'linear' as model, day, hour, trip_distance, trip_duration, speed, round(prediction, 4) as prediction,
        round(case when prediction <> 0 then trip_distance / (prediction / 60) end, 4) as predicted_speed
      from test join scored using (event_id))""",
)
def linreg_borough(spark, sf):
    train, test = steps.stored_split(spark, sf)
    models = {"linear": duration.linear_regression()}
    scored = duration.borough_predictions(train, test, views.boroughs(spark, sf), models)
    return rounded(scored, "prediction", "predicted_speed", digits=4)


@query("rf_borough")
def rf_borough(spark, sf):
    train, test = steps.stored_split(spark, sf)
    models = {"forest": duration.random_forest()}
    return duration.borough_predictions(train, test, views.boroughs(spark, sf), models)


@query("borough_models")
def borough_models(spark, sf):
    train, test = steps.stored_split(spark, sf)
    return duration.borough_scores(train, test, views.boroughs(spark, sf))


@query(
    "borough_model_status",
    """select r_name as Borough, model, coalesce(train_rows, 0) as train_rows,
         coalesce(test_rows, 0) as test_rows,
         case when coalesce(train_rows, 0) = 0 then 'no training rows'
           when coalesce(test_rows, 0) = 0 then 'no test rows' else 'scored' end as status,
         coalesce(train_rows, 0) > 0 and coalesce(test_rows, 0) > 0 as has_mae
       from region cross join (values ('linear'), ('forest')) as m(model)
       left join (select Borough, count(*) as train_rows from train group by 1) a on r_name = a.Borough
       left join (select Borough, count(*) as test_rows from test group by 1) b on r_name = b.Borough""",
)
def borough_model_status(spark, sf):
    """What the scores of all boroughs say beside the error, with a forest of few trees."""
    train, test = steps.stored_split(spark, sf)
    models = {"linear": duration.linear_regression(), "forest": duration.random_forest().setNumTrees(2)}
    scores = duration.borough_scores(train, test, views.boroughs(spark, sf), models)
    return scores.withColumn("has_mae", F.col("mae").isNotNull()).drop("mae")


# --- flows -------------------------------------------------------------------


@query(
    "curated_trips",
    """select event_id, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, pulocationid,
         dolocationid, trip_duration, speed, round(log_trip_duration, 6) as log_trip_duration,
         is_weekend, is_holiday, holiday_scale from curated""",
)
def curated_trips(spark, sf):
    return rounded(steps.curated(spark, sf), "log_trip_duration")


@query(
    "merged_trips",
    """select event_id, day, hour, Borough, trip_duration, is_weekend, holiday_scale, temp,
         snowdepth, windgust, visibility, rain from merged""",
)
def merged_trips(spark, sf):
    return steps.merged(spark, sf).select(
        "event_id", "day", "hour", "Borough", "trip_duration", "is_weekend", "holiday_scale",
        "temp", "snowdepth", "windgust", "visibility", "rain",
    )


@query(
    "borough_summary",
    """select Borough, count(*) as trips, round(avg(trip_duration), 6) as avg_duration,
         round(avg(speed), 6) as avg_speed, round(avg(trip_distance), 6) as avg_distance,
         count(*) filter (where is_weekend) as weekend_trips,
         count(*) filter (where is_holiday) as holiday_trips,
         cast(sum(rain) as bigint) as rain_trips from merged group by Borough""",
)
def borough_summary(spark, sf):
    summary = flows.borough_summary(steps.merged(spark, sf))
    return rounded(summary, "avg_duration", "avg_speed", "avg_distance")
