"""The physical plans: what is pushed down, broadcast, shuffled, and what never appears."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from helpers_core import plan_text
from curbside.catalog import aggregates, modelling, rows, steps, tables, views  # noqa: F401
from curbside.catalog.registry import QUERIES
from curbside.operators.quantiles import exact_quantiles
from curbside.operators import cleaning, joins, outliers, stats

# Queries that fit models run jobs of Spark ML while they are built.
FITTED = {
    "prepare_features",
    "predict",
    "linreg_univariate",
    "linreg_one_column",
    "linreg_two_columns",
    "rf_stump",
    "linreg_borough",
    "rf_borough",
    "borough_models",
    "borough_model_status",
    "hourly_pred_vs_actual",
}
LAZY = sorted(set(QUERIES) - FITTED)


@pytest.fixture(scope="module")
def plans(spark, sf):
    return {name: plan_text(QUERIES[name](spark, sf)) for name in LAZY}


def test_no_python_in_any_plan(plans):
    for name, text in plans.items():
        assert not re.search(r"Python|Pandas|Arrow", text), name


def test_cross_joins_only_meet_a_fixed_number_of_rows(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        # A nested loop is only ever over the broadcast result of an ungrouped aggregate.
        if "BroadcastNestedLoopJoin" in text:
            assert re.search(r"Keys: \[\]|Keys \[0\]|quantile-targets|quantile", text), name


def test_time_window_reaches_the_scan(spark, sf):
    text = plan_text(cleaning.filter_window(views.trips(spark, sf), views.SHORT_WINDOW))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in pushed
    assert "LessThanOrEqual(ts,2024-01-25T23:59:59)" in pushed


def test_only_used_columns_are_read(spark, sf):
    for name, text in {
        "borough_summary": plan_text(QUERIES["borough_summary"](spark, sf)),
        "trips_per_day": plan_text(QUERIES["trips_per_day"](spark, sf)),
    }.items():
        for schema in re.findall(r"ReadSchema: struct<(.*)>", text):
            assert "props" not in schema, name


def test_facts_are_not_shuffled_before_the_aggregate(spark, sf):
    # Shuffles, all of partial aggregates: the quartiles' sketch, the values left around the
    # ranks (counted, then by rank) and the row of bounds, hours of weather, boroughs.
    text = plan_text(QUERIES["borough_summary"](spark, sf))
    assert "SortMergeJoin" not in text
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 6
    merged = plan_text(steps.merged(spark, sf))
    assert len(re.findall(r"^\(\d+\) Exchange", merged, re.M)) == 5


def test_reports_take_one_scan(spark, sf):
    for name in ("quality_report", "describe_numeric", "null_counts", "time_range"):
        text = plan_text(QUERIES[name](spark, sf))
        assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1, name


def test_top_rows_are_taken_without_a_full_sort(spark, sf):
    for name in ("top_outliers", "first_rows", "random_day_min_trips"):
        text = plan_text(QUERIES[name](spark, sf))
        assert "TakeOrderedAndProject" in text, name


def test_outlier_filter_is_one_lazy_plan_of_three_scans(spark, sf):
    # Two for the bounds and one for the trips.
    text = plan_text(outliers.filter_speed_outliers(steps.cleaned(spark, sf)))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 3


def test_borough_list_prunes_directories(spark, tmp_path):
    from curbside.sources import tables

    path = str(tmp_path / "b")
    table = spark.range(20).select("id", F.when(F.col("id") % 2 == 0, "Queens").otherwise("EWR").alias("Borough"))
    tables.write_by_borough(table, path)
    text = plan_text(tables.read_boroughs(spark, path, ["EWR"]))
    assert re.search(r"PartitionFilters: \[.*Borough", text)


def test_lookup_above_the_limit_is_not_broadcast(spark):
    facts = spark.range(1000).withColumn("k", (F.col("id") % 3).cast("int"))
    lookup = spark.range(5).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    text = plan_text(joins.lookup_join(facts, lookup, ["k"], limit=0))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "BroadcastHashJoin" in plan_text(joins.lookup_join(facts, lookup, ["k"]))


def test_sizes_are_measured_in_memory_not_in_files(spark, tmp_path):
    small = spark.range(10).select(F.lit("abcd").alias("t"))
    assert joins.measured_bytes(small) == 10 * (16 + 4)
    assert joins.measured_bytes(small.where("false")) == 0
    # Equal texts take no room in a file, and arrays are more than one cell.
    path = str(tmp_path / "equal")
    spark.range(20_000).select("id", F.lit("x" * 200).alias("t")).write.parquet(path)
    equal = spark.read.parquet(path)
    assert joins.measured_bytes(equal) == 20_000 * (32 + 200)
    assert not joins.fits_broadcast(equal, 1 << 20)
    lists = spark.range(10).select("id", F.sequence(F.lit(1), F.lit(1000)).alias("a"))
    assert joins.measured_bytes(lists) == 10 * (32 + 1000 * 16)
    nested = spark.range(2).select(F.struct(F.array(F.lit("ab")).alias("a"), F.create_map(F.lit(1), F.lit(b"xyz")).alias("m")).alias("s"))
    assert joins.measured_bytes(nested) >= 2 * (2 + 3)
    assert joins.measured_bytes(spark.range(3).select(F.lit(None).cast("array<int>").alias("a"))) == 3 * 16


def test_a_hot_key_of_equal_rows_is_split_over_tasks(spark):
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        facts = spark.range(0, 300_000, 1, 20).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(1 + F.col("id") % 50).alias("k"), F.lit("equal").alias("note")
        )
        lookup = spark.range(60).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        joined = joins.lookup_join(facts, lookup, ["k"], limit=0)
        hot = F.count_if(F.col("k") == 0).alias("hot")
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).agg(hot).where("hot > 0").collect()
        assert len(tasks) >= 8 and sum(r["hot"] for r in tasks) == 100_000
        assert joined.count() == 300_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_quantiles_take_two_scans_and_no_task_gets_all_values(spark, sf):
    text = plan_text(exact_quantiles(steps.speeds(spark, sf), "speed", [0.25, 0.75]))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 2
    # The single partition is the sketch's: one row per task.
    for block in re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: SinglePartition", text):
        assert "_value" not in block and "_x" not in block


def test_hot_bin_is_combined_before_the_shuffle(spark):
    trips = spark.range(1000).select(F.lit(1.0).alias("temp"), F.lit(10.0).alias("speed"))
    text = plan_text(stats.avg_speed_by_bin(trips, "temp", 5))
    assert text.count("partial_avg") >= 1
