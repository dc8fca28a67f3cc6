"""Mergeable quantile states, published tables and landing months."""

from __future__ import annotations

import math
import os
import random
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.operators.outliers import iqr_bounds
from curbside.operators.quantile_state import (
    count_state,
    merged_counts,
    merged_sketches,
    range_edges,
    refined_quantiles,
    sketch_state,
    sketched_quantiles,
    value_range,
)
from curbside.operators.quantiles import exact_quantiles
from curbside.sources import tables
from curbside.sources.landing import changed_months, landed_files, read_manifest, take_in_months
from curbside.sources.publication import current_version, publish_table, read_published
from curbside.workspace import stage_path, staged
from helpers_core import plan_text, rows
from test_sources import december

PROBABILITIES = [0.0, 0.02, 0.25, 0.5, 0.75, 1.0]


def numbers(spark, values, parts=4):
    listed = [(i % parts, v) for i, v in enumerate(values)]
    return spark.createDataFrame(listed, "month int, x double")


def drawn(seed, count, kind, *about):
    rng = random.Random(seed)
    return [getattr(rng, kind)(*about) for _ in range(count)]


SHAPES = {
    "spread": drawn(1, 900, "lognormvariate", 2, 1),
    "ties": [float(i % 7) for i in range(500)] + [3.0] * 400,
    "signs": drawn(2, 700, "gauss", 0, 5) + [0.0, -0.0] * 40,
    "wide": [(-1.0) ** i * 10.0 ** (i % 600 - 300) for i in range(600)],
    "infinite": [math.inf, -math.inf, math.inf, 1.0, -2.0, 0.0, 5e-324, 1.7976931348623157e308],
    "gaps": [1.0, None, math.nan, 2.0, 4.0],
    "one": [42.5],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_refined_quantiles_equal_those_of_all_values(spark, shape):
    table = staged(numbers(spark, SHAPES[shape]), "numbers")
    states = staged(count_state(table, "x", ["month"]), "states")
    found = rows(refined_quantiles(states, table, "x", PROBABILITIES), "probability", "n", "quantile")
    wanted = rows(exact_quantiles(table, "x", PROBABILITIES), "probability", "n", "quantile")
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    for a, b in zip(found, wanted):
        assert a[2] == pytest.approx(b[2], rel=1e-12, nan_ok=True), a


def test_groups_and_empty_tables(spark):
    table = numbers(spark, SHAPES["spread"] + SHAPES["signs"]).withColumn("kind", F.when(F.col("month") > 0, F.col("month") % 2))
    states = staged(count_state(table, "x", ["kind", "month"]), "states")
    found = rows(refined_quantiles(states, table, "x", [0.25, 0.75], ["kind"]), "kind", "probability", "n", "quantile")
    wanted = rows(exact_quantiles(table, "x", [0.25, 0.75], ["kind"]), "kind", "probability", "n", "quantile")
    assert found == [pytest.approx(w) if None not in w else w for w in wanted] or [f[:3] for f in found] == [w[:3] for w in wanted]
    assert [f[3] for f in found] == pytest.approx([w[3] for w in wanted], rel=1e-12)
    none = table.where("false")
    assert refined_quantiles(count_state(none, "x", ["month"]), none, "x", [0.5]).count() == 0


def test_states_merge_in_any_order(spark):
    table = numbers(spark, SHAPES["spread"] + SHAPES["signs"], 6)
    whole = rows(merged_counts(count_state(table, "x", ["month"])))
    months = [staged(count_state(table.where(F.col("month") == m), "x", []), "state") for m in range(6)]
    for order in ([0, 1, 2, 3, 4, 5], [5, 3, 1, 0, 4, 2]):
        state = months[order[0]]
        for m in order[1:]:
            state = merged_counts(state.unionByName(months[m]))
        assert rows(state) == whole
    # Another partitioning of the same rows has the same state.
    assert rows(merged_counts(count_state(table.repartition(7), "x", ["month"]))) == whole


def test_sketches_of_months_answer_without_the_values(spark):
    values = drawn(3, 20_000, "gammavariate", 2, 9)
    states = staged(sketch_state(numbers(spark, values, 6), "x", ["month"]), "sketches")
    for table in (states, states.where("month < 3"), states.orderBy(F.col("month").desc())):
        months = {r["month"] for r in table.select("month").collect()}
        own = np.sort([v for i, v in enumerate(values) if i % 6 in months])
        for row in sketched_quantiles(table, [0.02, 0.25, 0.75]).collect():
            assert row["n"] == len(own)
            assert abs(np.searchsorted(own, row["quantile"]) / len(own) - row["probability"]) < 0.01
    assert merged_sketches(states.where("false")).count() == 0


def test_ranges_are_ordered_and_enclose_their_values(spark):
    values = sorted(v for shape in SHAPES.values() for v in shape if v is not None and not math.isnan(v))
    table = spark.createDataFrame([(v,) for v in values], "x double").withColumn("place", value_range(F.col("x")))
    low, high = range_edges(F.col("place"))
    listed = sorted(tuple(r) for r in table.select("x", "place", low, high).collect())
    assert all(a[1] <= b[1] for a, b in zip(listed, listed[1:]))
    assert all(r[2] <= r[0] <= r[3] for r in listed)


def test_refinement_reads_the_ranges_only(spark):
    path = stage_path(spark, "speeds")
    numbers(spark, SHAPES["spread"]).write.parquet(path)
    table = spark.read.parquet(path)
    states = staged(count_state(table, "x", ["month"]), "states")
    plan = plan_text(refined_quantiles(states, table, "x", [0.25, 0.75]))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line and "GreaterThanOrEqual(x" in line)
    assert pushed.count("LessThanOrEqual(x") >= 2


def test_bounds_of_six_months_from_their_states(spark):
    speeds = numbers(spark, SHAPES["spread"], 6).withColumnRenamed("x", "speed")
    states = staged(count_state(speeds, "speed", ["month"]), "states")
    found = refined_quantiles(states, speeds, "speed", [0.25, 0.75]).orderBy("probability").collect()
    bounds = iqr_bounds(speeds, "speed").first()
    assert [r["quantile"] for r in found] == pytest.approx([bounds["q1"], bounds["q3"]], rel=1e-12)


# --- published tables ------------------------------------------------------------------


def test_a_failing_write_leaves_the_old_table_whole(spark):
    path = stage_path(spark, "published")
    publish_table(spark.range(1000).withColumn("part", F.col("id") % 3), path, "part")
    old = read_published(spark, path)
    version = current_version(spark, path)
    broken = spark.range(0, 1000, 1, 4).withColumn("part", F.when(F.col("id") < 990, 7).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        publish_table(broken, path, "part")
    assert current_version(spark, path) == version
    assert rows(read_published(spark, path), "id") == rows(old, "id") == [(i,) for i in range(1000)]
    publish_table(spark.range(5).withColumn("part", F.lit(1)), path, "part")
    assert rows(read_published(spark, path), "id") == [(i,) for i in range(5)]
    # A reader of the version before still has its files; those of the failed one are gone.
    assert old.count() == 1000
    assert len([d for d in os.listdir(path.removeprefix("file:")) if d.startswith("v-")]) == 2


def test_a_table_may_be_replaced_by_a_part_of_itself(spark):
    path = stage_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish_table(spark.range(10), path)
    for left in (9, 8, 7):
        publish_table(read_published(spark, path).where(F.col("id") < left), path)
        assert read_published(spark, path).count() == left


# --- landing months ----------------------------------------------------------------------


def landed(spark, landing, month, table):
    table.write.mode("overwrite").parquet(tables.month_path(landing, "train_set", 2022 if month == 12 else 2023, month))


def partition_files(raw):
    root = raw.removeprefix("file:")
    return {
        os.path.relpath(os.path.join(d, f), root)
        for d, _, files in os.walk(root)
        for f in files
        if f.endswith(".parquet") and "_landed" not in d
    }


def test_only_changed_months_are_taken_in(spark):
    landing, raw = stage_path(spark, "landing"), stage_path(spark, "raw")
    months = {2022: [12], 2023: [1]}
    landed(spark, landing, 12, december(spark))
    landed(spark, landing, 1, december(spark).limit(1))
    assert take_in_months(spark, landing, raw, "train_set", months) == [(2022, 12), (2023, 1)]
    files = partition_files(raw)
    assert take_in_months(spark, landing, raw, "train_set", months) == []
    assert partition_files(raw) == files

    landed(spark, landing, 1, december(spark).unionByName(december(spark)))
    assert take_in_months(spark, landing, raw, "train_set", months) == [(2023, 1)]
    kept = {f for f in files if "month=12" in f}
    assert kept and kept == {f for f in partition_files(raw) if "month=12" in f}
    counts = spark.read.parquet(raw).groupBy("year", "month").count()
    assert rows(counts) == [(2022, 12, 2), (2023, 1, 4)]
    assert {(r["year"], r["month"]) for r in read_manifest(spark, raw).collect()} == {(2022, 12), (2023, 1)}


def test_a_run_lost_before_its_manifest_is_done_again(spark, monkeypatch):
    import curbside.sources.landing as module

    landing, raw = stage_path(spark, "landing"), stage_path(spark, "raw")
    landed(spark, landing, 12, december(spark))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(module, "publish_table", lost)
        with pytest.raises(RuntimeError):
            take_in_months(spark, landing, raw, "train_set", {2022: [12]})
    assert take_in_months(spark, landing, raw, "train_set", {2022: [12]}) == [(2022, 12)]
    assert spark.read.parquet(raw).count() == 2


def test_months_not_asked_for_stay_and_missing_ones_are_refused(spark):
    landing, raw = stage_path(spark, "landing"), stage_path(spark, "raw")
    for month in (12, 1):
        landed(spark, landing, month, december(spark))
    take_in_months(spark, landing, raw, "train_set", {2022: [12], 2023: [1]})
    shutil.rmtree(tables.month_path(landing, "train_set", 2022, 12).removeprefix("file:"))
    assert take_in_months(spark, landing, raw, "train_set", {2023: [1]}) == []
    assert spark.read.parquet(raw).count() == 4
    with pytest.raises(FileNotFoundError, match="2022-12"):
        take_in_months(spark, landing, raw, "train_set", {2022: [12]})
    with pytest.raises(ValueError):
        take_in_months(spark, landing, raw, "other_set", {2022: [12]})
    listed = spark.createDataFrame(landed_files(spark, landing, "train_set", {2023: [1]}), read_manifest(spark, raw).schema)
    assert changed_months(listed, listed).count() == 0


# --- pruning ---------------------------------------------------------------------------


def test_boroughs_of_a_dimension_prune_directories(spark):
    path = stage_path(spark, "by-borough")
    names = F.element_at(F.array(*[F.lit(b) for b in ("Queens", "Bronx", "EWR", "Brooklyn")]), (F.col("id") % 4 + 1).cast("int"))
    tables.write_by_borough(spark.range(400).withColumn("Borough", names), path)
    zones = spark.createDataFrame([("Queens", "Yellow"), ("Queens", "Boro"), ("EWR", "EWR"), ("Bronx", "Boro")], "Borough string, service_zone string")
    zones = staged(zones, "zones")
    found = tables.read_boroughs_of(spark, path, zones.where("service_zone = 'Boro'"))
    assert rows(found, "Borough", "id") == sorted((b, i) for i in range(400) for b in ("Queens", "Bronx") if i % 4 == ("Queens", "Bronx").index(b))
    assert "dynamicpruning" in plan_text(found).lower()
    # What was read: the files of the two boroughs, counted by the scan itself.
    again = tables.read_boroughs_of(spark, path, zones.where("service_zone = 'Boro'"))
    again.collect()
    assert [files for text, files in scans_of(again) if "Borough" in text and "id#" in text] == [2]


def scans_of(df):
    """Text and number of files of the executed plan's scans."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.length())]
        if name.startswith("FileSourceScan"):
            found.append((node.simpleString(1000), node.metrics().apply("numFiles").value()))
    return found


def test_clustered_months_let_a_window_skip_row_groups(spark):
    import glob

    import pyarrow.parquet as pq

    landing, hour = stage_path(spark, "landing"), 3600
    start = "timestamp_ntz'2022-12-01 00:00:00'"
    # Times in no order, a fifth of them on one day.
    spread = F.when(F.col("id") % 5 == 0, 9 * 24 * hour + F.pmod(F.xxhash64("id"), F.lit(24 * hour))).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(31 * 24 * hour))
    )
    pickup = F.timestamp_add("SECOND", spread, F.expr(start))
    december_trips = spark.range(0, 20_000, 1, 4).select(pickup.alias("tpep_pickup_datetime"), F.lit(1.0).alias("trip_distance"))
    december_trips.write.parquet(tables.month_path(landing, "train_set", 2022, 12))
    counts, kept = {}, {}
    for clustered in (None, "tpep_pickup_datetime"):
        raw = stage_path(spark, "raw")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            tables.integrate_months(spark, landing, raw, "train_set", {2022: [12]}, clustered_by=clustered)
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        inside = F.col("tpep_pickup_datetime").between(F.expr("timestamp_ntz'2022-12-03 00:00:00'"), F.expr("timestamp_ntz'2022-12-04 00:00:00'"))
        kept[clustered] = spark.read.parquet(raw).where(inside).count()
        groups = []
        for file in glob.glob(f"{raw.removeprefix('file:')}/*/*/*/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            place = meta.schema.names.index("tpep_pickup_datetime")
            groups += [meta.row_group(i).column(place).statistics for i in range(meta.num_row_groups)]
        read = [g for g in groups if str(g.max) >= "2022-12-03" and str(g.min) <= "2022-12-04 00:00:00"]
        counts[clustered] = (len(read), len(groups))
    assert kept[None] == kept["tpep_pickup_datetime"] > 0
    assert counts[None][0] == counts[None][1]
    # The hot day fills ranges of its own, so the month is still written by several tasks.
    assert counts["tpep_pickup_datetime"][1] >= 4 and counts["tpep_pickup_datetime"][0] <= 2
