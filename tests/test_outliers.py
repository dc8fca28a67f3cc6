"""Quantiles, interquartile bounds, histograms, densities and samples."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_core import rows
from curbside.operators import outliers, quality, sampling, stats
from curbside.operators.quantiles import approx_quantiles, exact_quantiles


def numbers(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")


def narrowed(df, probabilities, by=None):
    """With a sketch so coarse that many values are left around every rank."""
    return exact_quantiles(df, "v", probabilities, by, accuracy=20)


RNG = np.random.default_rng(7)
SHAPES = {
    "uniform": RNG.uniform(0, 65, 2000),
    "heavy tail": np.concatenate([RNG.exponential(1, 2000), [1e12, -1e9]]),
    "one hot value": np.concatenate([np.full(900, 5.0), RNG.normal(5, 1e-9, 900), RNG.normal(0, 1, 900)]),
    "far apart halves": np.concatenate([RNG.normal(10, 1e-7, 1000), RNG.normal(1e6, 1, 1000)]),
    "single": np.array([3.0]),
    "all equal": np.full(50, 2.5),
    "two": np.array([1.0, 4.0]),
    "hundreds of decades": 10.0 ** RNG.uniform(-300, 300, 2000) * RNG.choice([-1, 1], 2000),
    "infinite ends": np.concatenate([RNG.normal(0, 1, 200), [np.inf] * 30, [-np.inf] * 30]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_narrowed_quantiles_are_exact(spark, shape):
    values = SHAPES[shape]
    wanted = [0.0, 0.02, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = {r["probability"]: r["quantile"] for r in narrowed(numbers(spark, values), wanted).collect()}
    ordered = np.sort(values)
    for p in wanted:
        place = p * (len(values) - 1)
        low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
        exact = low if low == high else low + (place - math.floor(place)) * (high - low)
        assert found[p] == pytest.approx(exact, rel=1e-9, abs=1e-12, nan_ok=True), p


def test_empty_input_gives_one_row_per_probability_of_no_rows(spark):
    for find in (exact_quantiles, approx_quantiles):
        found = find(numbers(spark, [None, float("nan")]), "v", [0.25, 0.75]).collect()
        assert sorted((r["probability"], r["n"], r["quantile"]) for r in found) == [(0.25, 0, None), (0.75, 0, None)]
    grouped = numbers(spark, []).withColumn("g", F.lit(1))
    assert exact_quantiles(grouped, "v", [0.5], ["g"]).count() == 0


def test_a_rank_outside_its_bracket_fails(spark, monkeypatch):
    from curbside.operators import quantiles

    def wrong(values, probabilities, by, accuracy):
        bracket = F.struct(F.lit(0).alias("at"), F.lit(5.0).alias("low"), F.lit(6.0).alias("high"))
        return values.agg(F.count("_x").alias("n")).select("n", F.array(bracket).alias("_brackets"))

    monkeypatch.setattr(quantiles, "_brackets", wrong)
    with pytest.raises(Exception, match="outside its bracket"):
        exact_quantiles(numbers(spark, [1, 2, 3]), "v", [0.5]).collect()


def test_narrowed_quantiles_by_group_with_a_null_key_and_a_hot_key(spark):
    table = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 != 1, F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        (F.col("id") * 7919 % 1009 / 3).alias("v"),
    )
    wanted = [0.25, 0.75]
    small = exact_quantiles(table, "v", wanted, ["g"])
    assert "NULL" in {str(r["g"] or "NULL") for r in small.collect()}
    rounded = [df.withColumn("quantile", F.round("quantile", 9)) for df in (small, narrowed(table, wanted, ["g"]))]
    assert rows(rounded[0]) == rows(rounded[1], *rounded[0].columns)


def test_nulls_and_nans_are_not_counted(spark):
    table = numbers(spark, [1, 2, 3, None, float("nan")])
    for found in (exact_quantiles(table, "v", [0.5]), narrowed(table, [0.5])):
        assert [(r["n"], r["quantile"]) for r in found.collect()] == [(3, 2.0)]


def test_approximate_quantiles_keep_their_rank_error(spark):
    values = np.sort(SHAPES["heavy tail"])
    for row in approx_quantiles(numbers(spark, values), "v", [0.02, 0.25, 0.75]).collect():
        rank = np.searchsorted(values, row["quantile"])
        assert abs(rank - row["probability"] * len(values)) <= 0.01 * len(values) + 1


def test_bounds_of_a_hundred_rows(spark):
    # Hundred values whose quartiles are exactly 10 and 20.
    table = numbers(spark, [10.0] * 30 + [15.0] * 40 + [20.0] * 30)
    bounds = outliers.iqr_bounds(table, "v").first()
    assert (bounds["n"], bounds["q1"], bounds["q3"]) == (100, 10.0, 20.0)
    assert bounds["lower_bound"] == pytest.approx(-6.459660, abs=1e-6)
    assert bounds["upper_bound"] == pytest.approx(36.459660, abs=1e-6)


def test_bounds_of_one_row_and_none(spark):
    one = outliers.iqr_bounds(numbers(spark, [4.0]), "v").first()
    assert (one["lower_bound"], one["upper_bound"]) == (4.0, 4.0)
    none = outliers.iqr_bounds(numbers(spark, []), "v").collect()
    assert len(none) == 1 and none[0]["upper_bound"] is None
    assert outliers.flag_outliers(numbers(spark, []), "v").count() == 0


def test_method_is_checked(spark):
    with pytest.raises(ValueError, match="method"):
        outliers.iqr_bounds(numbers(spark, [1.0]), "v", method="guess")


def test_outliers_are_strictly_outside_and_sorted(spark):
    bounds = spark.createDataFrame([(0.0, 10.0)], "lower_bound double, upper_bound double")
    table = numbers(spark, [-1, 0, 5, 10, 11, 12])
    flagged = outliers.flag_outliers(table, "v", bounds)
    assert [r["v"] for r in flagged.where("is_outlier").collect()] == [-1.0, 11.0, 12.0]
    top = outliers.top_outliers(table, "v", bounds=bounds, rows=2)
    assert [r["v"] for r in top.collect()] == [12.0, 11.0]


def test_speed_filter_includes_both_ends(spark):
    table = spark.createDataFrame([(2.9,), (3.0,), (40.0,), (40.1,)], "speed double")
    bounds = spark.createDataFrame([(-5.0, 40.0)], "lower_bound double, upper_bound double")
    assert rows(outliers.filter_speed_outliers(table, bounds)) == [(3.0,), (40.0,)]


def test_low_speeds(spark):
    table = spark.createDataFrame([(float(i),) for i in range(101)], "speed double")
    assert rows(outliers.low_speed_trips(table), "speed") == [(0.0,), (1.0,)]


def test_histogram_area_is_one_and_empty_bins_are_listed(spark):
    for values in ([0, 0, 1, 100], RNG.normal(0, 1, 500), [7, 7, 7]):
        bins = stats.density_histogram(numbers(spark, values), "v").collect()
        area = sum(r["density"] * (r["bin_end"] - r["bin_start"]) for r in bins)
        assert area == pytest.approx(1)
        assert sum(r["rows"] for r in bins) == len(values)
        assert len(bins) == (1 if len(set(values)) == 1 else 30)


def test_histogram_equals_numpy(spark):
    values = RNG.normal(0, 1, 500)
    bins = sorted(stats.density_histogram(numbers(spark, values), "v", 10).collect())
    expected, edges = np.histogram(values, bins=10, density=True)
    assert [r["density"] for r in bins] == pytest.approx(list(expected))
    assert [r["bin_start"] for r in bins] == pytest.approx(list(edges[:-1]))


def test_density_curve_is_near_brute_force(spark):
    values = np.round(RNG.normal(20, 4, 300), 1)
    width = values.std(ddof=1) * len(values) ** -0.2
    curve = sorted(stats.kde_curve(numbers(spark, values), "v", grid=25).collect())
    points = np.linspace(values.min(), values.max(), 25)
    kernel = np.exp(-(((points[:, None] - values) / width) ** 2) / 2) / math.sqrt(2 * math.pi)
    assert [r["x"] for r in curve] == pytest.approx(list(points))
    assert [r["density"] for r in curve] == pytest.approx(list(kernel.mean(axis=1) / width), rel=1e-4, abs=1e-6)


def test_density_curve_of_equal_values(spark):
    curve = stats.kde_curve(numbers(spark, [7, 7, 7]), "v", grid=3, bandwidth=1.0).collect()
    assert [r["density"] for r in curve] == pytest.approx([1 / math.sqrt(2 * math.pi)] * 3)


def test_profile_counts_nulls_but_not_nans(spark):
    table = numbers(spark, [1, 3, None, float("nan")])
    assert rows(quality.null_counts(table)) == [("v", 1)]
    described = quality.describe_numeric(numbers(spark, [1, 3, None])).first()
    assert (described["count"], described["mean"], described["min"], described["max"]) == (2, 2.0, 1.0, 3.0)
    assert described["stddev"] == pytest.approx(math.sqrt(2))


def test_profile_agrees_with_describe(spark):
    table = spark.range(100).select((F.col("id") * 1.5).alias("a"), (F.col("id") % 7).alias("b"))
    expected = {r["summary"]: r for r in table.describe().collect()}
    for row in quality.describe_numeric(table).collect():
        for part in ("count", "mean", "stddev", "min", "max"):
            assert float(expected[part][row["column_name"]]) == pytest.approx(row[part])


def test_sample_does_not_depend_on_partitioning(spark):
    table = spark.range(20000)
    once = rows(sampling.sample_by_hash(table.repartition(3), "id"))
    again = rows(sampling.sample_by_hash(table.repartition(11), "id"))
    assert once == again
    assert 0.04 < len(once) / 20000 < 0.06
    assert sampling.sample_by_hash(table, "id", 1.0).count() == 20000
    assert sampling.sample_by_hash(table, "id", 0.0).count() == 0
    assert sampling.sample_by_hash(table, "id", 1e-9).count() <= 1
    assert sampling.sample_by_hash(table, "id", 1 - 1e-9).count() >= 19999
    for fraction in (-0.1, 1.1):
        with pytest.raises(ValueError, match="fraction"):
            sampling.sample_by_hash(table, "id", fraction)
    assert rows(sampling.sample_by_hash(table, seed=43)) != once


def day_trips(spark, counts):
    listed = [(f"2024-01-{day:02d} 10:00:00",) for day, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(listed, "t string").select(
        F.col("t").cast("timestamp_ntz").alias("tpep_pickup_datetime")
    )


def test_random_day_has_enough_trips(spark):
    assert rows(sampling.random_day(day_trips(spark, {1: 3, 2: 4}))) == [("2024-01-02", 4)]
    assert sampling.random_day(day_trips(spark, {1: 3, 2: 2})).count() == 0


def test_random_days_keep_whole_days_and_repeat(spark):
    trips = day_trips(spark, {d: d for d in range(1, 21)})
    drawn = [
        rows(stats.trips_per_day(sampling.trips_on_random_days(trips.repartition(n), days=6)))
        for n in (1, 5)
    ]
    assert drawn[0] == drawn[1]
    assert len(drawn[0]) == 6
    assert all(int(day[-2:]) == n for day, n in drawn[0])
    assert len(rows(sampling.random_dates(trips, days=30))) == 20


def test_speed_by_bin_is_ordered(spark):
    table = spark.createDataFrame(
        [(7.0, 10.0), (-3.0, 20.0), (3.0, 30.0), (-8.0, 5.0)], "temp double, speed double"
    )
    found = [tuple(r) for r in stats.avg_speed_by_bin(table, "temp", 5).collect()]
    assert found == [(-5, 5.0, 1), (0, 25.0, 2), (5, 10.0, 1)]
    floored = [r["bin"] for r in stats.avg_speed_by_bin(table, "temp", 5, truncate=False).collect()]
    assert floored == [-10, -5, 0, 5]
