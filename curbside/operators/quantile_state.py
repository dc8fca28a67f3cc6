"""Quantiles from stored states that merge: months are read once, sets of months later.

A state of some rows is two small tables that can be kept beside them:

- exact counts of their values by range. A range is a fixed share of an octave, the
  same for every table, so counts of any parts of the data add up, in any order;
- a built-in sketch, for quantiles that may be off by its error.

Approximate quantiles of any months come from their sketches alone. Exact ones come
from the merged counts, whose prefix sums tell the range of every rank and how many
values lie before it; then only the rows of those ranges are read, by a condition
that reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.operators.joins import lookup_join

# Ranges of an octave: values of one differ by about 2 %. Doubles span 2,098 octaves, in
# practice a table holds a few hundred ranges.
RANGES = 32
# Number of the range of 1, above all others' distance from it; infinity's number.
ONE, INFINITE = 40_000, 1_000_000
# Size of a sketch: its error is some 0.3 % of the rows.
SKETCH_SIZE = 1_000


def value_range(x: Column) -> Column:
    """Number of a value's range, in the order of the values; 0 for zero. The value is no NaN."""
    size = F.abs(x)
    infinite = size == F.lit(float("inf"))
    place = F.floor(F.log2(F.when(infinite | (size == 0), 1.0).otherwise(size)) * RANGES) + ONE
    place = F.when(size == 0, 0).when(infinite, INFINITE).otherwise(place).cast("int")
    return F.when(x < 0, -place).otherwise(place)


def _edge(place: Column, up: bool) -> Column:
    """A value no lower than all of a range of positive numbers (``up``), or no higher."""
    exponent = (place - ONE + (1 if up else 0)) / F.lit(float(RANGES))
    bounded = F.greatest(F.least(exponent, F.lit(1023.9)), F.lit(-1074.0))
    edge = F.pow(F.lit(2.0), bounded) * (1 + 1e-9 if up else 1 - 1e-9)  # the rounding of two functions
    largest = exponent > 1023.9
    return F.when(place == INFINITE, F.lit(float("inf"))).when(largest & F.lit(up), F.lit(1.7976931348623157e308)).otherwise(edge)


def range_edges(place: Column) -> tuple[Column, Column]:
    """Values that enclose a range, possibly with a little of its neighbours."""
    low = F.when(place == 0, F.lit(0.0)).when(place > 0, _edge(place, False)).otherwise(-_edge(-place, True))
    high = F.when(place == 0, F.lit(0.0)).when(place > 0, _edge(place, True)).otherwise(-_edge(-place, False))
    return low, high


def _values(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(*keys, value.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))


def count_state(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Rows (keys…, place, n): values by range, for every month or other key."""
    return _values(df, column, keys).groupBy(*keys, value_range(F.col("_x")).alias("place")).agg(F.count(F.lit(1)).alias("n"))


def sketch_state(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Rows (keys…, n, sketch) for every month or other key."""
    sketch = F.kll_sketch_agg_double("_x", SKETCH_SIZE)
    return _values(df, column, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch"))


def merged_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The state of all rows of a ``by``, from the states of its parts; itself such a state."""
    return counts.groupBy(*(by or []), "place").agg(F.sum("n").alias("n"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    merged = sketches.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.where("n > 0")


def sketched_quantiles(sketches: DataFrame, probabilities: list[float], by: list[str] | None = None) -> DataFrame:
    """Rows (by…, probability, n, quantile), off by the sketch's error; no values are read."""
    listed = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.col("n"),
            F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile"),
        )
        for p in probabilities
    ]
    return merged_sketches(sketches, by).select(*(by or []), F.inline(F.array(*listed)))


def _ranks(counts: DataFrame, probabilities: list[float], by: list[str]) -> DataFrame:
    """Rows (by…, probability, total, rank, share, place, before): the range of both ranks of every quantile."""
    ordered = Window.partitionBy(*by).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as ranges, whatever the values.
    placed = merged_counts(counts, by).select(
        *by, "place", "n", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(*by)).alias("total"),
    )
    exact = [F.lit(float(p)) * (F.col("total") - 1) for p in probabilities]
    asked = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            rank.cast("long").alias("rank"),
            (at - F.floor(at)).alias("share"),
            F.lit(upper).alias("upper"),
        )
        for p, at in zip(probabilities, exact)
        for upper, rank in ((False, F.floor(at)), (True, F.ceil(at)))
    ]
    each = placed.select("*", F.inline(F.array(*asked)))
    inside = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    return each.where(inside).drop("n")


def refined_quantiles(
    counts: DataFrame, df: DataFrame, column: str, probabilities: list[float], by: list[str] | None = None
) -> DataFrame:
    """Rows (by…, probability, n, quantile), exact: ``counts`` are the states of the parts of ``df``.

    Of ``df`` only the values in the ranges that hold a rank are counted, and a
    condition on the column keeps the scan to them. Groups or ranges of an empty
    table give no row. The ranges, at most two per group and probability, are
    collected for that condition if they are few, which those of a whole table are.
    """
    by = by or []
    ranks = _ranks(counts, probabilities, by)
    wanted = ranks.select(*by, "place").distinct()
    low, high = range_edges(F.col("place"))
    edges = wanted.select("place").distinct().select(low.alias("low"), high.alias("high"))
    reach = F.lit(False)
    for row in edges.limit(4 * len(probabilities) + 1).collect():
        reach = reach | F.col(column).between(F.lit(row["low"]), F.lit(row["high"]))
    if by:  # each group has ranges of its own; what encloses them all is read
        outer = edges.agg(F.min("low"), F.max("high")).first()
        reach = F.lit(False) if outer[0] is None else F.col(column).between(F.lit(outer[0]), F.lit(outer[1]))
    near = _values(df.where(reach), column, by).withColumn("place", value_range(F.col("_x")))
    held = lookup_join(near, wanted, [*by, "place"], "left_semi", null_safe=True)
    copies = held.groupBy(*by, "place", "_x").agg(F.count(F.lit(1)).alias("_copies"))
    # Prefix sums inside a range, whose distinct values are at most 2 % apart.
    inner = Window.partitionBy(*by, "place").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    listed = copies.withColumn("_start", F.coalesce(F.sum("_copies").over(inner), F.lit(0)))
    met = lookup_join(listed, ranks, [*by, "place"], null_safe=True)
    offset = F.col("rank") - F.col("before")
    picked = met.where((offset >= F.col("_start")) & (offset < F.col("_start") + F.col("_copies")))
    found = picked.groupBy(*by, "probability").agg(
        F.max("total").alias("n"),
        F.max("share").alias("_share"),
        F.max(F.when(~F.col("upper"), F.col("_x"))).alias("_lower"),
        F.max(F.when(F.col("upper"), F.col("_x"))).alias("_upper"),
    )
    between = F.col("_lower") + F.col("_share") * (F.col("_upper") - F.col("_lower"))
    even = F.col("_lower") == F.col("_upper")
    return found.select(*by, "probability", "n", F.when(even, F.col("_lower")).otherwise(between).alias("quantile"))
