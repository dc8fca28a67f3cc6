"""Quantiles of a numeric column, exact or approximate, whole or by group.

``exact_quantiles`` takes two scans at every size. The first one's sketch gives,
for each wanted rank, a value surely below and one surely above it. The second
counts the rows below the lower value and, one by one, the values between the
two, of which a sketch of accuracy A leaves about 4 n / A; the ranks are picked
among those. Were a rank ever outside, the query would fail, not answer wrongly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.constants import QUANTILE_RELATIVE_ERROR

# Accuracy of the sketch: at 10^11 rows some 4 million values are left around a rank.
BRACKET_ACCURACY = 100_000


def _values(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(*by, value.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))


def approx_quantiles(
    df: DataFrame,
    column: str,
    probabilities: list[float],
    by: list[str] | None = None,
    relative_error: float = QUANTILE_RELATIVE_ERROR,
) -> DataFrame:
    """Rows (by…, probability, n, quantile) off by at most ``relative_error * n`` ranks."""
    by = by or []
    accuracy = max(1, round(1 / relative_error))
    wanted = F.percentile_approx("_x", [float(p) for p in probabilities], accuracy)
    table = _values(df, column, by).groupBy(*by).agg(F.count("_x").alias("n"), wanted.alias("q"))
    listed = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.col("n"),
            F.get("q", F.lit(i)).alias("quantile"),
        )
        for i, p in enumerate(probabilities)
    ]
    return table.select(*by, F.inline(F.array(*listed)))


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: list[float],
    by: list[str] | None = None,
    accuracy: int = BRACKET_ACCURACY,
) -> DataFrame:
    """Rows (by…, probability, n, quantile), interpolated between neighbouring values.

    Lazy. An empty input gives one row per probability with n = 0 and a NULL
    quantile, or no row when grouped.
    """
    by = by or []
    values = _values(df, column, by).withColumn("_w", F.lit(1).cast("long"))
    brackets = _brackets(values, probabilities, by, accuracy)
    if by:
        same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in by]
        brackets = brackets.withColumnsRenamed({name: f"_of_{name}" for name in by})
        met = values.join(brackets, same)
    else:
        # A row of no weight stands for an empty input; the brackets are one row.
        blank = df.sparkSession.range(1).select(
            F.lit(None).cast("double").alias("_x"), F.lit(0).cast("long").alias("_w")
        )
        met = values.unionByName(blank).crossJoin(F.broadcast(brackets))
    # Rows below a bracket count together as a NULL value, which sorts first.
    placed = F.transform(
        F.filter("_brackets", lambda b: F.col("_x").isNull() | (F.col("_x") <= b["high"])),
        lambda b: F.struct(
            b["at"].alias("_at"),
            F.when(F.col("_x") >= b["low"], F.col("_x")).alias("_value"),
        ),
    )
    counted = (
        met.select(*by, "n", "_w", F.inline(placed))
        .groupBy(*by, "n", "_at", "_value")
        .agg(F.sum("_w").alias("_copies"))
    )
    listed = F.array(*[F.lit(float(p)) for p in probabilities])
    place = F.get(listed, F.col("_at")) * (F.col("n") - 1)
    ordered = Window.partitionBy(*by, "_at").orderBy("_value")
    picked = counted.withColumn("_start", F.sum("_copies").over(ordered) - F.col("_copies"))
    lower, upper = (F.max(F.when(_holds(rank), F.col("_value"))) for rank in (F.floor(place), F.ceil(place)))
    found = picked.groupBy(*by, "_at").agg(
        F.max("n").alias("n"), lower.alias("_lower"), upper.alias("_upper")
    )
    quantile = _interpolated(place - F.floor(place))
    return found.select(*by, F.get(listed, F.col("_at")).alias("probability"), "n", quantile.alias("quantile"))


def _brackets(values: DataFrame, probabilities: list[float], by: list[str], accuracy: int) -> DataFrame:
    """Rows (by…, n, _brackets): for each probability a value below and one above its rank.

    The sketch gives values at growing distances from each probability. The
    nearest is taken whose distance exceeds the sketch's error by two ranks.
    """
    distances = [2 / accuracy]
    while distances[-1] < 1:
        distances.append(2 * distances[-1])
    sides = {(p, d, side): min(max(p + side * d, 0.0), 1.0) for p in probabilities for d in distances for side in (-1, 1)}
    sought = sorted(set(sides.values()))

    def edge(p: float, side: int) -> Column:
        outermost = {0.0: F.col("_least"), 1.0: F.col("_most")}
        marks = [
            outermost.get(sides[p, d, side], F.get("_marks", F.lit(sought.index(sides[p, d, side]))))
            for d in distances
        ]
        return F.get(F.array(*marks), F.col("_near"))

    listed = [
        F.struct(
            F.lit(i).alias("at"), edge(p, -1).alias("low"), edge(p, 1).alias("high")
        )
        for i, p in enumerate(probabilities)
    ]
    sketch = values.groupBy(*by).agg(
        F.count("_x").alias("n"),
        F.min("_x").alias("_least"),
        F.max("_x").alias("_most"),
        F.percentile_approx("_x", sought, accuracy).alias("_marks"),
    )
    # distance >= 1 / accuracy + 2 / n, in doublings of 2 / accuracy
    doublings = F.ceil(F.log2(F.lit(0.5) + F.lit(float(accuracy)) / F.greatest("n", F.lit(1))))
    near = F.least(F.greatest(doublings, F.lit(0)), F.lit(len(distances) - 1)).cast("int")
    return sketch.withColumn("_near", near).select(*by, "n", F.array(*listed).alias("_brackets"))


def _holds(rank: Column) -> Column:
    """Whether the rank is one of those the value's copies fill."""
    return (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_copies"))


def _interpolated(share: Column) -> Column:
    outside = (F.col("n") > 0) & (F.col("_lower").isNull() | F.col("_upper").isNull())
    even = F.col("_lower") == F.col("_upper")
    between = F.col("_lower") + share * (F.col("_upper") - F.col("_lower"))
    failed = F.raise_error(F.lit("a quantile's rank is outside its bracket")).cast("double")
    return F.when(outside, failed).when(even, F.col("_lower")).otherwise(between)
