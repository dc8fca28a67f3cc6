"""Feature dictionaries and linear fits of all groups at once, from one aggregate.

A fit per borough by a loop reads the trips once for each borough and estimator.
Here one aggregate over grouping sets holds all that features and least squares
need: rows, sums and products of the numbers, whole, by every category's level and
by every pair of levels. Its size depends on the levels, not on the trips, and all
groups come from the same scan. From it come

- the dictionary: every level's and number's slot in the feature vector and its
  scale, as the feature pipeline of ``features`` has them;
- the lines: what each level and each unit of a number adds to a prediction.

Both are tables, applied by lookups, so rows of all groups are encoded and
scored by one plan. ``by`` names the grouping columns; an empty list fits one model.
"""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.constants import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from curbside.operators.joins import lookup_join

BY = ["Borough"]
INTERCEPT = "intercept"
# Slots of a group whose equations one task solves; as many as the exact solver of Spark ML takes.
MAX_SLOTS = 4_096
# Share of the largest eigenvalue below which a direction counts as not determined.
LEAST_EIGENVALUE = 1e-10


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _number(column: str) -> Column:
    return F.col(column).cast("double")


def _rolled(categories: list[str], kept: list[str]) -> int:
    """Grouping id of the set that keeps these categories beside the group."""
    return sum(1 << len(categories) - 1 - i for i, c in enumerate(categories) if c not in kept)


def moments(
    train: DataFrame,
    by: list[str] = BY,
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """Rows (by…, categories…, rolled, n, sums, products, variances) of every grouping set.

    Rows that lack a number or the label are left out. A category rolled up, or
    NULL, is NULL; ``rolled`` tells which.
    """
    cells = [*numbers, label]
    complete = train.select(
        *by, *[_text(c).alias(c) for c in categories], *[_number(c).alias(f"_{c}") for c in cells]
    ).dropna(subset=[f"_{c}" for c in cells])
    kept = [[], *[[c] for c in categories], *map(list, combinations(categories, 2))]
    sums = [F.sum(f"_{c}").alias(f"sum_{c}") for c in cells]
    products = [
        F.sum(F.col(f"_{a}") * F.col(f"_{b}")).alias(f"sum_{a}_{b}") for a, b in combinations_with_replacement(cells, 2)
    ]
    variances = [F.var_samp(f"_{c}").alias(f"var_{c}") for c in numbers]
    grouped = complete.groupingSets([[*by, *k] for k in kept], *by, *categories) if by or categories else complete.groupBy()
    rolled = F.grouping_id() if by or categories else F.lit(0)
    found = grouped.agg(rolled.cast("int").alias("rolled"), F.count(F.lit(1)).alias("n"), *sums, *products, *variances)
    return found.where("n > 0")


# --- dictionary --------------------------------------------------------------------


def _safe_inverse(deviation: Column) -> Column:
    """1 / deviation, and 0 for what never varies."""
    return F.when(deviation > 0, 1 / deviation).otherwise(F.lit(0.0))


def dictionary(
    found: DataFrame,
    by: list[str] = BY,
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
) -> DataFrame:
    """Rows (by…, column, value, trips, slot, scale) from the moments.

    Levels come before numbers, a category's levels most frequent first, ties by
    text. Values are NULL for numbers. One over the scale is the sample deviation.
    """
    whole = found.where(F.col("rolled") == _rolled(categories, []))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    totals = whole.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("n").alias("_total"))

    column, value, part = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("int")
    for i, c in enumerate(categories):
        own = F.col("rolled") == _rolled(categories, [c])
        column, value = F.when(own, F.lit(c)).otherwise(column), F.when(own, F.col(c)).otherwise(value)
        part = F.when(own, F.lit(i)).otherwise(part)
    levels = found.select(*by, column.alias("column"), value.alias("value"), part.alias("_part"), F.col("n").alias("trips"))
    levels = levels.where("value IS NOT NULL")
    # Levels are as many as zones and hours, whatever the trips.
    rank = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(F.col("trips").desc(), "value")) - 1
    earlier = Window.partitionBy(*by).orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    slot = (F.count(F.lit(1)).over(earlier) + rank).cast("int")
    share = F.col("trips") / F.col("_total")
    deviation = F.sqrt(share * (1 - share) * F.col("_total") / F.greatest(F.col("_total") - 1, F.lit(1)))
    placed = levels.withColumn("slot", slot)
    ranked = (placed.join(totals, same) if by else placed.crossJoin(F.broadcast(totals))).select(
        *by, "column", "value", "trips", "slot", _safe_inverse(deviation).alias("scale")
    )

    sizes = ranked.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by]).agg(F.count(F.lit(1)).alias("_size"))
    listed = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(None).cast("string").alias("value"),
                F.lit(i).alias("_place"),
                _safe_inverse(F.sqrt(F.col(f"var_{c}"))).alias("scale"),
            )
            for i, c in enumerate(numbers)
        ]
    )
    if not numbers:
        return ranked
    sized = whole.join(sizes, same, "left") if by else whole.crossJoin(F.broadcast(sizes))
    each = sized.select(*by, F.col("n").alias("trips"), "_size", F.inline(listed))
    ending = (F.coalesce("_size", F.lit(0)) + F.col("_place")).cast("int")
    return ranked.unionByName(each.select(*by, "column", "value", "trips", ending.alias("slot"), "scale"))


def _of_levels(rows: DataFrame, table: DataFrame, by: list[str], category: str, names: dict[str, str]) -> DataFrame:
    """``rows`` with columns of the table's level of their category, NULL where it has none."""
    own = table.where(F.col("column") == category)
    own = own.select(*by, F.col("value").alias("_value"), *[F.col(c).alias(n) for c, n in names.items()])
    met = lookup_join(rows.withColumn("_value", _text(category)), own, [*by, "_value"], "left")
    return met.drop("_value")


def _of_groups(rows: DataFrame, table: DataFrame, by: list[str], cells: dict[str, Column]) -> DataFrame:
    """``rows`` of the groups that the table has, with one aggregate of the table per cell."""
    one = table.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[cell.alias(name) for name, cell in cells.items()])
    one = one.where("_rows > 0").drop("_rows")  # without grouping columns, nothing aggregates to a row
    return lookup_join(rows, one, by) if by else rows.crossJoin(F.broadcast(one))


def encode(
    rows: DataFrame,
    table: DataFrame,
    by: list[str] = BY,
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
) -> DataFrame:
    """``rows`` with ``features``: (slot, value) of their scaled vectors' other than zero cells, by slot.

    Rows of groups outside the dictionary are left out, unseen levels have no cell,
    and a row that lacks a number has NULL features. Stage the dictionary before.
    """
    columns, levels = rows.columns, table.where("value IS NOT NULL")
    for c in categories:
        rows = _of_levels(rows, levels, by, c, {"slot": f"_{c}_slot", "scale": f"_{c}_scale"})
    picked = {
        f"_{c}_{cell}": F.max(F.when((F.col("column") == c) & F.col("value").isNull(), F.col(cell)))
        for c in numbers
        for cell in ("slot", "scale")
    }
    picked = picked or {"_any": F.count(F.lit(1))}
    rows = _of_groups(rows, table, by, picked)
    cells = [F.struct(F.col(f"_{c}_slot").alias("slot"), F.col(f"_{c}_scale").alias("value")) for c in categories]
    cells += [
        F.struct(F.col(f"_{c}_slot").alias("slot"), (_number(c) * F.col(f"_{c}_scale")).alias("value")) for c in numbers
    ]
    complete = F.lit(True)
    for c in numbers:
        complete = complete & F.col(c).isNotNull()
    sparse = F.array_sort(F.filter(F.array(*cells), lambda cell: cell["slot"].isNotNull() & (cell["value"] != 0)))
    return rows.select(*columns, F.when(complete, sparse).alias("features"))


# --- lines -------------------------------------------------------------------------


def _equations(table: pd.DataFrame, categories: list[str], numbers: list[str], label: str):
    """Names, sums, products and products with the label of a group's columns, and its total row."""
    rolled = table["rolled"]
    total = table[rolled == _rolled(categories, [])].iloc[0]
    names, blocks = [], {}
    for c in categories:
        own = table[(rolled == _rolled(categories, [c])) & table[c].notna()].sort_values(c)
        blocks[c] = own
        names += [(c, v) for v in own[c]]
    names += [(c, None) for c in numbers]
    if len(names) > MAX_SLOTS:
        raise ValueError(f"a group has {len(names)} slots, more than {MAX_SLOTS}: fit it with Spark ML")
    place = {name: i for i, name in enumerate(names)}
    first = len(names) - len(numbers)
    sums, with_label = np.zeros(len(names)), np.zeros(len(names))
    products = np.zeros((len(names), len(names)))
    for c, own in blocks.items():
        at = [place[c, v] for v in own[c]]
        sums[at], with_label[at] = own["n"], own[f"sum_{label}"]
        products[at, at] = own["n"]
        for i, number in enumerate(numbers):
            products[at, first + i] = products[first + i, at] = own[f"sum_{number}"]
    for a, b in combinations(categories, 2):
        pairs = table[(rolled == _rolled(categories, [a, b])) & table[a].notna() & table[b].notna()]
        left, right = [place[a, v] for v in pairs[a]], [place[b, v] for v in pairs[b]]
        products[left, right] = products[right, left] = pairs["n"]
    for i, a in enumerate(numbers):
        sums[first + i], with_label[first + i] = total[f"sum_{a}"], total[f"sum_{a}_{label}"]
        for j, b in enumerate(numbers[i:], i):
            products[first + i, first + j] = products[first + j, first + i] = total[f"sum_{a}_{b}"]
    return names, sums, products, with_label, total


def least_squares(table: pd.DataFrame, categories: list[str], numbers: list[str], label: str) -> pd.DataFrame:
    """Rows (column, value, effect, trips) of one group's moments, the intercept among them.

    Levels of a category add up to one, so the equations leave some directions
    open. There the solution of least length in scaled features is taken, which
    is where the iterations of Spark ML's solver end that start from zero.
    """
    names, sums, products, with_label, total = _equations(table, categories, numbers, label)
    n = float(total["n"])
    mean = sums / n
    centred = products - np.outer(mean, sums)
    right = with_label - mean * total[f"sum_{label}"]
    spread = np.diag(centred).copy()
    for i, c in enumerate(numbers, len(names) - len(numbers)):
        spread[i] = (total[f"var_{c}"] if n > 1 else 0.0) * (n - 1)
    varies = spread > 0
    varies[: len(names) - len(numbers)] &= sums[: len(names) - len(numbers)] < n
    effect = np.zeros(len(names))
    if varies.any():
        deviation = np.sqrt(spread[varies])
        values, vectors = np.linalg.eigh(centred[np.ix_(varies, varies)] / np.outer(deviation, deviation))
        told = values > LEAST_EIGENVALUE * values.max()
        vectors = vectors[:, told]
        effect[varies] = (vectors @ ((vectors.T @ (right[varies] / deviation)) / values[told])) / deviation
    intercept = (total[f"sum_{label}"] - sums @ effect) / n
    level = len(names) - len(numbers)
    trips = [int(sums[i]) if i < level else int(n) for i in range(len(names))]
    return pd.DataFrame(
        {
            "column": [c for c, _ in names] + [INTERCEPT],
            "value": [v for _, v in names] + [None],
            "effect": [*effect, intercept],
            "trips": [*trips, int(n)],
        }
    )


def fit_lines(
    found: DataFrame,
    by: list[str] = BY,
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """Rows (by…, column, value, effect, trips): least squares of every group of the moments.

    A group's rows are its levels and pairs of levels, of which one task solves the
    equations; trips were all added up before.
    """

    def solved(table: pd.DataFrame) -> pd.DataFrame:
        lines = least_squares(table, categories, numbers, label)
        for i, c in enumerate(by):
            lines.insert(i, c, table[c].iloc[0])
        return lines

    kinds = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in by)
    schema = ", ".join(filter(None, [kinds, "column string, value string, effect double, trips long"]))
    return found.groupBy(*by).applyInPandas(solved, schema)


def score_lines(
    rows: DataFrame,
    lines: DataFrame,
    by: list[str] = BY,
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
) -> DataFrame:
    """``rows`` of the groups that have a line, with ``prediction``; stage the lines before.

    An unseen level adds nothing; a row that lacks a number has no prediction.
    """
    columns, levels = rows.columns, lines.where("value IS NOT NULL")
    for c in categories:
        rows = _of_levels(rows, levels, by, c, {"effect": f"_{c}_effect"})
    single = {f"_{c}_effect": F.max(F.when((F.col("column") == c) & F.col("value").isNull(), F.col("effect"))) for c in [*numbers, INTERCEPT]}
    rows = _of_groups(rows, lines, by, single)
    prediction = F.col(f"_{INTERCEPT}_effect")
    for c in categories:
        prediction = prediction + F.coalesce(F.col(f"_{c}_effect"), F.lit(0.0))
    for c in numbers:
        prediction = prediction + _number(c) * F.col(f"_{c}_effect")
    return rows.select(*columns, prediction.alias("prediction"))


def wide_lines(lines: DataFrame, numbers: list[str], by: list[str] = BY) -> DataFrame:
    """Lines without categories, one row (by…, numbers…, intercept, n) per group."""
    cells = [F.max(F.when(F.col("column") == c, F.col("effect"))).alias(c) for c in [*numbers, INTERCEPT]]
    return lines.groupBy(*by).agg(*cells, F.max("trips").alias("n"))
