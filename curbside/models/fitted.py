"""Fitted models of all groups as tables, scored by one plan.

A model is rows, not an object per group: the dictionary of its features, the lines
and the nodes of its trees, each row with its group. Such tables are stored and read
like any other, and a table of test rows is scanned once whatever the number of
groups and models: it meets the few rows of its group's models by a lookup.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from curbside.constants import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from curbside.models import grouped
from curbside.models.features import SCALED
from curbside.operators.joins import lookup_join
from curbside.sources.tables import read_trips, write_table
from curbside.workspace import stage_path, staged

_NODE = "tree int, node int, slot int, threshold double, below int, above int, prediction double, depth int"
_LINE = "column string, value string, effect double, trips long"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


# --- feature vectors ---------------------------------------------------------------


def stored_vectors(encoded: DataFrame, dictionary: DataFrame, by: list[str], label: str = LABEL) -> DataFrame:
    """Rows (by…, label, scaled_features) as Spark ML reads them, stored by group.

    The cells are written in the form in which vectors are stored, and read back as
    vectors. Rows without features, or without a label, are left out.
    """
    sizes = dictionary.groupBy(*by).agg(F.count(F.lit(1)).cast("int").alias("_size"))
    rows = encoded.where(F.col("features").isNotNull() & F.col(label).isNotNull())
    rows = lookup_join(rows, sizes, by) if by else rows.crossJoin(F.broadcast(sizes))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.col("_size").alias("size"),
        F.col("features.slot").alias("indices"),
        F.col("features.value").alias("values"),
    )
    stored = rows.select(F.col(label).cast("double").alias(label), vector.alias(SCALED), *by)
    path = stage_path(rows.sparkSession, "vectors")
    dealt = stored.hint("rebalance", *by) if by else stored
    # In a fixed order, as forests draw their samples by it.
    write_table(dealt.sortWithinPartitions(*by, label, SCALED), path, *by)
    fields = [f for f in stored.schema if f.name != SCALED] + [StructField(SCALED, VectorUDT())]
    return read_trips(rows.sparkSession, path, schema=StructType(fields))


# --- trees as rows -----------------------------------------------------------------


def forest_nodes(model: RandomForestRegressionModel) -> DataFrame:
    """Rows (tree, node, slot, threshold, below, above, prediction, depth) of a fitted forest.

    Spark ML stores a forest as a table of nodes, numbered from 0 in every tree; a
    leaf has no children, here -1.
    """
    spark = SparkSession.active()
    path = stage_path(spark, "forest")
    model.save(path)
    node = "nodeData"
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col(f"{node}.id").alias("node"),
        F.col(f"{node}.split.featureIndex").alias("slot"),
        F.get(f"{node}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col(f"{node}.leftChild").alias("below"),
        F.col(f"{node}.rightChild").alias("above"),
        F.col(f"{node}.prediction").alias("prediction"),
        F.lit(model.getOrDefault("maxDepth")).alias("depth"),
    )


def packed_forests(nodes: DataFrame, by: list[str]) -> DataFrame:
    """One row (by…, trees) per group: every tree's nodes in their order, and the greatest depth."""
    node = F.struct("node", "slot", "threshold", "below", "above", "prediction")
    trees = nodes.groupBy(*by, "tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"), F.max("depth").alias("depth"))
    packed = trees.groupBy(*by).agg(F.collect_list("nodes").alias("trees"), F.max("depth").alias("depth"))
    return packed.where(F.size("trees") > 0)


def forest_prediction(features: Column, trees: Column, depth: Column) -> Column:
    """Mean of the trees' leaves that sparse features lead to, going down ``depth`` times."""

    def leaf(cells: Column, nodes: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            def beside(node: Column) -> Column:
                value = F.coalesce(F.try_element_at(cells, node["slot"]), F.lit(0.0))
                below = F.when(value <= node["threshold"], node["below"]).otherwise(node["above"])
                return F.when(node["below"] < 0, at).otherwise(below)

            return bound(F.get(nodes, at), beside)

        last = F.aggregate(F.sequence(F.lit(1), depth), F.lit(0), down)
        return F.get(nodes, last)["prediction"]

    def mean(cells: Column) -> Column:
        return F.aggregate(trees, F.lit(0.0), lambda total, nodes: total + leaf(cells, nodes)) / F.size(trees)

    return F.when(features.isNotNull(), bound(F.map_from_entries(features), mean))


# --- all models of all groups --------------------------------------------------------


@dataclass
class FittedModels:
    """Tables of the models of every group, and how their rows are made."""

    dictionary: DataFrame  # (by…, column, value, trips, slot, scale)
    lines: dict[str, DataFrame]  # by model: (by…, column, value, effect, trips)
    forests: dict[str, DataFrame]  # by model: (by…, tree, node, …)
    order: list[str]
    by: list[str] = field(default_factory=lambda: list(grouped.BY))
    categories: list[str] = field(default_factory=lambda: list(CATEGORICAL_FEATURES))
    numbers: list[str] = field(default_factory=lambda: list(NUMERIC_FEATURES))

    def score(self, rows: DataFrame) -> DataFrame:
        """Every row of a group with models once per model, with ``model`` and ``prediction``."""
        columns = rows.columns
        if self.forests:
            rows = grouped.encode(rows, self.dictionary, self.by, self.categories, self.numbers)
        for i, name in enumerate(self.order):
            if name in self.lines:
                rows = grouped.score_lines(rows, self.lines[name], self.by, self.categories, self.numbers)
                rows = rows.withColumnRenamed("prediction", f"_prediction_{i}")
            else:
                packed = packed_forests(self.forests[name], self.by)
                met = lookup_join(rows, packed, self.by) if self.by else rows.crossJoin(F.broadcast(packed))
                found = forest_prediction(F.col("features"), F.col("trees"), F.col("depth"))
                rows = met.withColumn(f"_prediction_{i}", found).drop("trees", "depth")
        listed = [
            F.struct(F.lit(name).alias("model"), F.col(f"_prediction_{i}").alias("prediction"))
            for i, name in enumerate(self.order)
        ]
        return rows.select(*columns, F.inline(F.array(*listed)))

    def save(self, path: str) -> None:
        """Write the tables below ``path``; ``load_models`` reads them in any session."""
        spark = self.dictionary.sparkSession
        write_table(self.dictionary, f"{path}/dictionary")
        for kind, tables in (("lines", self.lines), ("forests", self.forests)):
            for name, table in tables.items():
                write_table(table, f"{path}/{kind}/{name}")
        about = [(n, "lines" if n in self.lines else "forests", i) for i, n in enumerate(self.order)]
        about += [(c, kind, i) for kind in ("by", "categories", "numbers") for i, c in enumerate(getattr(self, kind))]
        write_table(spark.createDataFrame(about, "name string, kind string, place int"), f"{path}/about")


def load_models(spark: SparkSession, path: str) -> FittedModels:
    # Names of models and columns only.
    about = spark.read.parquet(f"{path}/about").orderBy("kind", "place").collect()
    names = {kind: [r["name"] for r in about if r["kind"] == kind] for kind in ("lines", "forests", "by", "categories", "numbers")}
    tables = {kind: {n: spark.read.parquet(f"{path}/{kind}/{n}") for n in names[kind]} for kind in ("lines", "forests")}
    order = [r["name"] for r in sorted(about, key=lambda r: r["place"]) if r["kind"] in tables]
    keys = (names[k] for k in ("by", "categories", "numbers"))
    return FittedModels(spark.read.parquet(f"{path}/dictionary"), tables["lines"], tables["forests"], order, *keys)


def _plain(estimator: Estimator) -> bool:
    """Whether the equations of least squares give this estimator's model."""
    return isinstance(estimator, LinearRegression) and estimator.getRegParam() == 0 and estimator.getFitIntercept()


def _coefficients(spark: SparkSession, model, dictionary: DataFrame, trips: int) -> DataFrame:
    """Lines of one group from coefficients by slot."""
    by_slot = spark.createDataFrame(
        [(i, float(c)) for i, c in enumerate(model.coefficients)], "slot int, coefficient double"
    )
    effect = (F.col("coefficient") * F.col("scale")).alias("effect")
    effects = dictionary.join(F.broadcast(by_slot), "slot").select("column", "value", effect, "trips")
    intercept = [(grouped.INTERCEPT, None, float(model.intercept), trips)]
    return effects.unionByName(spark.createDataFrame(intercept, _LINE))


def fit_models(
    train: DataFrame,
    models: dict[str, Estimator],
    by: list[str] | None = None,
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
    label: str = LABEL,
    parallelism: int = 6,
) -> FittedModels:
    """Fit every model to every group of ``train``.

    Plain linear regressions of all groups come from one aggregate. Forests and
    penalised regressions are fitted by Spark ML, a distributed job per group over
    vectors that were encoded for all groups at once, up to ``parallelism`` groups at
    a time; the list of groups is collected, one row each.
    """
    for name, estimator in models.items():
        if not isinstance(estimator, (LinearRegression, RandomForestRegressor)):
            raise TypeError(f"model {name!r} has no form as a table: {type(estimator).__name__}")
    spark = train.sparkSession
    by = list(grouped.BY) if by is None else list(by)
    found = staged(grouped.moments(train, by, categories, numbers, label), "moments")
    dictionary = staged(grouped.dictionary(found, by, categories, numbers), "dictionary")
    lines, forests = {}, {}
    plain = [name for name, estimator in models.items() if _plain(estimator)]
    if plain:
        solved = staged(grouped.fit_lines(found, by, categories, numbers, label), "lines")
        lines = dict.fromkeys(plain, solved)
    others = {name: estimator for name, estimator in models.items() if name not in lines}
    if others:
        encoded = grouped.encode(train, dictionary, by, categories, numbers)
        vectors = stored_vectors(encoded, dictionary, by, label)
        totals = found.where(F.col("rolled") == (1 << len(categories)) - 1).select(*by, "n").collect()
        work = [(name, row) for row in totals for name in others]

        def fitted(task: tuple) -> tuple[str, DataFrame]:
            name, row = task
            own = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(row[c])) for c in by), F.lit(True))
            estimator = others[name].copy({others[name].featuresCol: SCALED, others[name].labelCol: label})
            model = estimator.fit(vectors.where(own).select(SCALED, label))
            if isinstance(model, RandomForestRegressionModel):
                table = forest_nodes(model)
            else:
                table = _coefficients(spark, model, dictionary.where(own), row["n"])
            return name, table.select(*[F.lit(row[c]).cast(train.schema[c].dataType).alias(c) for c in by], "*")

        with ThreadPool(max(1, min(parallelism, len(work)))) as pool:
            parts = pool.map(inheritable_thread_target(spark)(fitted), work)
        kinds = ", ".join(f"`{c}` {train.schema[c].dataType.simpleString()}" for c in by)
        for name, estimator in others.items():
            is_forest = isinstance(estimator, RandomForestRegressor)
            tables = [table for owner, table in parts if owner == name]
            nothing = spark.createDataFrame([], ", ".join(filter(None, [kinds, _NODE if is_forest else _LINE])))
            whole = staged(reduce(DataFrame.unionByName, tables, nothing), "model")
            (forests if is_forest else lines)[name] = whole
    return FittedModels(dictionary, lines, forests, list(models), by, list(categories), list(numbers))
