"""Models of all groups as tables: dictionaries, lines and trees against Spark ML and by hand."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from curbside.constants import LABEL
from curbside.models import duration, features, grouped
from curbside.models.features import SCALED
from curbside.models.fitted import fit_models, load_models, stored_vectors
from curbside.workspace import stage_path, staged
from helpers_core import plan_text, rows
from test_models import planted


@pytest.fixture(scope="module")
def trips(spark):
    """Trips of two boroughs with noise, so that no model is exact; one holds most of them."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100.0
    named = F.when(F.col("id") % 5 == 0, "Bronx").otherwise("Queens")
    table = planted(spark, 1200).withColumn("Borough", named).withColumn(LABEL, F.col(LABEL) + noise)
    return staged(table.withColumn("set_name", F.when(F.col("id") < 900, "train").otherwise("test")), "trips")


def sides(trips):
    return [trips.where(F.col("set_name") == name).drop("set_name") for name in ("train", "test")]


def one_borough(table, name):
    return table.where(F.col("Borough") == name)


def vectors(table):
    cells = table.select(vector_to_array(SCALED).alias("v"), LABEL).collect()
    return sorted((*(round(x, 9) for x in r["v"]), round(r[LABEL], 9)) for r in cells)


def test_vectors_equal_the_feature_pipeline_in_every_borough(trips):
    train, _ = sides(trips)
    table = staged(grouped.dictionary(grouped.moments(train)), "dictionary")
    stored = stored_vectors(grouped.encode(train, table), table, ["Borough"])
    for name in ("Queens", "Bronx"):
        prepared, _, _ = features.prepare_features(one_borough(train, name), one_borough(train, name))
        assert vectors(one_borough(stored, name)) == vectors(prepared)


def test_dictionary_orders_and_scales_by_hand(spark):
    table = spark.createDataFrame(
        [("a", 10, 1.0, 5.0), ("a", 10, 2.0, 5.0), ("a", 9, 3.0, 5.0), ("a", 2, 4.0, 5.0), ("b", 7, 1.0, 1.0)],
        "Borough string, hour int, trip_distance double, trip_duration double",
    )
    found = grouped.dictionary(grouped.moments(table, ["Borough"], ["hour"], ["trip_distance"]), ["Borough"], ["hour"], ["trip_distance"])
    listed = {(r["Borough"], r["column"], r["value"]): (r["slot"], r["trips"], r["scale"]) for r in found.collect()}
    assert {k: v[:2] for k, v in listed.items()} == {
        ("a", "hour", "10"): (0, 2), ("a", "hour", "2"): (1, 1), ("a", "hour", "9"): (2, 1), ("a", "trip_distance", None): (3, 4),
        ("b", "hour", "7"): (0, 1), ("b", "trip_distance", None): (1, 1),
    }
    assert listed["a", "hour", "10"][2] == pytest.approx(1 / (1 / 3) ** 0.5)
    assert listed["a", "trip_distance", None][2] == pytest.approx(1 / (5 / 3) ** 0.5)
    # A level that all rows share, and a number seen once, never vary.
    assert listed["b", "hour", "7"][2] == 0 and listed["b", "trip_distance", None][2] == 0


def test_lines_equal_linear_regression_of_every_borough(trips):
    train, _ = sides(trips)
    numbers = ["trip_distance", "temp", "windgust", "hour"]
    lines = duration.borough_lines(train, numbers, ["Queens", "Bronx", "Nowhere"]).collect()
    assert {r["Borough"] for r in lines} == {"Queens", "Bronx"}
    for row in lines:
        own = one_borough(train, row["Borough"])
        assembled = VectorAssembler(inputCols=numbers, outputCol="x").transform(own)
        model = duration.linear_regression("x").fit(assembled)
        assert [row[c] for c in numbers] == pytest.approx(list(model.coefficients), abs=1e-6)
        assert row["intercept"] == pytest.approx(model.intercept, abs=1e-6)
        assert row["n"] == own.count()


def test_lines_with_levels_leave_no_error_along_any_input(trips):
    """The normal equations: residuals add up to nothing by every level and along every number."""
    train, _ = sides(trips)
    fitted = fit_models(train, {"linear": duration.linear_regression()})
    left = fitted.score(train).withColumn("rest", F.col(LABEL) - F.col("prediction"))
    for c in fitted.categories:
        assert all(abs(r[0]) < 1e-6 for r in left.groupBy("Borough", c).agg(F.sum("rest")).select("sum(rest)").collect())
    along = [F.sum(F.col("rest") * F.col(c).cast("double")) for c in fitted.numbers]
    assert all(abs(x) < 1e-5 for r in left.groupBy("Borough").agg(*along).collect() for x in r[1:])


def test_lines_score_as_spark_ml_of_every_borough(trips):
    train, test = sides(trips)
    ridge = duration.linear_regression().setRegParam(0.3)
    models = {"linear": duration.linear_regression(), "ridge": ridge}
    fitted = fit_models(train, models)
    found = {(r["id"], r["model"]): r["prediction"] for r in fitted.score(test).collect()}
    assert len(found) == 2 * test.count()
    for name in ("Queens", "Bronx"):
        fit_rows, score_rows, _ = features.prepare_features(one_borough(train, name), one_borough(test, name))
        # The iterations that Spark ML falls back to for open directions stop early.
        for model, digits in (("linear", 1e-3), ("ridge", 1e-9)):
            for row in duration.predict(fit_rows, score_rows, models[model]).collect():
                assert found[row["id"], model] == pytest.approx(row["prediction"], abs=digits)


def test_default_forest_scores_as_spark_ml_transforms(trips):
    train, test = (one_borough(t, "Queens") for t in sides(trips))
    fitted = fit_models(train, {"forest": duration.random_forest()})
    encoded = [grouped.encode(t, fitted.dictionary) for t in (train, test)]
    same = [stored_vectors(t, fitted.dictionary, ["Borough"]) for t in encoded]
    model = duration.random_forest().fit(same[0])
    wanted = sorted(r["prediction"] for r in model.transform(same[1]).collect())
    assert sorted(r["prediction"] for r in fitted.score(test).collect()) == pytest.approx(wanted, abs=1e-9)
    assert fitted.forests["forest"].select("tree").distinct().count() == 20


def test_scoring_scans_the_test_rows_once(trips, spark):
    train, test = sides(trips)
    fitted = duration.fit_boroughs(train, ["Queens", "Bronx"], {"linear": duration.linear_regression(), "forest": duration.random_forest().setNumTrees(2)})
    path = stage_path(spark, "scored-once")
    test.write.parquet(path)
    plan = plan_text(duration.score_boroughs(fitted, spark.read.parquet(path)))
    assert plan.count(path.rsplit("/", 1)[1]) == 1
    assert "Union" not in plan and "Python" not in plan


def test_models_survive_a_restart(trips, spark):
    train, test = sides(trips)
    fitted = fit_models(train, {"line": duration.linear_regression(), "forest": duration.random_forest().setNumTrees(3)})
    path = stage_path(spark, "models")
    fitted.save(path)
    again = load_models(spark.newSession(), path)
    assert (again.order, again.by, again.categories, again.numbers) == (fitted.order, fitted.by, fitted.categories, fitted.numbers)
    fresh = spark.newSession().createDataFrame(test.collect(), test.schema)
    assert rows(again.score(fresh), "id", "model", "prediction") == rows(fitted.score(test), "id", "model", "prediction")


def test_sql_rescores_an_exported_forest(trips, spark):
    """Depth 2, all rows and features: DuckDB goes down the stored nodes by itself."""
    train, test = sides(trips)
    forest = RandomForestRegressor(
        featuresCol=SCALED, labelCol=LABEL, numTrees=3, maxDepth=2, bootstrap=False, featureSubsetStrategy="all"
    )
    fitted = fit_models(train, {"forest": forest})
    path = stage_path(spark, "exported")
    fitted.save(path)
    encoded = grouped.encode(test, fitted.dictionary).select("id", "Borough", F.explode("features").alias("f"))
    encoded.select("id", "Borough", "f.slot", "f.value").write.parquet(f"{path}/cells")
    test.select("id", "Borough").write.parquet(f"{path}/asked")
    local = path.removeprefix("file:")
    answer = duckdb.sql(
        f"""with recursive nodes as (select * from '{local}/forests/forest/*.parquet'),
          cells as (select * from '{local}/cells/*.parquet'),
          walk as (
            select id, Borough, tree, 0 as node from '{local}/asked/*.parquet' join (select distinct Borough, tree from nodes) using (Borough)
            union all
            select w.id, w.Borough, w.tree, case when coalesce(c.value, 0) <= n.threshold then n.below else n.above end
            from walk w join nodes n using (Borough, tree, node) left join cells c on c.id = w.id and c.slot = n.slot
            where n.below >= 0)
          select id, avg(prediction) from walk join nodes using (Borough, tree, node) where below < 0 group by id"""
    ).fetchall()
    found = {r["id"]: r["prediction"] for r in fitted.score(test).collect()}
    assert found == pytest.approx(dict(answer), abs=1e-9)
    # All trees saw the same rows and features, so each is the tree that Spark ML grows alone.
    tree = DecisionTreeRegressor(featuresCol=SCALED, labelCol=LABEL, maxDepth=2)
    fit_rows, score_rows, _ = features.prepare_features(one_borough(train, "Bronx"), one_borough(test, "Bronx"))
    alone = {r["id"]: r["prediction"] for r in tree.fit(fit_rows).transform(score_rows).collect()}
    assert {i: found[i] for i in alone} == pytest.approx(alone, abs=1e-9)


def test_unseen_levels_missing_numbers_and_unknown_groups(trips, spark):
    train, test = sides(trips)
    forest = duration.random_forest().setNumTrees(2).setBootstrap(False).setMaxDepth(2)
    fitted = fit_models(train, {"linear": duration.linear_regression(), "forest": forest})
    row = one_borough(test, "Queens").limit(1)
    odd = row.withColumn("hour", F.lit(77)).withColumn("pulocationid", F.lit(None).cast("int")).withColumn("id", F.lit(1))
    odd = odd.unionByName(row.withColumn("temp", F.lit(None).cast("double")).withColumn("id", F.lit(2)))
    odd = odd.unionByName(row.withColumn("Borough", F.lit("Nowhere")).withColumn("id", F.lit(3)))
    found = {(r["id"], r["model"]): r["prediction"] for r in fitted.score(odd).collect()}
    assert set(found) == {(i, m) for i in (1, 2) for m in ("linear", "forest")}
    assert found[2, "linear"] is None and found[2, "forest"] is None
    fit_rows, score_rows, _ = features.prepare_features(one_borough(train, "Queens"), odd.where("id = 1"))
    for name, model in (("linear", duration.linear_regression()), ("forest", forest)):
        wanted = duration.predict(fit_rows, score_rows, model).first()["prediction"]
        assert found[1, name] == pytest.approx(wanted, abs=1e-3)


def test_rows_without_a_number_or_label_do_not_teach(trips):
    train, _ = sides(trips)
    gaps = F.when(F.col("id") % 3 != 0, F.col("temp"))
    lacking = train.withColumn("temp", gaps).withColumn(LABEL, F.when(F.col("id") % 7 != 0, F.col(LABEL)))
    whole = lacking.dropna(subset=["temp", LABEL])
    same = [rows(grouped.fit_lines(grouped.moments(t)), "Borough", "column", "value", "trips") for t in (lacking, whole)]
    assert same[0] == same[1]


def test_one_model_of_all_rows_and_models_of_two_columns(trips):
    train, test = sides(trips)
    forest = duration.random_forest().setNumTrees(2).setBootstrap(False).setMaxDepth(2)
    whole = fit_models(train, {"linear": duration.linear_regression(), "forest": forest}, [])
    found = {(r["id"], r["model"]): r["prediction"] for r in whole.score(test).collect()}
    fit_rows, score_rows, _ = features.prepare_features(train, test)
    for name, model in (("linear", duration.linear_regression()), ("forest", forest)):
        for row in duration.predict(fit_rows, score_rows, model).collect():
            assert found[row["id"], name] == pytest.approx(row["prediction"], abs=1e-3)
    fitted = fit_models(train, {"linear": duration.linear_regression()}, ["Borough", "is_weekend"], ["hour"], ["trip_distance"])
    score = fitted.score(train).withColumn("rest", F.col(LABEL) - F.col("prediction"))
    left = score.groupBy("Borough", "is_weekend", "hour").agg(F.sum("rest").alias("rest")).collect()
    assert len(left) == 24 and all(abs(r["rest"]) < 1e-6 for r in left)


def test_no_rows_give_no_models(trips):
    train, test = sides(trips)
    models = {"linear": duration.linear_regression(), "forest": duration.random_forest()}
    for by in (["Borough"], []):
        assert fit_models(train.where("false"), models, by).score(test).count() == 0


def test_estimators_without_a_table_are_refused(trips):
    train, _ = sides(trips)
    with pytest.raises(TypeError, match="tree"):
        fit_models(train, {"tree": DecisionTreeRegressor()})


def test_fits_of_all_boroughs_scan_the_training_rows_once(trips, spark):
    train, _ = sides(trips)
    path = stage_path(spark, "fitted-once")
    train.write.parquet(path)
    plan = plan_text(grouped.fit_lines(grouped.moments(spark.read.parquet(path))))
    assert plan.count(path.rsplit("/", 1)[1]) == 1
    assert plan.count("Expand") >= 1
