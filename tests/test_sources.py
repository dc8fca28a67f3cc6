"""Schemas, months, CSV files and partitioned tables."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers_core import rows
from curbside import workspace
from curbside.sources import schema, tables

START, END = datetime(2022, 12, 1, 8), datetime(2022, 12, 1, 8, 30)


def december(spark):
    return spark.createDataFrame(
        [(1, START, END, 2.0, 3.5, 1.0, "Y", 10, 20, 1, 9.9), (2, START, END, None, 1.5, 2.0, "X", 11, 21, 2, 5.0)],
        "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,"
        "passenger_count double, trip_distance double, RatecodeID double,"
        "store_and_fwd_flag string, PULocationID long, DOLocationID long, payment_type long, fare_amount double",
    )


def test_canonical_schema_narrows_and_lowers_names(spark):
    found = schema.canonical_schema(december(spark))
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {
        **{f.name: f.dataType.simpleString() for f in schema.TRIP_SCHEMA.fields},
        "fare_amount": "double",
    }


def test_flag_values(spark):
    table = spark.createDataFrame([(0, "Y"), (1, "N"), (2, "X"), (3, None)], "id int, f string")
    assert rows(table.select("id", schema.yes_no_flag(F.col("f")).alias("b"))) == [
        (0, True),
        (1, False),
        (2, None),
        (3, None),
    ]


def test_conform_matches_by_name_whatever_order_and_case(spark):
    source = december(spark)
    turned = source.select(*reversed(source.columns)).drop("RatecodeID")
    turned = turned.toDF(*[c.upper() for c in turned.columns])
    conformed = schema.conform_schema(turned)
    assert conformed.schema.names == schema.TRIP_SCHEMA.names
    assert [f.dataType for f in conformed.schema.fields] == [f.dataType for f in schema.TRIP_SCHEMA.fields]
    assert rows(conformed, "vendorid", "passenger_count", "ratecodeid", "store_and_fwd_flag", "pulocationid") == [
        (1, 2, None, True, 10),
        (2, None, None, None, 11),
    ]


def test_values_that_do_not_fit_become_null(spark):
    table = spark.createDataFrame([("1.0",), ("many",), (None,)], "passenger_count string")
    conformed = schema.conform_schema(table, schema.struct_of({"passenger_count": "int"}))
    assert sorted(r[0] is None for r in conformed.collect()) == [False, True, True]
    wide = spark.createDataFrame([(3_000_000_000,)], "payment_type long")
    assert schema.narrow_integers(wide, ["payment_type"]).first()[0] is None


def test_schema_difference(spark):
    left = spark.createDataFrame([(1, "a", None)], "Id long, name string, gone int")
    right = spark.createDataFrame([(1, "a", 2)], "id int, NAME string, extra int")
    found = rows(schema.schema_diff(left, right), "column_name", "left_non_null", "right_non_null", "status")
    assert found == [
        ("extra", 0, 1, "right only"),
        ("gone", 0, 0, "left only"),
        ("id", 1, 1, "type differs"),
        ("name", 1, 1, "same"),
    ]


def test_unknown_sets_are_refused(spark):
    with pytest.raises(ValueError, match="train_set"):
        tables.month_paths("data", "trian_set", {2023: [1]})
    with pytest.raises(ValueError, match="train_set"):
        tables.integrate_months(spark, "data", "raw", "other", {2023: [1]})


def test_month_paths_are_zero_padded():
    assert tables.month_paths("data", "train_set", {2022: [12], 2023: [1]}) == [
        "data/train_set/2022-12.parquet",
        "data/train_set/2023-01.parquet",
    ]


def test_months_of_different_schema_become_one_table(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    december(spark).write.parquet(tables.month_path(landing, "train_set", 2022, 12))
    later = december(spark).withColumn("passenger_count", F.lit("3.0")).drop("payment_type")
    schema.lowercase_columns(later).write.parquet(tables.month_path(landing, "train_set", 2023, 1))
    months = {2022: [12], 2023: [1]}
    tables.integrate_months(spark, landing, raw, "train_set", months)
    tables.integrate_months(spark, landing, raw, "train_set", {2023: [1]})  # rewrites one month
    table = tables.read_trips(spark, raw)
    assert rows(table, "set_name", "year", "month", "vendorid", "passenger_count", "payment_type") == [
        ("train_set", 2022, 12, 1, 2, 1),
        ("train_set", 2022, 12, 2, None, 2),
        ("train_set", 2023, 1, 1, 3, None),
        ("train_set", 2023, 1, 2, 3, None),
    ]
    with pytest.raises(ValueError, match="months"):
        tables.integrate_months(spark, landing, raw, "train_set", {})


def test_imposed_schema_finds_columns_of_other_case(spark, tmp_path):
    path = str(tmp_path / "months")
    december(spark).write.parquet(f"{path}/2022-12")
    wanted = schema.struct_of({"vendorid": "bigint", "pulocationid": "bigint", "surcharge": "double"})
    table = tables.read_trips(spark, f"{path}/*", schema=wanted)
    assert rows(table) == [(1, 10, None), (2, 11, None)]


def test_csv_columns_are_picked_by_header(spark, tmp_path):
    (tmp_path / "w.csv").write_text(
        "name,datetime,temp,feelslike,windgust,snow,snowdepth,visibility,conditions\n"
        'NYC,2024-01-01T05:00:00,3.5,1,20.1,0,,16,"Rain, Overcast"\n'
        "NYC,2024-01-01T06:00:00,bad,1,,0,1.5,16,Clear\n"
    )
    table = tables.read_weather(spark, str(tmp_path / "w.csv"))
    assert [f.dataType.simpleString() for f in table.schema.fields] == ["timestamp_ntz"] + ["double"] * 5 + ["string"]
    assert rows(table, "datetime", "temp", "snowdepth", "windgust", "conditions") == [
        (datetime(2024, 1, 1, 5), 3.5, None, 20.1, "Rain, Overcast"),
        (datetime(2024, 1, 1, 6), None, 1.5, None, "Clear"),
    ]
    (tmp_path / "z.csv").write_text('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark","EWR"\n')
    assert rows(tables.read_zones(spark, str(tmp_path / "z.csv"))) == [(1, "EWR", "Newark", "EWR")]


def test_borough_split_partitions_the_input(spark, tmp_path):
    path = str(tmp_path / "by_borough")
    names = ["Queens", "N/A", "Staten Island"]
    table = spark.range(90).select(
        "id", F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("id") % 3 + 1).cast("int")).alias("Borough")
    )
    tables.write_by_borough(table, path)
    assert {d for d in os.listdir(path) if d.startswith("Borough=")} == {
        "Borough=Queens",
        "Borough=N%2FA",
        "Borough=Staten Island",
    }
    assert rows(tables.read_boroughs(spark, path)) == rows(table)
    assert tables.read_boroughs(spark, path, ["N/A"]).count() == 30
    some = table.where("Borough = 'Queens' and id < 30")
    # Replacing one borough leaves the others in place; a rebuild leaves nothing else.
    tables.write_by_borough(some, path, rebuild=False)
    counts = rows(tables.read_boroughs(spark, path).groupBy("Borough").count())
    assert counts == [("N/A", 30), ("Queens", 10), ("Staten Island", 30)]
    tables.write_by_borough(some, path)
    assert rows(tables.read_boroughs(spark, path).groupBy("Borough").count()) == [("Queens", 10)]


def test_overwrite_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(10), path)
    tables.write_table(spark.range(3), path)
    assert tables.read_trips(spark, path).count() == 3


def test_stage_paths_are_new_and_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = (workspace.stage_path(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(root or "file:/tmp")
    assert spark.conf.get("spark.checkpoint.dir", None) == root


def test_stage_path_needs_a_shared_folder_on_a_cluster(monkeypatch):
    monkeypatch.setattr(workspace, "_default_scheme", lambda spark: "file")

    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://head:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.stage_path(Session, "x")
