"""Parquet and CSV tables: months, lookups, curated and per-borough data."""

from __future__ import annotations

from collections.abc import Iterable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from curbside.constants import TRIP_MONTHS, WEATHER_COLUMN_TYPES, ZONE_COLUMN_TYPES
from curbside.sources.schema import TRIP_SCHEMA, conform_schema, struct_of

PARALLEL_FOOTERS = 16

# Fixed value: how a month's landing file ends.
MONTH_FILE = r"(\d{4})-(\d{2})\.parquet"

Months = dict[int, list[int]]


def month_path(root: str, set_name: str, year: int, month: int) -> str:
    """``root/set_name/YYYY-MM.parquet`` with the month zero-padded."""
    return f"{root}/{set_name}/{year}-{month:02d}.parquet"


def month_paths(root: str, set_name: str, months: Months) -> list[str]:
    if set_name not in TRIP_MONTHS:
        raise ValueError(f"set must be one of {', '.join(TRIP_MONTHS)}, got {set_name!r}")
    return [month_path(root, set_name, y, m) for y, listed in months.items() for m in listed]


def read_trips(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan of one or more paths or globs, optionally with an imposed schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly weather, matched to the declared columns by header name."""
    return _read_named_csv(spark, path, WEATHER_COLUMN_TYPES)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return _read_named_csv(spark, path, ZONE_COLUMN_TYPES)


def _read_named_csv(spark: SparkSession, path: str, column_types: dict[str, str]) -> DataFrame:
    # Provider files carry more columns than are used and in their own order, so
    # columns are picked by header name; only those picked are parsed and cast.
    return conform_schema(spark.read.csv(path, header=True), struct_of(column_types))


def integrate_months(
    spark: SparkSession,
    landing: str,
    raw: str,
    set_name: str,
    months: Months,
    schema: StructType = TRIP_SCHEMA,
    clustered_by: str | None = None,
) -> str:
    """Conform landing months to one schema and write them to the raw layer.

    Months of equal physical schema share a scan; the scans are unioned and
    written at once, partitioned by set, year and month. No row is shuffled:
    every task writes the month it reads. Returns the raw path.

    With ``clustered_by``, say the pickup, rows are dealt by ranges of month and that
    column and sorted by it, one shuffle for good: later conditions on the column
    skip the files and row groups outside them. Ranges hold about as many rows each,
    so a month and a hot day are split over several tasks.
    """
    paths = month_paths(landing, set_name, months)
    if not paths:
        raise ValueError("no months given")
    read_schema = inheritable_thread_target(spark)(lambda p: spark.read.parquet(p).schema.json())
    # Schemas are read from the files' footers, several months at a time.
    with ThreadPool(min(len(paths), PARALLEL_FOOTERS)) as pool:
        found = pool.map(read_schema, paths)
    by_schema: dict[str, list[str]] = {}
    for path, text in zip(paths, found):
        by_schema.setdefault(text, []).append(path)
    merged = None
    for paths in by_schema.values():
        scan = spark.read.parquet(*paths)
        file_month = [
            F.regexp_extract("_metadata.file_path", MONTH_FILE, part).try_cast("int").alias(name)
            for part, name in ((1, "year"), (2, "month"))
        ]
        # The month comes from the file's path, which is not a column of the table.
        tagged = scan.select("*", *file_month)
        month_schema = StructType(
            [*schema.fields, tagged.schema["year"], tagged.schema["month"]]
        )
        conformed = conform_schema(tagged, month_schema)
        merged = conformed if merged is None else merged.unionByName(conformed)
    if clustered_by:
        merged = merged.repartitionByRange("year", "month", clustered_by)
        merged = merged.sortWithinPartitions("year", "month", clustered_by)
    write_table(
        merged.withColumn("set_name", F.lit(set_name)),
        raw,
        "set_name",
        "year",
        "month",
        rebuild=False,
    )
    return raw


def write_table(df: DataFrame, path: str, *partition_columns: str, rebuild: bool = True) -> None:
    """Overwrite a Parquet table with as many writers as ``df`` has partitions.

    A rebuilt table holds nothing but ``df``. Without ``rebuild``, only the
    partitions present in ``df`` are replaced and the others stay.
    """
    writer = df.write.mode("overwrite").partitionBy(*partition_columns)
    writer.option("partitionOverwriteMode", "static" if rebuild else "dynamic").parquet(path)


def write_by_borough(df: DataFrame, path: str, *outer: str, rebuild: bool = True) -> None:
    """One directory per borough, below one per ``outer`` value, in a single job.

    Boroughs that ``df`` lacks are gone afterwards; without ``rebuild`` they stay
    as they were, and those in ``df`` are replaced.

    Rows are rebalanced by the partition columns first: each directory gets files
    of the advisory partition size, a small borough one, and a borough holding
    most rows is split over many tasks.
    """
    columns = [*outer, "Borough"]
    write_table(df.hint("rebalance", *columns), path, *columns, rebuild=rebuild)


def read_boroughs(
    spark: SparkSession,
    path: str,
    boroughs: Iterable[str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Per-borough table; a list of boroughs prunes the directories read."""
    table = read_trips(spark, path, schema=schema)
    return table if boroughs is None else table.where(F.col("Borough").isin(list(boroughs)))


def read_boroughs_of(
    spark: SparkSession, path: str, places: DataFrame, schema: StructType | None = None
) -> DataFrame:
    """Rows of the boroughs that ``places`` has, say a part of the zone table.

    The boroughs are found when the query runs: they are broadcast to the join and
    prune the directories that the scan opens, without a list in the driver. Spark
    does so where ``places`` is cut down by a condition.
    """
    boroughs = places.select("Borough")
    return read_trips(spark, path, schema=schema).join(F.broadcast(boroughs), "Borough", "left_semi")
