"""Landing months taken in as they change.

``tables.integrate_months`` conforms every month that it is given. Here a manifest of
what was taken in, file by file with length and time, lies beside the raw table. A
run lists the landing folders, compares, and conforms only months whose files
differ; each replaces its own partition and no other. The manifest is published after
the months are written: a run lost in between is simply done again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from curbside.sources import tables
from curbside.sources.publication import current_version, publish_table, read_published
from curbside.sources.schema import TRIP_SCHEMA

_MANIFEST = "set_name string, year int, month int, file string, length long, modified long"


def landed_files(spark: SparkSession, landing: str, set_name: str, months: tables.Months) -> list[tuple]:
    """Rows of the manifest for the files that lie there now: a few per month, listed by the driver."""
    listed = []
    named = [(y, m) for y, own in months.items() for m in own]
    for (year, month), path in zip(named, tables.month_paths(landing, set_name, months)):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(place):
            raise FileNotFoundError(f"month {year}-{month:02d} has not landed: {path}")
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if status.isFile() and not name.startswith(("_", ".")):
                listed.append((set_name, year, month, name, status.getLen(), status.getModificationTime()))
    return listed


def read_manifest(spark: SparkSession, raw: str) -> DataFrame:
    path = f"{raw}/_landed"
    if current_version(spark, path) is None:
        return spark.createDataFrame([], _MANIFEST)
    return read_published(spark, path)


def changed_months(known: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows (set_name, year, month) whose files are not those of the manifest."""
    fields = landed.columns
    one_sided = landed.exceptAll(known.select(*fields)).unionByName(known.select(*fields).exceptAll(landed))
    return one_sided.select("set_name", "year", "month").distinct()


def take_in_months(
    spark: SparkSession,
    landing: str,
    raw: str,
    set_name: str,
    months: tables.Months,
    schema: StructType = TRIP_SCHEMA,
) -> list[tuple[int, int]]:
    """Conform the months that changed since the last run and return them as (year, month).

    Months that were taken in before and are not asked for stay as they are.
    """
    tables.month_paths(landing, set_name, months)  # refuses unknown sets
    landed = spark.createDataFrame(landed_files(spark, landing, set_name, months), _MANIFEST)
    known = read_manifest(spark, raw)
    asked = spark.createDataFrame([(set_name, y, m) for y, own in months.items() for m in own], "set_name string, year int, month int")
    of_asked = known.join(F.broadcast(asked), ["set_name", "year", "month"], "left_semi")
    # At most one row per month that was asked for.
    changed = sorted((r["year"], r["month"]) for r in changed_months(of_asked, landed).collect())
    if not changed:
        return []
    chosen: tables.Months = {}
    for year, month in changed:
        chosen.setdefault(year, []).append(month)
    tables.integrate_months(spark, landing, raw, set_name, chosen, schema)
    others = known.join(F.broadcast(asked), ["set_name", "year", "month"], "left_anti").select(*landed.columns)
    publish_table(others.unionByName(landed), f"{raw}/_landed")
    return changed
