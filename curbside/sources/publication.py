"""Tables replaced as a whole or not at all.

A plain overwrite removes the old files before the new ones are complete; a job lost
in between leaves a table of neither. Here every version is written beside the
others, in a folder of its own, and becomes the table by one step: a pointer file is
moved over the old one. Readers follow the pointer, so they see the old version
whole until then and the new one whole after it. A writer that fails leaves the
pointer as it was, and the folder it began is dropped by the next one that succeeds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from curbside.sources.tables import read_trips, write_table

_POINTER = "_current"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the version that readers see, or None before the first."""
    files, pointer = _files(spark, path), _path(spark, path, _POINTER)
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Move a new pointer over the old one, which file systems do in one step."""
    files, fresh = _files(spark, path), _path(spark, path, f"_next-{version}")
    stream = files.create(fresh, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    moved = spark.sparkContext._gateway.new_array(options, 1)
    moved[0] = options.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    context.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration()).rename(
        files.makeQualified(fresh), files.makeQualified(_path(spark, path, _POINTER)), moved
    )


def publish_table(df: DataFrame, path: str, *partition_columns: str) -> str:
    """Replace the table at ``path`` by ``df``; ``df`` may read the table itself. Returns the version."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    write_table(df, f"{path}/{version}", *partition_columns)
    before = current_version(spark, path)
    _point_to(spark, path, version)
    _drop_others(spark, path, {version, before})
    return version


def _drop_others(spark: SparkSession, path: str, kept: set) -> None:
    files = _files(spark, path)
    for status in files.listStatus(_path(spark, path)):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in kept:
            files.delete(status.getPath(), True)


def read_published(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version; a frame keeps the version it was made of."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing was published at {path}")
    return read_trips(spark, f"{path}/{version}", schema=schema)
