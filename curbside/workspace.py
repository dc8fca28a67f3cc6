"""Shared-storage folder for staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_path(spark: SparkSession, label: str) -> str:
    """New path under the session's ``spark.checkpoint.dir``.

    A session that names no such folder gets one on the default file system,
    named after the application. Where that file system is the machine's own,
    only a local-mode session may use it: executors of a cluster could not see
    it, so there a missing setting is an error. Paths of one application share
    a folder, which the file system drops when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if _default_scheme(spark) == "file" and spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _default_files(spark).makeQualified(spark._jvm.org.apache.hadoop.fs.Path("/tmp")).toString()
    folder = f"{root.rstrip('/')}/curbside-{spark.sparkContext.applicationId}"
    _drop_at_exit(spark, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _default_files(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())


def _default_scheme(spark: SparkSession) -> str:
    return _default_files(spark).getUri().getScheme()


def _drop_at_exit(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    Cuts lineage so a lost executor costs no recomputation, and gives the
    optimizer the true size of the result.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
