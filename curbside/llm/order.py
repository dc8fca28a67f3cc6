"""Places of rows in an order over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from curbside.operators.joins import lookup_join
from curbside.workspace import staged

_LOCAL_BITS = 33  # Fixed value: bits that monotonically_increasing_id gives to a task's own rows.


def numbered(df: DataFrame, within: str, order: list[str], at: str = "at") -> DataFrame:
    """``df`` with the place ``at``, from 0, of each row among those of its ``within``.

    Rows are dealt by ranges of the whole order and numbered by the tasks that
    sorted them. The numbers before each task, one per task and value of
    ``within``, are added after, so a value that holds most rows is split like any
    other. The numbered rows are written before the numbers are used.
    """
    keys = [within, *order]
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    local = F.monotonically_increasing_id()
    ruled = staged(
        sorted_rows.select("*", F.shiftright(local, _LOCAL_BITS).alias("_task"), local.alias("_local")), "ordered"
    )
    # One row per task and value: a task's last value may begin in it, all others end in it.
    runs = ruled.groupBy(within, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_local").alias("_first"))
    earlier = Window.partitionBy(within).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    runs = runs.select(within, "_task", (before - F.col("_first")).alias("_shift"))
    placed = lookup_join(ruled, staged(runs, "ordered-runs"), [within, "_task"])
    return placed.withColumn(at, F.col("_local") + F.col("_shift")).drop("_task", "_local", "_shift")
