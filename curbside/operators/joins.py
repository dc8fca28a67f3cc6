"""Joining facts to lookups, with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    MapType,
    StringType,
    StructType,
    UserDefinedType,
)

from curbside.constants import PICKUP
from curbside.functions.calendar import calendar_date, day_text, hour_of_day, hour_slot

# Sizes are of rows as they lie in memory, not of compressed files.
BROADCAST_LIMIT_BYTES = 128 << 20
# Fixed value: bytes counted for a number, and for a text's or list's head.
CELL_BYTES = 16


def _bytes_of(value: Column, kind: DataType) -> Column:
    """Bytes of a value, the lengths of texts and nested values included."""
    head = F.lit(CELL_BYTES).cast("long")
    if isinstance(kind, (StringType, BinaryType)):
        inner = F.octet_length(value).cast("long")
    elif isinstance(kind, ArrayType):
        inner = F.aggregate(
            value, F.lit(0).cast("long"), lambda total, x: total + _bytes_of(x, kind.elementType)
        )
    elif isinstance(kind, MapType):
        pairs = ArrayType(kind.keyType), ArrayType(kind.valueType)
        inner = _bytes_of(F.map_keys(value), pairs[0]) + _bytes_of(F.map_values(value), pairs[1])
    elif isinstance(kind, StructType):
        inner = sum((_bytes_of(value[f.name], f.dataType) for f in kind.fields), F.lit(0).cast("long"))
    elif isinstance(kind, UserDefinedType):  # say, a vector: its text is no shorter than its cells
        inner = F.octet_length(F.to_json(F.struct(value.alias("v")))).cast("long")
    else:
        return head
    return head + F.coalesce(inner, F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    """What the rows take in memory, by a scan of ``df``."""
    cells = [_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    size = F.coalesce(F.sum(sum(cells, F.lit(0).cast("long"))), F.lit(0))
    return df.agg(size.alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return measured_bytes(df) <= limit


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    limit: int = BROADCAST_LIMIT_BYTES,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join of a large table to a lookup (``inner``, ``left`` or ``left_semi``).

    The lookup is always measured, which scans it once; stage one that is dear to
    compute. Up to the limit it is broadcast and the facts are not shuffled. Above,
    both sides are shuffled, and adaptive execution splits the facts of a key
    that holds many of them over tasks. With ``null_safe``, NULL keys match each
    other.
    """
    renamed = {key: f"_lookup_{key}" for key in keys}
    if fits_broadcast(lookup, limit):
        lookup = F.broadcast(lookup.withColumnsRenamed(renamed))
    else:
        lookup = lookup.withColumnsRenamed(renamed).hint("merge")
    same = [
        F.col(key).eqNullSafe(F.col(other)) if null_safe else F.col(key) == F.col(other)
        for key, other in renamed.items()
    ]
    return facts.join(lookup, same, how).drop(*renamed.values())


def join_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with the weather of their pickup hour; ``day`` and ``hour`` come first.

    Trips of hours without weather are dropped, and an hour listed twice doubles
    its trips. The weather's own ``datetime`` is not kept.
    """
    hourly = weather.withColumn("_slot", hour_slot("datetime")).drop("datetime")
    keyed = trips.withColumn("_slot", hour_slot(PICKUP))
    merged = lookup_join(keyed, hourly, ["_slot"])
    return merged.select(
        day_text().alias("day"),
        hour_of_day().alias("hour"),
        *trips.columns,
        *[name for name in hourly.columns if name != "_slot"],
    )


def join_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with the borough of their pickup zone; unknown zones drop out."""
    boroughs = zones.select(F.col("LocationID").alias("pulocationid"), "Borough")
    return lookup_join(trips, boroughs, ["pulocationid"]).select(*trips.columns, "Borough")


def keep_dates(trips: DataFrame, dates: DataFrame, instant: str = PICKUP) -> DataFrame:
    """Trips picked up on one of the dates of a one-column table ``date``."""
    keyed = trips.withColumn("_date", calendar_date(instant))
    wanted = dates.select(F.col("date").alias("_date"))
    return lookup_join(keyed, wanted, ["_date"], "left_semi").drop("_date")
