"""One canonical trip schema for months that disagree about names, order and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from curbside.constants import FLAG_COLUMN, INTEGER_COLUMNS, TRIP_COLUMN_TYPES


TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
}


def struct_of(column_types: dict[str, str]) -> StructType:
    """Schema of ``{name: type name}``; needs no session."""
    return StructType([StructField(name, TYPES[kind]) for name, kind in column_types.items()])


TRIP_SCHEMA = struct_of(TRIP_COLUMN_TYPES)


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def yes_no_flag(flag: Column) -> Column:
    """``Y`` true, ``N`` false, anything else NULL."""
    return F.when(flag == "Y", True).when(flag == "N", False)


def narrow_integers(df: DataFrame, columns: list[str] = INTEGER_COLUMNS) -> DataFrame:
    """The named columns as int; what does not fit an int becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast("int") for name in columns})


def flag_to_boolean(df: DataFrame, column: str = FLAG_COLUMN) -> DataFrame:
    return df.withColumn(column, yes_no_flag(F.col(column)))


def canonical_schema(sample: DataFrame) -> StructType:
    """Schema all months share, taken from one month; runs no job.

    Column names in lower case, identifiers as int, the Y/N flag as boolean and
    every other column as the sample has it.
    """
    lowered = lowercase_columns(sample)
    present = set(lowered.columns)
    integers = [name for name in INTEGER_COLUMNS if name in present]
    fixed = narrow_integers(lowered, integers)
    if FLAG_COLUMN in present and isinstance(lowered.schema[FLAG_COLUMN].dataType, StringType):
        fixed = flag_to_boolean(fixed)
    return fixed.schema


def conform_schema(df: DataFrame, schema: StructType = TRIP_SCHEMA) -> DataFrame:
    """``df`` in the given schema, matched by name without regard to case.

    Absent columns become typed NULLs, extra columns are left out, and a value
    that cannot be cast becomes NULL instead of failing the job.
    """
    source = {field.name.lower(): field for field in df.schema.fields}

    def conformed(target) -> Column:
        found = source.get(target.name.lower())
        if found is None:
            return F.lit(None).cast(target.dataType).alias(target.name)
        value = F.col(f"`{found.name}`")
        if isinstance(target.dataType, BooleanType) and isinstance(found.dataType, StringType):
            return yes_no_flag(value).alias(target.name)
        if found.dataType == target.dataType:
            return value.alias(target.name)
        if isinstance(target.dataType, IntegerType) and isinstance(found.dataType, StringType):
            # Text such as 1.0 is a number but not an integer literal.
            value = value.try_cast("double")
        return value.try_cast(target.dataType).alias(target.name)

    return df.select(*[conformed(target) for target in schema.fields])


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: position, name, type and non-NULL values."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables side by side, matched by lower-cased name.

    ``status`` is ``same``, ``type differs``, ``left only`` or ``right only``.
    """
    sides = []
    for label, df in (("left", left), ("right", right)):
        sides.append(
            schema_rows(df).select(
                F.lower("column_name").alias("column_name"),
                F.col("data_type").alias(f"{label}_type"),
                F.col("non_null").alias(f"{label}_non_null"),
            )
        )
    status = (
        F.when(F.col("right_type").isNull(), "left only")
        .when(F.col("left_type").isNull(), "right only")
        .when(F.col("left_type") == F.col("right_type"), "same")
        .otherwise("type differs")
    )
    both = sides[0].join(sides[1], "column_name", "full").withColumn("status", status)
    return both.fillna(0, ["left_non_null", "right_non_null"])
