"""Words, rows in bounded batches and the document table: helpers of the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: what separates words (space and the five ASCII controls 09 to 0D).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_CONTROLS = "\t\n\x0b\x0c\r"

# Text handled at once inside a task. A longer single text is one batch by itself.
BATCH_BYTES = 4 << 20
# Spark's setting for the bytes of a batch on its way to Python; 64 MB where it is not set.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for NULL."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _CONTROLS, " " * len(_CONTROLS))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def crc_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``; NULL keys count as empty text."""
    digits = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.crc32(digits.cast("binary")), F.lit(modulus)).cast("int")


def stretch(text: Column, key: Column, chars: int) -> Column:
    """The text, or of a longer one ``chars`` characters from a place that the key's hash chooses."""
    spare = F.char_length(text) - chars
    start = F.pmod(F.xxhash64(key), F.greatest(spare, F.lit(0)) + 1).cast("int") + 1
    return F.when(spare > 0, F.substring(text, start, F.lit(chars))).otherwise(text)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def map_texts(docs: DataFrame, mapped, schema) -> DataFrame:
    """``docs.mapInArrow(mapped, schema)`` with rows handed over by about ``BATCH_BYTES``.

    Spark closes a batch after 10,000 rows or 64 MB, and an executor holds several
    copies of each task's batch outside its heap. Sets the session's ``ARROW_BYTES``,
    unless the session names a value itself.
    """
    conf = docs.sparkSession.conf
    if conf.get(ARROW_BYTES, None) is None:
        conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return docs.mapInArrow(mapped, schema)


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` (string or binary) holds about ``limit`` bytes."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        start, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
