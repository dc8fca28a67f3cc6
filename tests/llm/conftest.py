from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Clashes with columns that operators make for themselves.
        T.StructField("score", T.StringType()),
        T.StructField("root", T.StringType()),
        T.StructField("n", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, lang, source) of the smallest table."""
    return duckdb.sql(
        f"select doc_id, text, lang, source from '{SMALL}/documents.parquet' order by doc_id"
    ).fetchall()


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]), with further columns of clashing names."""

    def make(rows, partitions=3):
        full = [(*r, *(None,) * (4 - len(r)), 0, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    long = "the of and to " * 40_000
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", "a"),
        (4, "one", "en", None),
        (5, "one two three four five six seven", "en", "a"),
        (5, "one two three four five six seven", "en", "a"),
        (6, "one two three four five six seven", None, "b"),
        (None, "one two three four five six seven", "en", "b"),
        (7, long, "en", "b"),
        (8, long, "en", None),
        (9, "x" * 300_000, "de", "c"),
        (10, "\n" * 1_000, "de", "c"),
        (11, "日本語 のテキスト é🤦🏼 <|endoftext|> 12 &&&", "ja", "c"),
    ]
