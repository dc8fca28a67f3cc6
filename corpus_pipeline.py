"""From raw documents to token ids: five operators of ``curbside.llm`` in a row.

Every stage takes the documents its predecessor kept and returns documents of
the same columns; the last returns their token ids. Documents keep their
``doc_id``; the mix may return one twice. Edge cases are the operators': NULL,
empty and very long texts, repeated rows, empty tables and further columns pass
through every stage with the results their docstrings name.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from curbside.llm import bpe_transducer, language_gru, mixing, pii_feistel, shingle_join
from curbside.llm.catalog import PSEUDONYM_KEY
from curbside.workspace import staged


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays unclear, go."""
    return language_gru.keep_known_languages(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document of smallest id stays."""
    return shingle_join.keep_first_of_each_group(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses give way to pseudonyms."""
    return pii_feistel.pseudonymise(docs, PSEUDONYM_KEY)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: never, once or twice."""
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids), one per document of the mix."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe_transducer.encode_documents(docs, path).drop("decoded")


STAGES = [
    ("language", known_languages),
    ("near_copies", one_of_near_copies),
    ("pseudonyms", pseudonyms),
    ("mix", mixed_sources),
    ("tokens", token_ids),
]

# A trained network, similarity components and merges are beyond SQL; tests/llm holds
# every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
