"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from curbside.llm import (
    ann_multiprobe,
    bpe_transducer,
    language_gru,
    merkle_manifest,
    mixing,
    pii_feistel,
    quality_crf,
    quality_rules,
    ranked_search,
    shingle_join,
    simhash,
    suffix_dedup,
    token_trie,
)
from curbside.llm.text import table

# Key of the pseudonyms in these queries over invented data; real ones bring their own secret.
PSEUDONYM_KEY = b"invented documents"


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.host_rules(table(spark, sf_dir, "documents"))


def op3_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_token_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_trie.token_counts(table(spark, sf_dir, "documents"), path)


def op5_ann_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann_multiprobe.search(rows, lambda vec_id: vec_id % 100 == 0)


def op6_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_gru.predict_language(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_rates(table(spark, sf_dir, "documents"))


def op8_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.pseudonym_report(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digests(table(spark, sf_dir, "documents"))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe_transducer.encode_digests(table(spark, sf_dir, "documents"), path)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.tampered_check(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_crf": op1_quality_crf,
    "op2_quality_rules": op2_quality_rules,
    "op3_shingle_join": op3_shingle_join,
    "op4_token_trie": op4_token_trie,
    "op5_ann_multiprobe": op5_ann_multiprobe,
    "op6_language_gru": op6_language_gru,
    "op7_mixing": op7_mixing,
    "op8_pii_feistel": op8_pii_feistel,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_bpe_transducer": op10_bpe_transducer,
    "op11_simhash": op11_simhash,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op2_quality_rules": quality_rules.SQL,
    "op12_merkle_manifest": merkle_manifest.SQL,
    "op13_ranked_search": ranked_search.SQL,
}
