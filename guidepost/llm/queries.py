"""The registered queries. Each takes (spark, sf_dir) and applies one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from guidepost.llm.bpe import load_vocabulary, token_digests
from guidepost.llm.chunks import without_repeated_chunks
from guidepost.llm.decontaminate import contamination
from guidepost.llm.language import identify
from guidepost.llm.manifest import verified_manifest
from guidepost.llm.mixing import mix_report
from guidepost.llm.pii import find_personal_data
from guidepost.llm.prefix_trie import conversation_trie
from guidepost.llm.quality_model import quality
from guidepost.llm.quality_rules import judge
from guidepost.llm.simhash import near_duplicates
from guidepost.llm.suffix_dedup import repeated_substrings
from guidepost.llm.toxicity import toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op6_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_chunks(table(spark, sf_dir, "documents")).drop("kept")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_substrings(table(spark, sf_dir, "documents")).drop("spans")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = load_vocabulary(path, public_tokenizers.PATTERN)
    return token_digests(table(spark, sf_dir, "documents"), vocabulary)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_simhash,
        op2_toxicity,
        op3_pii,
        op4_decontamination,
        op5_mixing,
        op6_chunk_dedup,
        op7_suffix_dedup,
        op8_language,
        op9_quality_model,
        op10_quality_rules,
        op11_bpe,
        op12_prefix_trie,
        op13_manifest,
    )
}
