"""Queries over the driver tables: each operator with its production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from regional_balance.llm import (
    alignment,
    bpe,
    conversation_trie,
    fingerprints,
    kneser_ney,
    mixing,
    pii,
    prefix_forest,
    quality_rules,
    simhash,
    suffix_index,
    token_counts,
    token_files,
)
from regional_balance.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(read(spark, sf_dir))


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(read(spark, sf_dir), seed=7, shards=64, blocks_per_shard=64)


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir), width=4, distance=4)


@query("op4_kneser_ney")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return kneser_ney.classify(read(spark, sf_dir), trusted, quantile=0.99)


@query("op5_suffix_index")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.remove_repeats(read(spark, sf_dir), length=400, words=50).drop("kept")


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(read(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(files)


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read(spark, sf_dir))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read(spark, sf_dir), threshold=0.5)


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(read(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@query("op11_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align_tokenizers(read(spark, sf_dir), *paths)


@query("op12_prefix_forest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest_vectors(read(spark, sf_dir, "embeddings"), every=20, k=20)


@query("op13_conversation_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = conversation_trie.turn_lists(read(spark, sf_dir, "conversations"))
    rebuilt = conversation_trie.with_shared_heads(lists, every=5, below=9)
    return conversation_trie.trie_nodes(conversation_trie.keys(rebuilt))
