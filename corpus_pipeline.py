"""Corpus preparation over ``documents``: five stages, each written as Parquet and read again before the next.

1. quality rules     documents that fail the rules go
2. simhash           of near-duplicates the document with the smallest id stays
3. personal data     spans are replaced by their kind
4. mixing            documents are drawn until each source has its share, some several times
5. byte-level BPE    token ids, decoded again as a check

All but the last return the columns of ``documents``. Every stage works on all rows of the one before.

A null text is an empty one throughout and stays null until it is encoded; rows without an id are rows like others. Repeated rows are exact
copies, of which one stays. An empty table passes through all stages as one. Other columns are carried, whatever their names; a text of any length is worked on
whole, by one task.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from regional_balance.llm import bpe, mixing, pii, quality_rules, simhash
from regional_balance.llm.common import read, store

#: The estimates and draws behind the stages have no SQL equivalent; tests compare the stages with plain Python.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, width=4, distance=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs, threshold=0.5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, seed=7, shards=64, blocks_per_shard=64)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids) for every row."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(docs, ranks, pattern, carry=["lang", "source"], ids="ids")


STAGES = [
    ("quality_rules", quality),
    ("simhash", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
