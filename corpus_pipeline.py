"""The corpus preparation pipeline: documents to token ids, in stages.

Each stage takes all that the one before kept. ``run`` writes each result to
the shared folder and reads it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wareloom.llm import bpe, decontaminate, line_dedup, near_dup, quality
from wareloom.llm.common import table
from wareloom.session import stage

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many sites share; documents that lose all their words go."""
    return line_dedup.clean(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every document."""
    ranks, pattern = bpe.read_ranks(public_tokenizers.path(TOKENIZER)), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern)
    return bpe.digests(decoded, "ids")


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_boilerplate),
    ("near_dup", without_copies),
    ("decontaminate", without_benchmark),
    ("tokens", tokens),
]

#: The stages are models, sketches and merges, which SQL cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
