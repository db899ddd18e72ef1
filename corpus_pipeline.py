"""From raw documents to sharded training text: five stages, each a written table that the next one reads.

1. quality classifier: documents that importance resampling rejects (junk, toxic text) go
2. n-gram Jaccard join: one document of each class of near copies stays, the one with the smallest id
3. benchmark decontamination: documents that hold a benchmark passage, exact or edited, go
4. mixing: sources are brought to their target weights; a document is repeated as often as the mix takes it
5. sharding: every row gets its shard of 24, and the one it would have of 25
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import op2_ngram_join, op4_mixing, op5_decontaminate, op8_sharding, op10_quality
from ledgerlake.llm.common import read, written

SHARDS = 24

#: SQL cannot train the classifier or align passages; the stages are tested against brute force.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_quality.kept(docs, read(spark, sf_dir, "labels"))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_ngram_join.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_mixing.mixed_rows(docs, **op4_mixing.PRODUCTION)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_sharding.assign(docs, F.col("doc_id"), SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify),
    ("ngram_jaccard_join", join_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
