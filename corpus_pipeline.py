"""The corpus pipeline: five operators of ``sentimart.llm``, one after the other.

Each stage takes what its predecessor kept, as a table read again from disk,
and returns a DataFrame; all but the last return the columns of documents.

1. quality_classifier: documents that importance resampling rejects or finds
   toxic go.
2. simhash_dedup: of each class of near copies the document of the smallest
   doc_id stays.
3. decontamination: documents that leak a benchmark item go.
4. mixing: each document comes as often as the mix of sources takes it
   (not at all, once or twice).
5. sharding: adds the shard of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sentimart.llm import decontamination, importance_resampling, sharding, simhash_dedup, source_mixing
from sentimart.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return importance_resampling.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mixing.repeated(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.placed(docs).select(*[c for c in docs.columns if c != "shard"], "shard")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_near_dedup),
    ("decontamination", benchmark_decontamination),
    ("mixing", mixing),
    ("sharding", shards),
]

#: No SQL for the rows of run(): fingerprints, walks and fitted models are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), release=True)
    return docs
