"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sentimart.llm import (
    chat_format,
    decontamination,
    html_extract,
    importance_resampling,
    lexical_search,
    phrases,
    quality_rules,
    secret_scan,
    sharding,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    warc,
)
from sentimart.llm.common import table


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.fingerprint_text().alias("fingerprint"), "component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = [r.name for r in quality_rules.RULES]
    return quality_rules.judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *ratios)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source_mixing.records(table(spark, sf_dir, "documents"))
    return source_mixing.taken(source_mixing.mix(rows)).select("doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.placed(sharding.records(table(spark, sf_dir, "documents")))
    return sharding.numbered(rows).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resampling.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("kept", F.col("kept") & ~F.col("toxic")).drop("toxic")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"), digest=True)


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return chat_format.digests(chat_format.examples(turns))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"), least_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_source_mixing": op4_source_mixing,
    "op5_sharding": op5_sharding,
    "op6_importance_resampling": op6_importance_resampling,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_warc": op11_warc,
    "op12_lexical_search": op12_lexical_search,
    "op13_phrase_mining": op13_phrase_mining,
}
