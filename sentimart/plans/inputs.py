"""Canonical inputs for the models, built from the driver's tables.

``parsed_*`` give the bronze shape (parsed record + ``processed_at``);
``staged`` chains silver enrichment and the staging projections. Everything
is lazy: Catalyst sees one plan from the Parquet scan to the model output,
so column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart.operators import silver as SV
from sentimart.operators import staging as ST
from sentimart.sources import fixtures as FX
from sentimart.sources.catalog import read_table


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def parsed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(FX.ticks_from_events(read_table(spark, sf_dir, "events")))


def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(FX.messages_from_events(read_table(spark, sf_dir, "events")))


def parsed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(FX.articles_from_pages(read_table(spark, sf_dir, "pages")))


class Staged:
    """The three staging relations, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def prices(self) -> DataFrame:
        return ST.stg_crypto_prices(SV.tick_silver(parsed_ticks(self.spark, self.sf_dir)))

    @cached_property
    def sentiment(self) -> DataFrame:
        return ST.stg_sentiment(SV.message_silver(parsed_messages(self.spark, self.sf_dir)))

    @cached_property
    def news(self) -> DataFrame:
        return ST.stg_news(SV.article_silver(parsed_articles(self.spark, self.sf_dir)))


def staged(spark: SparkSession, sf_dir: str) -> Staged:
    return Staged(spark, sf_dir)
