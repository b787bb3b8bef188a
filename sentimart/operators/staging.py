"""Staging projections over silver (PRJ-4..6, FLT-4, FN-9).

The silver predicates are repeated as a guard: the optimiser cannot know
that stored files already satisfy them, and they cost nothing once pushed
into the scan. ``guard=False`` leaves them out, for quality checks on records
as they landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.functions import enrich as R
from sentimart.operators.silver import valid

STG_PRICES_COLUMNS = [
    "symbol", "price", "open", "high", "low", "volume", "price_change",
    "change_pct", "change_magnitude", "price_direction", "is_volatile",
    "ingested_at", "processed_at",
]
STG_SENTIMENT_COLUMNS = [
    "message_id", "symbol", "body", "user_sentiment", "sentiment_compound",
    "sentiment_label", "combined_sentiment_score", "final_sentiment",
    "influence_score", "sentiment_agreement", "user_followers", "user_ideas",
    "created_at", "processed_at",
]
STG_NEWS_COLUMNS = [
    "article_id", "title", "source", "query", "sentiment_compound",
    "sentiment_label", "sentiment_strength", "is_high_impact",
    "published_at", "ingested_at",
]


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def stg_crypto_prices(silver: DataFrame, guard: bool = True) -> DataFrame:
    return (
        (valid(silver, "tick") if guard else silver)
        .select(
            *_present(silver, STG_PRICES_COLUMNS),
            R.price_range().alias("price_range"),
            R.intraday_return().alias("intraday_return"),
            F.to_date("ingested_at").alias("trade_date"),
            F.hour("ingested_at").alias("trade_hour"),
        )
    )


def stg_sentiment(silver: DataFrame, guard: bool = True) -> DataFrame:
    return (
        (valid(silver, "message") if guard else silver)
        .select(
            *_present(silver, STG_SENTIMENT_COLUMNS),
            F.to_date("created_at").alias("sentiment_date"),
            F.hour("created_at").alias("sentiment_hour"),
        )
    )


def stg_news(silver: DataFrame, guard: bool = True) -> DataFrame:
    return (
        (valid(silver, "article") if guard else silver)
        .select(
            *_present(silver, STG_NEWS_COLUMNS),
            F.to_date("published_at").alias("publish_date"),
            F.hour("published_at").alias("publish_hour"),
        )
    )
