"""Row-level enrichment rules as Column expressions (JVM-side, codegen'd).

Each rule keeps the reference's threshold semantics exactly, including how
NULL falls through a CASE chain to its ELSE branch. Rules are written as
Spark SQL text over column names (``*_sql``) and become a Column through a
single ``F.expr`` call; arguments are column names or SQL expressions.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentimart.functions.numeric import half_up_sql


def cached_expr(fn):
    """Memoise a rule built from column *names*: the unresolved expression
    is immutable and valid for any DataFrame, so it is built once (each
    Column call is a JVM round trip). Calls with Column arguments are built
    fresh."""
    memo = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if all(isinstance(a, (str, bool, int, float)) for a in list(args) + list(kwargs.values())):
            key = (args, tuple(sorted(kwargs.items())))
            if key not in memo:
                memo[key] = fn(*args, **kwargs)
            return memo[key]
        return fn(*args, **kwargs)
    return wrapper

# Fixed values that must equal the reference's for identical results.
TICK_SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT"]
PRICE_DIRECTIONS = ["bullish", "bearish", "neutral"]
FINAL_SENTIMENTS = ["bullish", "bearish", "neutral"]
STRENGTHS = ["strong_positive", "mild_positive", "neutral", "mild_negative", "strong_negative"]
SOCIAL_SYMBOLS = ["BTC.X", "ETH.X", "SOL.X", "AAPL", "TSLA", "NVDA"]
NEWS_QUERIES = [
    "bitcoin cryptocurrency",
    "ethereum crypto",
    "stock market Wall Street",
    "NASDAQ S&P 500",
    "Tesla Apple Nvidia earnings",
]
QUOTE_SUFFIX = "USDT"
SOCIAL_SUFFIX_PATTERN = r"\.X$"
TOPICS = {"tick": "crypto.prices", "message": "market.sentiment", "article": "market.news"}
DATA_SOURCES = {"tick": "binance_ws", "message": "stocktwits", "article": "newsapi"}
UNKNOWN_NEWS_SOURCE = "unknown"
PUBLISH_KEY_CHARS = 50


def _e(text: str) -> Column:
    return F.expr(text)


# --- ticks ------------------------------------------------------------------

def price_direction_sql(x: str = "change_pct") -> str:
    return (f"CASE WHEN {x} > 0.5 THEN 'bullish' WHEN {x} < -0.5 THEN 'bearish' "
            f"ELSE 'neutral' END")


@cached_expr
def price_direction(change_pct: str = "change_pct") -> Column:
    """ENR-1: > 0.5 bullish, < -0.5 bearish, otherwise (incl. NULL) neutral."""
    return _e(price_direction_sql(change_pct))


@cached_expr
def is_volatile(high: str = "high", low: str = "low", open_: str = "open") -> Column:
    """ENR-2: (high - low) / open > 0.02; open 0 or NULL gives FALSE."""
    return _e(f"CASE WHEN try_divide({high} - {low}, nullif({open_}, 0D)) > 0.02 THEN true ELSE false END")


@cached_expr
def change_magnitude(change_pct: str = "change_pct") -> Column:
    """ENR-3: ROUND(ABS(change_pct), 4)."""
    return _e(half_up_sql(f"abs({change_pct})", 4))


@cached_expr
def price_range(high: str = "high", low: str = "low") -> Column:
    """ENR-11a: ROUND(high - low, 6)."""
    return _e(half_up_sql(f"{high} - {low}", 6))


@cached_expr
def intraday_return(price: str = "price", open_: str = "open") -> Column:
    """ENR-11b: ROUND((price - open) / NULLIF(open, 0), 6)."""
    return _e(half_up_sql(f"try_divide({price} - {open_}, nullif({open_}, 0D))", 6))


# --- messages ---------------------------------------------------------------

@cached_expr
def user_label_score(user_sentiment: str = "user_sentiment") -> Column:
    """ENR-5: bullish 1, bearish -1, else 0."""
    x = user_sentiment
    return _e(f"CASE WHEN {x} = 'bullish' THEN 1D WHEN {x} = 'bearish' THEN -1D ELSE 0D END")


@cached_expr
def combined_score(compound: str = "sentiment_compound", label_score: str = "user_label_score") -> Column:
    """ENR-6: ROUND(0.4 * text score + 0.6 * self label, 4)."""
    return _e(half_up_sql(f"{compound} * 0.4D + {label_score} * 0.6D", 4))


@cached_expr
def final_sentiment(score: str = "combined_sentiment_score") -> Column:
    """ENR-7: strict > 0.1 bullish, < -0.1 bearish, else neutral."""
    x = score
    return _e(f"CASE WHEN {x} > 0.1 THEN 'bullish' WHEN {x} < -0.1 THEN 'bearish' ELSE 'neutral' END")


@cached_expr
def influence_score(followers: str = "user_followers") -> Column:
    """ENR-8: follower tiers; NULL followers fall to the lowest tier."""
    x = followers
    return _e(f"CASE WHEN {x} > 10000 THEN 1.0D WHEN {x} > 1000 THEN 0.7D "
              f"WHEN {x} > 100 THEN 0.4D ELSE 0.1D END")


# --- articles ---------------------------------------------------------------

@cached_expr
def sentiment_strength(compound: str = "sentiment_compound") -> Column:
    """ENR-9: inclusive thresholds at +-0.5 and +-0.05."""
    x = compound
    return _e(f"CASE WHEN {x} >= 0.5 THEN 'strong_positive' WHEN {x} >= 0.05 THEN 'mild_positive' "
              f"WHEN {x} <= -0.5 THEN 'strong_negative' WHEN {x} <= -0.05 THEN 'mild_negative' "
              f"ELSE 'neutral' END")


@cached_expr
def is_high_impact(compound: str = "sentiment_compound") -> Column:
    """ENR-10: |score| >= 0.5; NULL gives FALSE."""
    x = compound
    return _e(f"CASE WHEN {x} >= 0.5 OR {x} <= -0.5 THEN true ELSE false END")


# --- text scores (producer side) --------------------------------------------

def polarity_class_sql(x: str = "sentiment_compound") -> str:
    return (f"CASE WHEN {x} >= 0.05 THEN 'positive' WHEN {x} <= -0.05 THEN 'negative' "
            f"ELSE 'neutral' END")


@cached_expr
def polarity_class(compound: str = "sentiment_compound") -> Column:
    """ENR-12: >= 0.05 positive, <= -0.05 negative, else neutral."""
    return _e(polarity_class_sql(compound))


@cached_expr
def label_agreement(user_sentiment: str = "user_sentiment", compound: str = "sentiment_compound") -> Column:
    """ENR-13: self label equals the text class mapped onto bullish/bearish."""
    mapped = f"replace(replace({polarity_class_sql(compound)}, 'positive', 'bullish'), 'negative', 'bearish')"
    return _e(f"{user_sentiment} = {mapped}")


def self_label(basic) -> Column:
    """Social self label: lower-cased ``basic``; absent or NULL -> neutral."""
    return _e(f"coalesce(lower({basic}), 'neutral')")


def article_id(url: str = "url") -> Column:
    """ENR-19: stable id = md5 hex of the URL (empty string when absent)."""
    return _e(f"md5(coalesce({url}, ''))")


# --- symbols ----------------------------------------------------------------

@cached_expr
def tick_key(symbol: str = "symbol", normalize: bool = True) -> Column:
    """Join key of a social symbol on the tick side (JOIN-1).

    ``normalize=True`` strips the social ``.X`` suffix before appending the
    quote currency (BTC.X -> BTCUSDT); ``False`` keeps the reference's raw
    concatenation (BTC.X -> BTC.XUSDT), which never matches a tick.
    """
    s = f"regexp_replace({symbol}, '\\\\.X$', '')" if normalize else symbol
    return _e(f"concat({s}, '{QUOTE_SUFFIX}')")


# --- market mood / composite signal ----------------------------------------

def mood_raw_sql(news: str = "avg_news_sentiment", social: str = "avg_social_sentiment") -> str:
    """ENR-15 before rounding: 0.5 news + 0.5 social, a missing side is 0."""
    return f"(coalesce({news}, 0D) * 0.5D + coalesce({social}, 0D) * 0.5D)"


@cached_expr
def mood_score(news: str = "avg_news_sentiment", social: str = "avg_social_sentiment") -> Column:
    """ENR-15: ROUND(mood, 4)."""
    return _e(half_up_sql(mood_raw_sql(news, social), 4))


@cached_expr
def mood_label(news: str = "avg_news_sentiment", social: str = "avg_social_sentiment") -> Column:
    """ENR-16 on the *unrounded* mood."""
    x = mood_raw_sql(news, social)
    return _e(f"CASE WHEN {x} > 0.15 THEN 'greed' WHEN {x} < -0.15 THEN 'fear' ELSE 'neutral' END")


@cached_expr
def price_agreement(direction: str = "dominant_direction", weighted: str = "weighted_sentiment_score") -> Column:
    """ENR-17: bullish & w > 0 or bearish & w < 0; anything else (NULL too) FALSE."""
    d, w = direction, weighted
    return _e(f"CASE WHEN {d} = 'bullish' AND {w} > 0 THEN true "
              f"WHEN {d} = 'bearish' AND {w} < 0 THEN true ELSE false END")


@cached_expr
def composite_signal(weighted: str = "weighted_sentiment_score", mood: str = "market_mood_score") -> Column:
    """ENR-18: ordered five-way CASE (OR branches and NULL logic kept as is)."""
    w, m = weighted, mood
    return _e(f"CASE WHEN {w} > 0.2 AND {m} > 0.1 THEN 'strong_buy_signal' "
              f"WHEN {w} > 0.1 OR {m} > 0.05 THEN 'mild_buy_signal' "
              f"WHEN {w} < -0.2 AND {m} < -0.1 THEN 'strong_sell_signal' "
              f"WHEN {w} < -0.1 OR {m} < -0.05 THEN 'mild_sell_signal' "
              f"ELSE 'hold_signal' END")
