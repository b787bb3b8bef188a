"""Roll-ups (AGG-1..9) at hour or day grain.

Scale design: every aggregate here is *mergeable* — sums, counts, maxima and
per-label counts — so Spark runs it as partial (map-side) + final
HashAggregate inside whole-stage codegen, and hot keys collapse before the
shuffle. Messages are scanned once into symbol-hour partials; the symbol-hour
sentiment (AGG-2), the market-hour social roll-up (AGG-4) and the symbol-day
leaderboard (AGG-5) are re-aggregations of that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.functions.numeric import safe_ratio

GRAINS = ("hour", "day")


def _keys(date_col: str, hour_col: str, grain: str) -> list[str]:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    return [date_col] if grain == "day" else [date_col, hour_col]


def _avg(s: str, n: str, unit: int = 1) -> Column:
    """sum / count from partials (NULL when nothing was counted)."""
    total = s if unit == 1 else f"{s} / {unit}D"
    return F.expr(f"try_divide({total}, CAST(nullif({n}, 0) AS DOUBLE))")


# Scores are summed as whole numbers of their last place, so a mean does not
# depend on the order of summation and a label decided on it is the same for
# any partitioning, batch or stream.
SCORE_UNIT, WEIGHT_UNIT, COMPOUND_UNIT = 10_000, 10, 100_000_000
SCORE_UNITS = f"CAST(round(combined_sentiment_score * {SCORE_UNIT}) AS BIGINT)"
WEIGHT_UNITS = f"CAST(round(influence_score * {WEIGHT_UNIT}) AS BIGINT)"
COMPOUND_UNITS = f"CAST(round(sentiment_compound * {COMPOUND_UNIT}) AS BIGINT)"


# --- ticks (AGG-1, AGG-6) -----------------------------------------------------

def _exprs(named: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(n) for n, e in named.items()]


# Most frequent direction, ties -> smallest value (bearish < bullish <
# neutral), NULL when the group has no direction: equal to the ordered-set
# MODE() WITHIN GROUP (ORDER BY price_direction) over the closed value set.
DOMINANT_SQL = ("CASE WHEN _n_bear > 0 AND _n_bear >= _n_bull AND _n_bear >= _n_neut THEN 'bearish' "
                "WHEN _n_bull > 0 AND _n_bull >= _n_neut THEN 'bullish' "
                "WHEN _n_neut > 0 THEN 'neutral' END")


# Mergeable partials: each column's total over groups is a sum, a least or a
# greatest value, so partials of any grain or batch add up to a coarser one.
TICK_PARTIALS = {
    "n": ("sum", "count(1)"),
    "sum_price": ("sum", "sum(price)"), "n_price": ("sum", "count(price)"),
    "max_price": ("max", "max(price)"), "min_price": ("min", "min(price)"),
    "sum_change": ("sum", "sum(change_pct)"), "n_change": ("sum", "count(change_pct)"),
    "sum_magnitude": ("sum", "sum(change_magnitude)"), "n_magnitude": ("sum", "count(change_magnitude)"),
    "_n_bear": ("sum", "count_if(price_direction = 'bearish')"),
    "_n_bull": ("sum", "count_if(price_direction = 'bullish')"),
    "_n_neut": ("sum", "count_if(price_direction = 'neutral')"),
}


def _merged(partials: DataFrame, keys: list, columns: dict) -> DataFrame:
    return partials.groupBy(*keys).agg(*[F.expr(f"{how}({c})").alias(c) for c, (how, _) in columns.items()])


def tick_partials(stg_prices: DataFrame) -> DataFrame:
    """One scan of ticks -> mergeable partials at (symbol, date, hour); both
    grains of the price roll-up are read from them."""
    return stg_prices.groupBy("symbol", "trade_date", "trade_hour").agg(
        *_exprs({c: e for c, (_, e) in TICK_PARTIALS.items()}))


def price_rollup(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """AGG-1 and AGG-6 from partials: per symbol and bucket."""
    keys = ["symbol"] + _keys("trade_date", "trade_hour", grain)
    p = _merged(partials, keys, TICK_PARTIALS)
    return p.select(
        *keys,
        _avg("sum_price", "n_price").alias("avg_price"), "max_price", "min_price",
        _avg("sum_change", "n_change").alias("avg_change_pct"),
        _avg("sum_magnitude", "n_magnitude").alias("avg_volatility"),
        F.col("n").alias("price_tick_count"),
        F.expr(DOMINANT_SQL).alias("dominant_direction"),
    )


def tick_rollup(stg_prices: DataFrame, grain: str = "hour", mode_impl: str = "counts") -> DataFrame:
    """Per symbol and bucket: avg/max/min price, avg change, avg volatility,
    tick count and the dominant direction, straight from the ticks.

    ``mode_impl="counts"`` (default) counts the three directions inside the
    codegen'd HashAggregate and picks the winner; ``"mode"`` uses Spark's
    deterministic ``mode`` (ObjectHashAggregate, may fall back to sort).
    """
    keys = ["symbol"] + _keys("trade_date", "trade_hour", grain)
    aggs = _exprs({
        "avg_price": "avg(price)",
        "max_price": "max(price)",
        "min_price": "min(price)",
        "avg_change_pct": "avg(change_pct)",
        "avg_volatility": "avg(change_magnitude)",
        "price_tick_count": "count(1)",
    })
    if mode_impl == "mode":
        return stg_prices.groupBy(*keys).agg(*aggs, F.mode(F.col("price_direction"), True).alias("dominant_direction"))
    counts = {c: e for c, (_, e) in TICK_PARTIALS.items() if c.startswith("_n_")}
    out = stg_prices.groupBy(*keys).agg(*aggs, *_exprs(counts))
    return out.withColumn("dominant_direction", F.expr(DOMINANT_SQL)).drop(*counts)


# --- messages (AGG-2, AGG-4, AGG-5, AGG-7, AGG-8, AGG-9) ------------------------

PARTIAL_SUMS = ["n", "sum_score", "n_score", "sum_infl", "n_infl",
                "n_bullish", "n_bearish", "n_neutral", "sum_wx"]


def message_partials(stg_sent: DataFrame) -> DataFrame:
    """One scan of messages -> mergeable partials at (symbol, date, hour)."""
    return stg_sent.groupBy("symbol", "sentiment_date", "sentiment_hour").agg(*_exprs({
        "n": "count(1)",
        "sum_score": f"sum({SCORE_UNITS})",
        "n_score": "count(combined_sentiment_score)",
        "sum_infl": f"sum({WEIGHT_UNITS})",
        "n_infl": "count(influence_score)",
        "n_bullish": "count_if(final_sentiment = 'bullish')",
        "n_bearish": "count_if(final_sentiment = 'bearish')",
        "n_neutral": "count_if(final_sentiment = 'neutral')",
        "sum_wx": f"sum({SCORE_UNITS} * {WEIGHT_UNITS})",
        "max_followers": "max(user_followers)",
    }))


def merge_partials(partials: DataFrame, keys: list) -> DataFrame:
    """Re-aggregate partials to a coarser grain (all columns merge exactly)."""
    return partials.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in PARTIAL_SUMS],
        F.max("max_followers").alias("max_followers"),
    )


def weighted_score(sum_wx: str = "sum_wx", sum_w: str = "sum_infl") -> Column:
    """AGG-7: sum(score * w) / NULLIF(sum(w), 0); a NULL score still adds its
    weight to the denominator."""
    return F.expr(f"try_divide({sum_wx} / {SCORE_UNIT * WEIGHT_UNIT}D, nullif({sum_w} / {WEIGHT_UNIT}D, 0D))")


def symbol_sentiment(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """AGG-2 at the reference grain (raw symbol, date[, hour])."""
    keys = ["symbol"] + _keys("sentiment_date", "sentiment_hour", grain)
    return finalize_symbol_sentiment(merge_partials(partials, keys), keys)


def finalize_symbol_sentiment(p: DataFrame, keys: list[str]) -> DataFrame:
    return p.select(
        *keys,
        F.col("n").alias("message_count"),
        _avg("sum_score", "n_score", SCORE_UNIT).alias("avg_sentiment_score"),
        _avg("sum_infl", "n_infl", WEIGHT_UNIT).alias("avg_influence"),
        F.col("n_bullish").alias("bullish_count"),
        F.col("n_bearish").alias("bearish_count"),
        F.col("n_neutral").alias("neutral_count"),
        weighted_score().alias("weighted_sentiment_score"),
    )


def social_rollup(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """AGG-4: market-wide social roll-up per date[, hour]."""
    keys = _keys("sentiment_date", "sentiment_hour", grain)
    p = merge_partials(partials, keys)
    return p.select(
        *keys,
        F.col("n").alias("total_messages"),
        _avg("sum_score", "n_score", SCORE_UNIT).alias("avg_social_sentiment"),
        _avg("sum_infl", "n_infl", WEIGHT_UNIT).alias("avg_influence"),
    )


def leaderboard_rollup(partials: DataFrame) -> DataFrame:
    """AGG-5: per symbol and day."""
    p = merge_partials(partials, ["symbol", "sentiment_date"])
    return p.select(
        "symbol",
        F.col("sentiment_date").alias("date"),
        F.col("n").alias("total_messages"),
        _avg("sum_score", "n_score", SCORE_UNIT).alias("avg_sentiment"),
        _avg("sum_infl", "n_infl", WEIGHT_UNIT).alias("avg_influence"),
        F.col("max_followers"),
        F.col("n_bullish").alias("bullish_msgs"),
        F.col("n_bearish").alias("bearish_msgs"),
        safe_ratio("n_bullish", "n", 4).alias("bullish_pct"),
        weighted_score().alias("weighted_score"),
    )


# --- news (AGG-3) -----------------------------------------------------------

NEWS_PARTIALS = {
    "n": ("sum", "count(1)"),
    "sum_compound": ("sum", f"sum({COMPOUND_UNITS})"), "n_compound": ("sum", "count(sentiment_compound)"),
    "high_impact_count": ("sum", "count_if(is_high_impact)"),
    "strong_positive_news": ("sum", "count_if(sentiment_strength = 'strong_positive')"),
    "strong_negative_news": ("sum", "count_if(sentiment_strength = 'strong_negative')"),
}


def news_partials(stg_news: DataFrame) -> DataFrame:
    return stg_news.groupBy("publish_date", "publish_hour").agg(*_exprs({c: e for c, (_, e) in NEWS_PARTIALS.items()}))


def news_rollup(partials: DataFrame, grain: str = "hour") -> DataFrame:
    """AGG-3 from :func:`news_partials`."""
    keys = _keys("publish_date", "publish_hour", grain)
    p = _merged(partials, keys, NEWS_PARTIALS)
    return p.select(*keys, F.col("n").alias("article_count"), _avg("sum_compound", "n_compound", COMPOUND_UNIT).alias("avg_news_sentiment"),
                    "high_impact_count", "strong_positive_news", "strong_negative_news")
