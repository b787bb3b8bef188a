"""Marts on hand-made edge rows: one-sided hours, NULL dates, zero weights."""

import datetime as dt

from pyspark.sql import functions as F

from sentimart.operators import rollups as G
from sentimart.plans import marts as M

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _stg_sent(spark, rows):
    return spark.createDataFrame(rows, "symbol string, sentiment_date date, sentiment_hour int, "
                                       "combined_sentiment_score double, influence_score double, "
                                       "final_sentiment string, user_followers int")


def _stg_news(spark, rows):
    return spark.createDataFrame(rows, "publish_date date, publish_hour int, sentiment_compound double, "
                                       "is_high_impact boolean, sentiment_strength string")


def _stg_prices(spark, rows):
    return spark.createDataFrame(rows, "symbol string, trade_date date, trade_hour int, price double, "
                                       "change_pct double, change_magnitude double, price_direction string")


def test_mood_full_outer_with_null_keys(spark):
    sent = _stg_sent(spark, [("BTC.X", D1, 1, 0.4, 1.0, "bullish", 5),
                             ("BTC.X", None, None, -0.4, 1.0, "bearish", 5)])
    news = _stg_news(spark, [(D1, 2, 0.6, True, "strong_positive"),
                             (None, None, -0.6, True, "strong_negative")])
    out = M.market_mood(G.news_partials(news), G.message_partials(sent), "hour").orderBy("date", "hour", "article_count").collect()
    got = [(r["date"], r["hour"], r["article_count"], r["social_message_count"], r["market_mood_score"],
            r["market_mood_label"]) for r in out]
    # NULL keys never match: two separate undated rows survive; hours 1 and 2 stay one-sided
    assert sorted(got, key=str) == sorted([
        (None, None, None, 1, -0.2, "fear"),
        (None, None, 1, None, -0.3, "fear"),
        (D1, 1, None, 1, 0.2, "greed"),
        (D1, 2, 1, None, 0.3, "greed"),
    ], key=str)


def test_weight_sum_zero_and_null_score(spark):
    sent = _stg_sent(spark, [("ETH.X", D1, 3, 0.5, 0.0, "bullish", 1),
                             ("ETH.X", D1, 3, None, 0.0, "neutral", 1),
                             ("SOL.X", D1, 3, None, 1.0, "neutral", 1),
                             ("SOL.X", D1, 3, 0.5, 1.0, "bullish", 1)])
    out = {r["symbol"]: r for r in G.symbol_sentiment(G.message_partials(sent)).collect()}
    assert out["ETH.X"]["weighted_sentiment_score"] is None      # sum(w) = 0
    assert out["SOL.X"]["weighted_sentiment_score"] == 0.25     # NULL score keeps its weight
    assert out["SOL.X"]["avg_sentiment_score"] == 0.5           # AVG ignores NULL


def test_price_sentiment_key_normalisation(spark):
    prices = _stg_prices(spark, [("BTCUSDT", D1, 1, 10.0, 1.0, 1.0, "bullish"),
                                 ("ETHUSDT", D1, 1, 10.0, -1.0, 1.0, "bearish")])
    sent = _stg_sent(spark, [("BTC.X", D1, 1, 0.5, 1.0, "bullish", 5),
                             ("BTC", D1, 1, 0.1, 1.0, "neutral", 5),     # normalises onto the same pair
                             ("AAPL", D1, 1, 0.5, 1.0, "bullish", 5)])
    p = G.message_partials(sent)
    norm = {r["symbol"]: r for r in M.price_sentiment(G.tick_partials(prices), p, "hour", True).collect()}
    assert norm["BTCUSDT"]["sentiment_message_count"] == 2          # merged, grain stays unique
    assert norm["BTCUSDT"]["sentiment_price_agreement"] is True
    assert norm["ETHUSDT"]["sentiment_message_count"] is None
    raw = {r["symbol"]: r for r in M.price_sentiment(G.tick_partials(prices), p, "hour", False).collect()}
    # raw concatenation: BTC.X -> BTC.XUSDT never matches; only the plain "BTC" row does
    assert raw["BTCUSDT"]["sentiment_message_count"] == 1
    assert raw["ETHUSDT"]["sentiment_message_count"] is None
    assert raw["BTCUSDT"]["sentiment_price_agreement"] is True


def test_dominant_direction_ties(spark):
    rows = [("BTCUSDT", D1, 1, 1.0, 1.0, 1.0, d) for d in ("bullish", "bearish")] + \
           [("BTCUSDT", D1, 2, 1.0, 1.0, 1.0, d) for d in ("neutral", "bullish")] + \
           [("BTCUSDT", D1, 3, 1.0, 1.0, 1.0, d) for d in ("neutral", "neutral", "bearish")] + \
           [("BTCUSDT", D2, 1, 1.0, 1.0, 1.0, None)]
    df = _stg_prices(spark, rows)
    counts = {(r["trade_date"], r["trade_hour"]): r["dominant_direction"]
              for r in G.tick_rollup(df, "hour", "counts").collect()}
    modes = {(r["trade_date"], r["trade_hour"]): r["dominant_direction"]
             for r in G.tick_rollup(df, "hour", "mode").collect()}
    assert counts == {(D1, 1): "bearish", (D1, 2): "bullish", (D1, 3): "neutral", (D2, 1): None}
    assert counts == modes


def test_leaderboard_rank_and_order(spark):
    sent = _stg_sent(spark, [("A", D1, 1, 0.5, 1.0, "bullish", 10), ("B", D1, 1, -0.5, 1.0, "bearish", 20),
                             ("C", D1, 1, 0.2, 0.0, "bullish", 5), ("A", D2, 1, 0.1, 1.0, "neutral", 1)])
    lb = M.leaderboard(G.message_partials(sent))
    rows = M.leaderboard_sorted(lb).collect()
    assert [(r["symbol"], r["date"]) for r in rows] == [("A", D1), ("A", D2), ("B", D1), ("C", D1)]
    ranks = {(r["symbol"], r["date"]): r["daily_rank"] for r in rows}
    assert ranks == {("A", D1): 1, ("B", D1): 2, ("C", D1): 3, ("A", D2): 1}
    top = M.leaderboard_top(lb, 2).collect()
    assert [r["symbol"] for r in top] == ["A", "A"]
    assert rows[0]["bullish_pct"] == 1.0 and rows[0]["max_followers"] == 10


def test_dashboard_left_join_drops_mood_only_hours(spark):
    prices = _stg_prices(spark, [("BTCUSDT", D1, 1, 10.0, 1.0, 1.0, "bullish")])
    sent = _stg_sent(spark, [("BTC.X", D1, 5, 0.5, 1.0, "bullish", 5)])
    news = _stg_news(spark, [(D1, 1, 0.6, True, "strong_positive")])
    p, prices, news = G.message_partials(sent), G.tick_partials(prices), G.news_partials(news)
    dash = M.dashboard(M.price_sentiment(prices, p), M.market_mood(news, p)).collect()
    assert len(dash) == 1
    r = dash[0]
    assert r["hour"] == 1 and r["news_article_count"] == 1 and r["market_mood_score"] == 0.3
    assert r["weighted_sentiment_score"] is None and r["composite_signal"] == "mild_buy_signal"
    day = M.dashboard(M.price_sentiment(prices, p, "day"), M.market_mood(news, p, "day"), "day").collect()
    assert len(day) == 1 and "hour" not in day[0].asDict()
    assert day[0]["weighted_sentiment_score"] == 0.5 and day[0]["composite_signal"] == "strong_buy_signal"


def test_partials_equal_direct_aggregation(spark):
    from sentimart.plans.inputs import staged
    from conftest import SMALL
    st = staged(spark, SMALL).sentiment
    direct = (st.groupBy("sentiment_date").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("combined_sentiment_score").alias("s"))
              .orderBy("sentiment_date").collect())
    merged = (G.merge_partials(G.message_partials(st), ["sentiment_date"])
              .orderBy("sentiment_date").collect())
    assert [r["n"] for r in direct] == [r["n"] for r in merged]
    assert all(abs(a["s"] - b["sum_score"] / G.SCORE_UNIT) < 1e-9 for a, b in zip(direct, merged))
