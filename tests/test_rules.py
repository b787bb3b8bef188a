"""Enrichment rules at their thresholds, +- epsilon and NULL (FIXTURES §C)."""

from pyspark.sql import functions as F

from sentimart.functions import enrich as R
from sentimart.functions.numeric import half_up, safe_ratio
from sentimart.operators import silver as SV
from sentimart.sources import landing as L


def _eval(spark, values, expr_fn, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr_fn("x")).collect()]


def test_price_direction(spark):
    got = _eval(spark, [0.5, 0.5001, -0.5, -0.5001, None, 0.0], R.price_direction)
    assert got == ["neutral", "bullish", "neutral", "bearish", "neutral", "neutral"]


def test_final_sentiment_strict(spark):
    got = _eval(spark, [0.1, 0.1001, -0.1, -0.1001, None], R.final_sentiment)
    assert got == ["neutral", "bullish", "neutral", "bearish", "neutral"]


def test_influence_tiers(spark):
    got = _eval(spark, [100, 101, 1000, 1001, 10000, 10001, None], R.influence_score, "int")
    assert got == [0.1, 0.4, 0.4, 0.7, 0.7, 1.0, 0.1]


def test_strength_inclusive(spark):
    got = _eval(spark, [0.5, 0.05, 0.0499, -0.05, -0.5, None], R.sentiment_strength)
    assert got == ["strong_positive", "mild_positive", "neutral", "mild_negative", "strong_negative", "neutral"]


def test_high_impact(spark):
    assert _eval(spark, [0.5, -0.5, 0.4999, None], R.is_high_impact) == [True, True, False, False]


def test_polarity_and_agreement(spark):
    assert _eval(spark, [0.05, -0.05, 0.0, None], R.polarity_class) == ["positive", "negative", "neutral", "neutral"]
    df = spark.createDataFrame([("bullish", 0.3), ("bearish", -0.3), ("neutral", 0.0), ("bullish", 0.0),
                                (None, 0.2)], "u string, c double")
    got = [r[0] for r in df.select(R.label_agreement("u", "c")).collect()]
    assert got == [True, True, True, False, None]


def test_half_up_and_ratio(spark):
    assert _eval(spark, [0.00005, -0.00005, 1.23445, None], lambda c: half_up(c, 4)) == [0.0001, -0.0001, 1.2345, None]
    df = spark.createDataFrame([(1, 3), (0, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b", 4)).collect()] == [0.3333, None, None]


def test_volatile_open_zero_and_rounding_order(spark):
    rows = [("BTCUSDT", 100.0, 0.0, 101.0, 99.0, 0.5),         # open 0 -> not volatile, no error
            ("BTCUSDT", 100.0, None, 101.0, 99.0, None),      # open NULL
            ("BTCUSDT", 100.0, 100.0, 102.0, 100.0, 0.50004),  # exactly 0.02 -> not volatile; pct rounds to 0.5
            ("BTCUSDT", 100.0, 100.0, 102.000001, 100.0, 0.50005),   # > 0.02; pct rounds to 0.5001
            ("BTCUSDT", 100.0, 100.0, 102.0000004, 100.0, 0.5),      # high rounds to 102.0 first -> 0.02
            ("BTCUSDT", None, 1.0, 1.0, 1.0, 0.0),            # price NULL -> dropped
            ("BTCUSDT", 0.0, 1.0, 1.0, 1.0, 0.0),             # price 0 -> dropped
            ("BTCUSDT", -1.0, 1.0, 1.0, 1.0, 0.0),            # negative -> dropped
            (None, 1.0, 1.0, 1.0, 1.0, 0.0)]                  # symbol NULL -> dropped
    df = spark.createDataFrame(rows, "symbol string, price double, open double, high double, low double, change_pct double")
    out = SV.tick_silver(df).select("is_volatile", "price_direction", "change_pct").collect()
    assert [tuple(r) for r in out] == [(False, "neutral", 0.5), (False, "neutral", None),
                                       (False, "neutral", 0.5), (True, "bullish", 0.5001),
                                       (False, "neutral", 0.5)]


def test_combined_score_threshold(spark):
    # 0.4 * 0.25 + 0.6 * 0 = 0.1 exactly -> neutral (strict)
    df = spark.createDataFrame([("1", "X", 0.25, "neutral", 50), ("2", "X", None, "bullish", None),
                                (None, "X", 0.9, "bullish", 1), ("3", None, 0.9, "bullish", 1)],
                               "message_id string, symbol string, sentiment_compound double, "
                               "user_sentiment string, user_followers int")
    out = SV.message_silver(df).select("combined_sentiment_score", "final_sentiment", "influence_score").collect()
    assert [tuple(r) for r in out] == [(0.1, "neutral", 0.1), (None, "neutral", 0.1)]


def test_mood_and_composite_truth_table(spark):
    rows = [(None, None), (0.3, None), (None, 0.31), (0.0, 0.31), (0.3, -0.3), (None, 0.2), (-0.3, None)]
    df = spark.createDataFrame(rows, "n double, s double")
    got = [tuple(r) for r in df.select(R.mood_score("n", "s"), R.mood_label("n", "s")).collect()]
    assert got == [(0.0, "neutral"), (0.15, "neutral"), (0.155, "greed"), (0.155, "greed"),
                   (0.0, "neutral"), (0.1, "neutral"), (-0.15, "neutral")]
    sig = spark.createDataFrame([
        (0.25, 0.15), (0.25, 0.05), (0.15, -0.5), (None, 0.06), (None, 0.0), (-0.25, -0.15),
        (-0.25, -0.05), (-0.15, 0.0), (None, -0.06), (0.0, None), (None, None), (0.3, None), (-0.3, None),
        (0.05, 0.05)], "w double, m double")
    got = [r[0] for r in sig.select(R.composite_signal("w", "m")).collect()]
    assert got == ["strong_buy_signal", "mild_buy_signal", "mild_buy_signal", "mild_buy_signal",
                   "hold_signal", "strong_sell_signal", "mild_sell_signal", "mild_sell_signal",
                   "mild_sell_signal", "hold_signal", "hold_signal", "mild_buy_signal",
                   "mild_sell_signal", "hold_signal"]


def test_price_agreement_nulls(spark):
    df = spark.createDataFrame([("bullish", 0.1), ("bullish", None), ("bearish", -0.1), ("neutral", 0.5),
                                (None, 0.5), ("bearish", 0.0)], "d string, w double")
    got = [r[0] for r in df.select(R.price_agreement("d", "w")).collect()]
    assert got == [True, False, True, False, False, False]


def test_tick_key(spark):
    df = spark.createDataFrame([("BTC.X",), ("AAPL",), ("SOL.X.X",)], "s string")
    assert [r[0] for r in df.select(R.tick_key("s", True)).collect()] == ["BTCUSDT", "AAPLUSDT", "SOL.XUSDT"]
    assert [r[0] for r in df.select(R.tick_key("s", False)).collect()] == ["BTC.XUSDT", "AAPLUSDT", "SOL.X.XUSDT"]


def test_iso_round_trip(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:07.179575+00:00",), ("",), (None,), ("garbage",)], "t string")
    parsed = df.select(F.try_to_timestamp("t").alias("ts"))
    back = [r[0] for r in parsed.select(L.iso_utc("ts")).collect()]
    assert back == ["2024-01-01T00:00:07.179575+00:00", None, None, None]


def test_lexicon_scorer_negation_and_shares(spark):
    from sentimart.operators.scoring import score_texts
    df = spark.createDataFrame([(1, "good"), (2, "not good"), (3, "not a very big good"),
                                (4, "Très bon, pas mauvais!"), (5, ""), (6, None), (7, "nothing here")],
                               "id long, text string")
    out = {r["id"]: r for r in score_texts(df, ["id"], "text").collect()}
    assert out[1]["sentiment_compound"] > 0 and out[1]["sentiment_pos"] == 1.0
    assert out[2]["sentiment_compound"] < 0 and out[2]["n_tokens"] == 2     # negated within 3 tokens
    assert out[3]["sentiment_compound"] > 0                                  # negator 4 tokens back
    assert out[4]["n_tokens"] == 4 and out[4]["sentiment_compound"] > 0      # accents kept; "pas mauvais" flips
    for i in (5, 6):
        assert (out[i]["n_tokens"], out[i]["sentiment_compound"], out[i]["sentiment_neu"]) == (0, 0.0, 0.0)
    assert out[7]["sentiment_neu"] == 1.0 and out[7]["sentiment_compound"] == 0.0
    r = out[2]
    assert abs(r["sentiment_pos"] + r["sentiment_neg"] + r["sentiment_neu"] - 1.0) < 2e-3
