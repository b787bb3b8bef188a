"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables at ``sf_dir`` in full and returns a
lazy DataFrame. Wall-clock columns (``processed_at``, ``updated_at``) are
left out of registered outputs, and floating-point *aggregates* (averages,
weighted means — whose last bits depend on summation order) are presented
rounded to 6 places with the engine-independent HALF_UP form, so a result
is reproducible across partitionings and comparable with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentimart.functions.numeric import half_up
from sentimart.operators import rollups as G
from sentimart.plans import marts as M
from sentimart.plans.inputs import staged
from sentimart.session import ensure_checkpoint_dir, pin_session

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

PRESENTATION_DIGITS = 6


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_session(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


def present(df: DataFrame, cols: list[str], digits: int = PRESENTATION_DIGITS) -> DataFrame:
    """Round order-dependent double aggregates for presentation."""
    return df.withColumns({c: half_up(c, digits) for c in cols if c in df.columns})


AVG_COLUMNS = [
    "avg_price", "avg_change_pct", "avg_volatility", "avg_sentiment_score",
    "weighted_sentiment_score", "avg_influence", "avg_news_sentiment",
    "avg_social_sentiment", "avg_sentiment", "weighted_score",
]


def _present(df: DataFrame) -> DataFrame:
    return present(df, AVG_COLUMNS)


# --- staging / silver ---------------------------------------------------------

@register("tick_silver")
def q_tick_silver(spark, sf_dir):
    """FLT-1, ENR-1..4, ENR-11, PRJ-4: staged ticks."""
    return staged(spark, sf_dir).prices.drop("processed_at")


@register("message_silver")
def q_message_silver(spark, sf_dir):
    """FLT-2, ENR-5..8, PRJ-5: staged messages."""
    return staged(spark, sf_dir).sentiment.drop("processed_at")


@register("article_silver")
def q_article_silver(spark, sf_dir):
    """FLT-3, ENR-9, ENR-10, ENR-19, PRJ-6: staged articles."""
    return staged(spark, sf_dir).news


# --- roll-ups -----------------------------------------------------------------

@register("hourly_price_rollup")
def q_hourly_price_rollup(spark, sf_dir):
    """AGG-1 + AGG-6 (dominant direction, smallest on ties)."""
    return _present(G.price_rollup(G.tick_partials(staged(spark, sf_dir).prices), "hour"))


@register("hourly_price_rollup_mode")
def q_hourly_price_rollup_mode(spark, sf_dir):
    """AGG-1 with Spark's deterministic ``mode`` for the dominant direction
    (the alternative to per-direction counts; same result)."""
    return _present(G.tick_rollup(staged(spark, sf_dir).prices, "hour", "mode"))


@register("symbol_hour_sentiment")
def q_symbol_hour_sentiment(spark, sf_dir):
    """AGG-2, AGG-7, AGG-8 at (social symbol, date, hour)."""
    st = staged(spark, sf_dir)
    return _present(G.symbol_sentiment(G.message_partials(st.sentiment), "hour"))


@register("hourly_news")
def q_hourly_news(spark, sf_dir):
    """AGG-3."""
    return _present(G.news_rollup(G.news_partials(staged(spark, sf_dir).news), "hour"))


@register("hourly_social")
def q_hourly_social(spark, sf_dir):
    """AGG-4 derived from the symbol-hour partials."""
    st = staged(spark, sf_dir)
    return _present(G.social_rollup(G.message_partials(st.sentiment), "hour"))


@register("sentiment_leaderboard")
def q_sentiment_leaderboard(spark, sf_dir):
    """AGG-5, AGG-9, SORT-1 (ranked, sorted by weighted score desc)."""
    st = staged(spark, sf_dir)
    return _present(M.leaderboard_sorted(M.leaderboard(G.message_partials(st.sentiment))))


@register("sentiment_leaderboard_top10")
def q_sentiment_leaderboard_top(spark, sf_dir):
    """Top-10 leaderboard rows (the limit is the feature)."""
    st = staged(spark, sf_dir)
    return _present(M.leaderboard_top(M.leaderboard(G.message_partials(st.sentiment)), 10))


# --- marts / gold ---------------------------------------------------------------

@register("price_sentiment_hourly")
def q_price_sentiment_hourly(spark, sf_dir):
    """Correlation mart with the normalised join key (JOIN-1, ENR-17)."""
    st = staged(spark, sf_dir)
    return _present(M.price_sentiment(G.tick_partials(st.prices), G.message_partials(st.sentiment), "hour", True))


@register("price_sentiment_hourly_raw_key")
def q_price_sentiment_hourly_raw(spark, sf_dir):
    """Correlation mart with the reference's raw key (matches nothing)."""
    st = staged(spark, sf_dir)
    return _present(M.price_sentiment(G.tick_partials(st.prices), G.message_partials(st.sentiment), "hour", False))


@register("market_mood")
def q_market_mood(spark, sf_dir):
    """Mood mart (AGG-3, AGG-4, JOIN-2, ENR-15, ENR-16)."""
    st = staged(spark, sf_dir)
    return _present(M.market_mood(G.news_partials(st.news), G.message_partials(st.sentiment), "hour"))


def dashboard_for(spark, sf_dir, grain: str = "hour", normalize: bool = True) -> DataFrame:
    """Both branches (correlation and mood) need the message partials. They
    are computed by one scan of the messages and checkpointed to the shared
    folder (small: one row per symbol-hour), so the dominant input is read
    once, not twice, and the lineage is cut."""
    st = staged(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    partials = G.message_partials(st.sentiment).checkpoint(eager=True)
    corr = M.price_sentiment(G.tick_partials(st.prices), partials, grain, normalize)
    mood = M.market_mood(G.news_partials(st.news), partials, grain)
    return _present(M.dashboard(corr, mood, grain))


@register("crypto_dashboard")
def q_crypto_dashboard(spark, sf_dir):
    """Flagship gold dashboard at hour grain (JOIN-1..3, ENR-18)."""
    return dashboard_for(spark, sf_dir, "hour", True)


@register("crypto_dashboard_raw_key")
def q_crypto_dashboard_raw(spark, sf_dir):
    """Dashboard with the reference's raw join key (no strong signals)."""
    return dashboard_for(spark, sf_dir, "hour", False)


@register("dashboard_daily")
def q_dashboard_daily(spark, sf_dir):
    """The dashboard at day grain (symbol, date)."""
    return dashboard_for(spark, sf_dir, "day", True)


def queries() -> dict[str, Query]:
    # Import for the side effect of registering the remaining query groups.
    from sentimart import queries_ext, queries_stream  # noqa: F401
    return dict(REGISTRY)
