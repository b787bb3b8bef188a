"""SQL oracle (DuckDB dialect) for the registered queries.

Nothing here is imported from the implementation, and literals are spelled out
again. A query's SQL is put together from three declared tables:

* ``FACTS``: the adapters from the driver's tables to one row per record, with
  the enrichment rules of silver as derived columns;
* ``MEASURES``: for each kind of fact its measures (name, how, of what), from
  which every roll-up at every grain is generated, straight from the facts
  (the implementation merges partials instead);
* rules as ranked bands, :func:`first_of`: the label of the first band whose
  condition is true (a condition that is NULL is not).

Rounding uses the decimal HALF_UP form on both sides; averages are presented
at 6 places.
"""

from __future__ import annotations


def r(x: str, n: int) -> str:
    """HALF_UP rounding on the decimal value."""
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def dbl(v) -> str:
    return f"CAST({v} AS DOUBLE)"


def first_of(bands: list[tuple[str, str]], otherwise: str) -> str:
    """The label of the first band that holds."""
    table = ", ".join(f"{{'label': {label}, 'holds': coalesce({cond}, FALSE)}}" for label, cond in bands)
    return f"coalesce(list_filter([{table}], lambda b: b.holds)[1].label, {otherwise})"


def pick(values: list[str], index: str) -> str:
    return f"([{', '.join(quote(v) for v in values)}])[CAST({index} AS INTEGER) + 1]"


def quote(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# --- facts ----------------------------------------------------------------------

SCALE = {"hundred": dbl("100.0"), "thousand": dbl("1000.0")}
OPEN = f"(value * (CAST(97 + event_id % 7 AS DOUBLE) / {SCALE['hundred']}))"
QUERIES_ = ["bitcoin cryptocurrency", "ethereum crypto", "stock market Wall Street", "NASDAQ S&P 500", "Tesla Apple Nvidia earnings"]
LONG_QUERY = "Tesla Apple Nvidia earnings and everything else that moved markets"
OPENINGS = ["strong buy today", "terrible crash", "watching the chart", "new here", "best gains ahead", "weak and falling", "great profit"]
LINKS = ["and", "but not", "never", "with", "no"]
CLOSES = ["good news", "a bad sign", "fear", "a win", "love it", "the worst loss", "safe", "more risk", "what do you think", "selling everything", "happy"]


def polarity(x: str) -> str:
    return first_of([("'positive'", f"{x} >= 0.05"), ("'negative'", f"{x} <= -0.05")], "'neutral'")


def agreement(x: str) -> str:
    """The user's label against the text's: NULL if the user's is."""
    said = first_of([("'bullish'", f"{x} >= 0.05"), ("'bearish'", f"{x} <= -0.05")], "'neutral'")
    return f"(user_sentiment = {said})"


TICK_COLUMNS = {
    "row_id": "event_id",
    "symbol": f"CASE WHEN event_id % 83 <> 0 THEN CASE WHEN event_id % 71 = 0 THEN 'DOGEUSDT' ELSE {pick(['BTCUSDT', 'ETHUSDT', 'SOLUSDT'], 'user_id % 3')} END END",
    "price": "CASE WHEN event_id % 89 <> 0 THEN CASE WHEN event_id % 97 = 0 THEN -value ELSE value END END",
    "open": OPEN,
    "high": f"greatest(value, {OPEN}) * (CAST(1000 + (event_id % 3) * 5 AS DOUBLE) / {SCALE['thousand']})",
    "low": f"least(value, {OPEN})",
    "volume": "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)",
    "price_change": f"value - {OPEN}",
    "change_pct": f"(value - {OPEN}) * {SCALE['hundred']} / NULLIF({OPEN}, 0)",
    "ingested_at": "ts",
    "source": "event_type",
    "user_id": "user_id",
}
COMPOUND = f"CAST((event_id * 37) % 201 - 100 AS DOUBLE) / {SCALE['hundred']}"
MESSAGE_COLUMNS = {
    "row_id": "event_id",
    "message_id": "CASE WHEN event_id % 79 <> 0 THEN CAST(event_id AS VARCHAR) END",
    "symbol": f"CASE WHEN event_id % 67 <> 0 THEN CASE WHEN event_id % 61 = 0 THEN 'DOGE.X' ELSE {pick(['BTC.X', 'ETH.X', 'SOL.X', 'AAPL'], 'user_id % 4')} END END",
    "body": f"{pick(OPENINGS, 'event_id % 7')} || ' ' || {pick(LINKS, 'event_id % 5')} || ' ' || {pick(CLOSES, 'event_id % 11')}",
    "created_at": "ts",
    "ingested_at": "ts",
    "user_id": "CAST(user_id AS VARCHAR)",
    "username": "'user_' || CAST(user_id AS VARCHAR)",
    "user_followers": "CAST((user_id * 97) % 20000 AS INTEGER)",
    "user_following": "CAST((user_id * 13) % 500 AS INTEGER)",
    "user_ideas": "CAST(user_id % 50 AS INTEGER)",
    "user_watchlist_count": "CAST(user_id % 30 AS INTEGER)",
    "user_sentiment": first_of([("'bullish'", "event_type = 'purchase'"), ("'bearish'", "event_type = 'error'")], "'neutral'"),
    "sentiment_compound": COMPOUND,
    "self_label": "event_type",
}
PUBLISHED = "TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((page_id * 7) % 800 AS BIGINT))"
ARTICLE_COLUMNS = {
    "row_id": "page_id",
    "article_id": "CASE WHEN page_id % 31 <> 0 THEN md5(coalesce(url, '')) END",
    "query": f"CASE WHEN page_id % 37 = 0 THEN {quote(LONG_QUERY)} ELSE {pick(QUERIES_, 'page_id % 5')} END",
    "source": "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)",
    "author": "'author_' || CAST(page_id % 17 AS VARCHAR)",
    "title": "CASE WHEN page_id % 29 <> 0 THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END",
    "description": "regexp_replace(html, '<[^>]*>', ' ', 'g')",
    "url": "url",
    "published_at": PUBLISHED,
    "ingested_at": f"{PUBLISHED} + INTERVAL 5 MINUTE",
    "sentiment_compound": f"CAST((page_id * 53) % 201 - 100 AS DOUBLE) / {SCALE['hundred']}",
}


def adapter(name: str, columns: dict[str, str], table: str) -> str:
    return f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table})"


TICKS = adapter("ticks", TICK_COLUMNS, "events")
MESSAGES = adapter("messages", MESSAGE_COLUMNS, "events")
ARTICLES = adapter("articles", ARTICLE_COLUMNS, "pages")
CHANGED = {"price": 6, "open": 6, "high": 6, "low": 6, "change_pct": 4}


def tick_facts(name: str = "stg_crypto_prices", valid: str = "symbol IS NOT NULL AND price > 0", source: str = "ticks") -> str:
    rounded = ", ".join(f"{r(c, n)} AS {c}" for c, n in CHANGED.items())
    return f"""{name} AS (
  SELECT symbol, price, open, high, low, volume, price_change, change_pct, ingested_at,
    {r('abs(change_pct)', 4)} AS change_magnitude,
    {first_of([("'bullish'", 'change_pct > 0.5'), ("'bearish'", 'change_pct < -0.5')], "'neutral'")} AS price_direction,
    coalesce((high - low) / NULLIF(open, 0) > 0.02, FALSE) AS is_volatile,
    {r('high - low', 6)} AS price_range, {r('(price - open) / NULLIF(open, 0)', 6)} AS intraday_return,
    CAST(ingested_at AS DATE) AS trade_date, CAST(hour(ingested_at) AS INTEGER) AS trade_hour
  FROM (SELECT * REPLACE ({rounded}) FROM {source} WHERE {valid}))"""


def message_facts(name: str = "stg_sentiment", valid: str = "message_id IS NOT NULL AND symbol IS NOT NULL", source: str = "messages") -> str:
    label = first_of([(dbl(1), "user_sentiment = 'bullish'"), (dbl(-1), "user_sentiment = 'bearish'")], dbl(0))
    return f"""{name} AS (
  SELECT message_id, symbol, body, user_sentiment, sentiment_compound, {polarity('sentiment_compound')} AS sentiment_label,
    combined_sentiment_score,
    {first_of([("'bullish'", 'combined_sentiment_score > 0.1'), ("'bearish'", 'combined_sentiment_score < -0.1')], "'neutral'")} AS final_sentiment,
    {first_of([(dbl('1.0'), 'user_followers > 10000'), (dbl('0.7'), 'user_followers > 1000'), (dbl('0.4'), 'user_followers > 100')], dbl('0.1'))} AS influence_score,
    {agreement('sentiment_compound')} AS sentiment_agreement, user_followers, user_ideas, created_at,
    CAST(created_at AS DATE) AS sentiment_date, CAST(hour(created_at) AS INTEGER) AS sentiment_hour
  FROM (SELECT *, {r(f"sentiment_compound * {dbl('0.4')} + {label} * {dbl('0.6')}", 4)} AS combined_sentiment_score FROM {source} WHERE {valid}))"""


def article_facts(name: str = "stg_news", valid: str = "article_id IS NOT NULL AND title IS NOT NULL", source: str = "articles") -> str:
    x = "sentiment_compound"
    bands = [("'strong_positive'", f"{x} >= 0.5"), ("'mild_positive'", f"{x} >= 0.05"), ("'strong_negative'", f"{x} <= -0.5"), ("'mild_negative'", f"{x} <= -0.05")]
    return f"""{name} AS (
  SELECT article_id, title, source, query, {x}, {polarity(x)} AS sentiment_label, {first_of(bands, "'neutral'")} AS sentiment_strength,
    coalesce(abs({x}) >= 0.5, FALSE) AS is_high_impact, published_at, ingested_at,
    CAST(published_at AS DATE) AS publish_date, CAST(hour(published_at) AS INTEGER) AS publish_hour
  FROM {source} WHERE {valid})"""


FACTS = {"tick": (TICKS, tick_facts()), "message": (MESSAGES, message_facts()), "article": (ARTICLES, article_facts())}
TABLE = {"tick": "stg_crypto_prices", "message": "stg_sentiment", "article": "stg_news"}
BUCKET = {"tick": ("trade_date", "trade_hour"), "message": ("sentiment_date", "sentiment_hour"), "article": ("publish_date", "publish_hour")}


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b for b in dict.fromkeys(blocks)) + "\n"


def facts(*kinds: str) -> list[str]:
    return [b for k in kinds for b in FACTS[k]]


# --- measures and roll-ups ---------------------------------------------------------

# How a measure is taken: mean, mean of an exact sum to some places, most, least,
# rows, rows where, value seen most (least value on a tie), weighted mean.
MEASURES = {
    "tick": [("avg_price", "mean", "price"), ("max_price", "most", "price"), ("min_price", "least", "price"),
             ("avg_change_pct", "mean", "change_pct"), ("avg_volatility", "mean", "change_magnitude"),
             ("price_tick_count", "rows", ""), ("dominant_direction", "usual", "price_direction")],
    "message": [("message_count", "rows", ""), ("avg_sentiment_score", "exact", ("combined_sentiment_score", 4)), ("avg_influence", "exact", ("influence_score", 1)),
                ("bullish_count", "where", "final_sentiment = 'bullish'"), ("bearish_count", "where", "final_sentiment = 'bearish'"),
                ("neutral_count", "where", "final_sentiment = 'neutral'"), ("max_followers", "most", "user_followers"),
                ("weighted_sentiment_score", "weighted", ("combined_sentiment_score", "influence_score"))],
    "article": [("article_count", "rows", ""), ("avg_news_sentiment", "exact", ("sentiment_compound", 8)), ("high_impact_count", "where", "is_high_impact"),
                ("strong_positive_news", "where", "sentiment_strength = 'strong_positive'"),
                ("strong_negative_news", "where", "sentiment_strength = 'strong_negative'")],
}
HOW = {
    "mean": lambda x: f"avg({x})",
    "exact": lambda x: f"{total(*x)} / CAST(NULLIF(count({x[0]}), 0) AS DOUBLE)",
    "most": lambda x: f"max({x})",
    "least": lambda x: f"min({x})",
    "rows": lambda x: "count(*)",
    "where": lambda x: f"count(*) FILTER (WHERE {x})",
    "usual": lambda x: f"mode() WITHIN GROUP (ORDER BY {x})",
    "weighted": lambda x: f"CAST(sum({places(x[0], 4)} * {places(x[1], 1)}) AS DOUBLE) / NULLIF({total(x[1], 1)}, 0)",
}


def places(x: str, n: int) -> str:
    return f"CAST({x} AS DECIMAL(18,{n}))"


def total(x: str, n: int) -> str:
    return f"CAST(sum({places(x, n)}) AS DOUBLE)"


def rolled(kind: str, grain: str, key: str | None, name: str) -> str:
    """All measures of a kind by key (an expression, or none) and bucket (date or date, hour)."""
    at = BUCKET[kind][:1 if grain == "day" else 2]
    keys = ([f"{key} AS symbol"] if key else []) + [f"{c} AS {b}" for c, b in zip(at, ("date", "hour"))]
    taken = [f"{HOW[how](of)} AS {m}" for m, how, of in MEASURES[kind]]
    return f"{name} AS (SELECT {', '.join(keys + taken)} FROM {TABLE[kind]} GROUP BY ALL)"


def shown(columns: str, floats: str, prefix: str = "") -> str:
    """A select list: plain columns, and doubles at 6 places."""
    return ", ".join([f"{prefix}{c}" for c in columns.split()] + [f"{r(prefix + c, 6)} AS {c}" for c in floats.split()])


TICK_KEY = {True: "regexp_replace(symbol, '\\.X$', '') || 'USDT'", False: "symbol || 'USDT'"}


def same_bucket(a: str, b: str, grain: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in (["date"] if grain == "day" else ["date", "hour"]))


def buckets(grain: str) -> str:
    return "date" if grain == "day" else "date hour"


def ratio(a: str, b: str) -> str:
    return r(f"CAST({a} AS DOUBLE) / NULLIF({b}, 0)", 4)


def signal_tables(grain: str, normalize: bool) -> list[str]:
    """Prices with the sentiment of their symbol and bucket."""
    w = "s.weighted_sentiment_score"
    agree = f"coalesce((p.dominant_direction = 'bullish' AND {w} > 0) OR (p.dominant_direction = 'bearish' AND {w} < 0), FALSE)"
    return [*facts("tick", "message"), rolled("tick", grain, "symbol", "price_buckets"), rolled("message", grain, TICK_KEY[normalize], "symbol_buckets"),
            f"""signals AS (
  SELECT p.*, s.* EXCLUDE (symbol, {', '.join(buckets(grain).split())}, message_count, max_followers), s.message_count AS sentiment_message_count,
    {ratio('s.bullish_count', 's.message_count')} AS bullish_ratio, {ratio('s.bearish_count', 's.message_count')} AS bearish_ratio,
    {agree} AS sentiment_price_agreement
  FROM price_buckets p LEFT JOIN symbol_buckets s ON p.symbol = s.symbol AND {same_bucket('p', 's', grain)})"""]


def mood_tables(grain: str) -> list[str]:
    """Both markets' buckets; one without a partner stands alone."""
    raw = f"(coalesce(n.avg_news_sentiment, 0) * {dbl('0.5')} + coalesce(m.avg_sentiment_score, 0) * {dbl('0.5')})"
    keys = ", ".join(f"coalesce(n.{b}, m.{b}) AS {b}" for b in buckets(grain).split())
    return [*facts("message", "article"), rolled("article", grain, None, "news_buckets"), rolled("message", grain, None, "market_buckets"),
            f"""moods AS (
  SELECT {keys}, n.* EXCLUDE ({', '.join(buckets(grain).split())}), m.message_count AS social_message_count,
    m.avg_sentiment_score AS avg_social_sentiment, m.avg_influence, {r(raw, 4)} AS market_mood_score,
    {first_of([("'greed'", f'{raw} > 0.15'), ("'fear'", f'{raw} < -0.15')], "'neutral'")} AS market_mood_label
  FROM news_buckets n FULL JOIN market_buckets m ON {same_bucket('n', 'm', grain)})"""]


SIGNAL_BANDS = [  # (label, weighted score, mood score, how they combine)
    ("strong_buy_signal", "> 0.2", "> 0.1", "AND"), ("mild_buy_signal", "> 0.1", "> 0.05", "OR"),
    ("strong_sell_signal", "< -0.2", "< -0.1", "AND"), ("mild_sell_signal", "< -0.1", "< -0.05", "OR"),
]


def dashboard(grain: str, normalize: bool = True) -> str:
    bands = [(quote(label), f"(s.weighted_sentiment_score {w} {op} m.market_mood_score {v})") for label, w, v, op in SIGNAL_BANDS]
    return with_(*signal_tables(grain, normalize), *mood_tables(grain)) + f"""
SELECT {shown(f'symbol {buckets(grain)} dominant_direction price_tick_count bullish_ratio bearish_ratio sentiment_message_count sentiment_price_agreement',
              'avg_price avg_change_pct avg_volatility avg_sentiment_score weighted_sentiment_score', 's.')},
  m.market_mood_score, m.market_mood_label, m.high_impact_count AS high_impact_news_count, m.article_count AS news_article_count,
  {first_of(bands, "'hold_signal'")} AS composite_signal
FROM signals s LEFT JOIN moods m ON {same_bucket('s', 'm', grain)}"""


SQL: dict[str, str] = {}

SQL["tick_silver"] = with_(*facts("tick")) + "SELECT * FROM stg_crypto_prices"
SQL["message_silver"] = with_(*facts("message")) + "SELECT * FROM stg_sentiment"
SQL["article_silver"] = with_(*facts("article")) + "SELECT * FROM stg_news"

SQL["hourly_price_rollup"] = with_(*facts("tick"), rolled("tick", "hour", "symbol", "b")) + f"""
SELECT date AS trade_date, hour AS trade_hour, {shown('symbol max_price min_price price_tick_count dominant_direction', 'avg_price avg_change_pct avg_volatility')} FROM b"""
SQL["symbol_hour_sentiment"] = with_(*facts("message"), rolled("message", "hour", "symbol", "b")) + f"""
SELECT date AS sentiment_date, hour AS sentiment_hour, {shown('symbol message_count bullish_count bearish_count neutral_count',
                                                              'avg_sentiment_score avg_influence weighted_sentiment_score')} FROM b"""
SQL["hourly_news"] = with_(*facts("article"), rolled("article", "hour", None, "b")) + f"""
SELECT date AS publish_date, hour AS publish_hour, {shown('article_count high_impact_count strong_positive_news strong_negative_news', 'avg_news_sentiment')} FROM b"""
SQL["hourly_social"] = with_(*facts("message"), rolled("message", "hour", None, "b")) + f"""
SELECT date AS sentiment_date, hour AS sentiment_hour, message_count AS total_messages, {r('avg_sentiment_score', 6)} AS avg_social_sentiment,
  {r('avg_influence', 6)} AS avg_influence FROM b"""

BOARD = f"""
SELECT symbol, date, message_count AS total_messages, {r('avg_sentiment_score', 6)} AS avg_sentiment, {r('avg_influence', 6)} AS avg_influence, max_followers,
  bullish_count AS bullish_msgs, bearish_count AS bearish_msgs, {ratio('bullish_count', 'message_count')} AS bullish_pct,
  {r('weighted_sentiment_score', 6)} AS weighted_score,
  CAST(rank() OVER (PARTITION BY date ORDER BY weighted_sentiment_score DESC NULLS LAST, symbol) AS INTEGER) AS daily_rank
FROM b"""
SQL["sentiment_leaderboard"] = with_(*facts("message"), rolled("message", "day", "symbol", "b")) + BOARD
SQL["sentiment_leaderboard_top10"] = SQL["sentiment_leaderboard"] + "\nORDER BY weighted_sentiment_score DESC NULLS LAST, symbol, date LIMIT 10"

for _name, _normal in (("price_sentiment_hourly", True), ("price_sentiment_hourly_raw_key", False)):
    SQL[_name] = with_(*signal_tables("hour", _normal)) + f"""
SELECT {shown('symbol date hour max_price min_price dominant_direction price_tick_count sentiment_message_count bullish_count bearish_count neutral_count '
              'bullish_ratio bearish_ratio sentiment_price_agreement',
              'avg_price avg_change_pct avg_volatility avg_sentiment_score weighted_sentiment_score avg_influence')} FROM signals"""

SQL["market_mood"] = with_(*mood_tables("hour")) + f"""
SELECT {shown('date hour article_count high_impact_count strong_positive_news strong_negative_news social_message_count market_mood_score market_mood_label',
              'avg_news_sentiment avg_social_sentiment avg_influence')} FROM moods"""
SQL["crypto_dashboard"] = dashboard("hour")
SQL["crypto_dashboard_raw_key"] = dashboard("hour", False)
SQL["dashboard_daily"] = dashboard("day")


def oracle_sql() -> dict[str, str]:
    from sentimart import oracle_ext  # noqa: F401  (registers the remaining groups)
    return dict(SQL)
