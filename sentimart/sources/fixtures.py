"""Adapters from the driver's tables to the canonical parsed records.

These are pure column expressions (no joins, no shuffles) so the same
formula can be written in SQL for the oracle. They produce the *parsed*
records (bronze shape without ``processed_at``); the wire form is obtained
with :func:`sentimart.sources.landing.to_wire`.

    tick    <- events
    message <- events
    article <- pages

Fixed rules make some records bad, so that every filter and check has rows to
act on: missing ids, symbols, titles and prices, prices below zero, symbols
and queries off the watch-lists, a query longer than a publish key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.functions.enrich import (DATA_SOURCES, NEWS_QUERIES, TICK_SYMBOLS, article_id,
                                        label_agreement, polarity_class)

# Fixed values of the fixture mapping.
MESSAGE_SYMBOLS = ["BTC.X", "ETH.X", "SOL.X", "AAPL"]
# A body is an opening, a link word (some negate) and a close: 7 x 5 x 11 texts.
OPENINGS = ["strong buy today", "terrible crash", "watching the chart", "new here", "best gains ahead", "weak and falling", "great profit"]
LINKS = ["and", "but not", "never", "with", "no"]
CLOSES = ["good news", "a bad sign", "fear", "a win", "love it", "the worst loss", "safe", "more risk", "what do you think", "selling everything", "happy"]
LONG_QUERY = "Tesla Apple Nvidia earnings and everything else that moved markets"
OFF_LIST = {"tick": "DOGEUSDT", "message": "DOGE.X"}
ARTICLE_EPOCH_SECONDS = 1704067200  # 2024-01-01T00:00:00Z


def _pick_sql(values: list[str], idx: str) -> str:
    """values[idx] (0-based) as a CASE expression."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {idx} {arms} END"


def _index_sql(values: list[str], col: str) -> str:
    """Position of ``col`` in ``values`` (len(values) when absent)."""
    arms = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(values))
    return f"CASE {col} {arms} ELSE {len(values)} END"


def _score_sql(x: str) -> str:
    """Integer in [0, 200] -> score in [-1, 1]."""
    return f"(CAST(({x}) - 100 AS DOUBLE) / 100D)"


def _cols(exprs: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(n) for n, e in exprs.items()]


OPEN = "(value * (CAST(97 + event_id % 7 AS DOUBLE) / 100D))"
TICK_EXPRS = {
    "symbol": f"CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 71 = 0 THEN '{OFF_LIST['tick']}' "
              f"ELSE {_pick_sql(TICK_SYMBOLS, 'user_id % 3')} END",
    "price": "CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -value ELSE value END",
    "open": OPEN,
    "high": f"greatest(value, {OPEN}) * (CAST(1000 + (event_id % 3) * 5 AS DOUBLE) / 1000D)",
    "low": f"least(value, {OPEN})",
    "volume": "try_cast(get_json_object(props, '$.k') AS DOUBLE)",
    "price_change": f"value - {OPEN}",
    "change_pct": f"try_divide((value - {OPEN}) * 100D, nullif({OPEN}, 0D))",
    "ingested_at": "CAST(ts AS TIMESTAMP)",
    "source": "event_type",
}


def ticks_from_events(events: DataFrame, keep: list | None = None) -> DataFrame:
    return events.select(*(keep or []), *_cols(TICK_EXPRS))


COMPOUND = _score_sql("(event_id * 37) % 201")
MESSAGE_EXPRS = {
    "message_id": "CASE WHEN event_id % 79 <> 0 THEN CAST(event_id AS STRING) END",
    "symbol": f"CASE WHEN event_id % 67 = 0 THEN NULL WHEN event_id % 61 = 0 THEN '{OFF_LIST['message']}' "
              f"ELSE {_pick_sql(MESSAGE_SYMBOLS, 'user_id % 4')} END",
    "body": f"concat_ws(' ', {_pick_sql(OPENINGS, 'event_id % 7')}, {_pick_sql(LINKS, 'event_id % 5')}, "
            f"{_pick_sql(CLOSES, 'event_id % 11')})",
    "created_at": "CAST(ts AS TIMESTAMP)",
    "ingested_at": "CAST(ts AS TIMESTAMP)",
    "user_id": "CAST(user_id AS STRING)",
    "username": "concat('user_', CAST(user_id AS STRING))",
    "user_followers": "CAST((user_id * 97) % 20000 AS INT)",
    "user_following": "CAST((user_id * 13) % 500 AS INT)",
    "user_ideas": "CAST(user_id % 50 AS INT)",
    "user_watchlist_count": "CAST(user_id % 30 AS INT)",
    "user_sentiment": "CASE event_type WHEN 'purchase' THEN 'bullish' WHEN 'error' THEN 'bearish' "
                      "ELSE 'neutral' END",
    "sentiment_pos": f"greatest({COMPOUND}, 0D)",
    "sentiment_neg": f"greatest(-{COMPOUND}, 0D)",
    "sentiment_neu": f"1D - abs({COMPOUND})",
    "sentiment_compound": COMPOUND,
}


def messages_from_events(events: DataFrame, keep: list | None = None) -> DataFrame:
    return (
        events.select(*(keep or []), *_cols(MESSAGE_EXPRS))
        .withColumns({
            "sentiment_label": polarity_class("sentiment_compound"),
            "sentiment_agreement": label_agreement("user_sentiment", "sentiment_compound"),
            "symbols_mentioned": F.expr("array(symbol)"),
            "data_source": F.lit(DATA_SOURCES["message"]),
        })
    )


URL_HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"
TITLE_PATTERN = r"<title>([^<]*)</title>"
MARKUP_PATTERN = r"<[^>]*>"
PUBLISHED = f"timestamp_seconds({ARTICLE_EPOCH_SECONDS} + ((page_id * 7) % 800) * 3600)"
ARTICLE_COMPOUND = _score_sql("(page_id * 53) % 201")


def articles_from_pages(pages: DataFrame, keep: list | None = None) -> DataFrame:
    cols = [
        F.when(F.col("page_id") % 31 != 0, article_id("url")).alias("article_id"),
        F.expr(f"CASE WHEN page_id % 37 = 0 THEN '{LONG_QUERY}' ELSE {_pick_sql(NEWS_QUERIES, 'page_id % 5')} END").alias("query"),
        F.regexp_extract("url", URL_HOST_PATTERN, 1).alias("source"),
        F.expr("concat('author_', CAST(page_id % 17 AS STRING))").alias("author"),
        F.when(F.col("page_id") % 29 != 0, F.regexp_extract("html", TITLE_PATTERN, 1)).alias("title"),
        F.regexp_replace("html", MARKUP_PATTERN, " ").alias("description"),
        F.col("url"),
        F.expr(PUBLISHED).alias("published_at"),
        F.expr(f"{PUBLISHED} + INTERVAL 5 MINUTES").alias("ingested_at"),
        *_cols({"sentiment_pos": f"greatest({ARTICLE_COMPOUND}, 0D)",
                "sentiment_neg": f"greatest(-{ARTICLE_COMPOUND}, 0D)",
                "sentiment_neu": f"1D - abs({ARTICLE_COMPOUND})",
                "sentiment_compound": ARTICLE_COMPOUND}),
    ]
    return (pages.select(*(keep or []), *cols)
            .withColumns({"sentiment_label": polarity_class("sentiment_compound"),
                          "data_source": F.lit(DATA_SOURCES["article"])}))


# --- landing tables (queue-record shape) ------------------------------------
# (key string, value string, offset bigint, ingested_at timestamp), derived
# row by row from the tables above: offset = the source row id.

def tick_wire_landing(events: DataFrame, corrupt: bool = False) -> DataFrame:
    """Wire JSON of the ticks, one record per event.

    With ``corrupt=True`` two deterministic kinds of damage are applied, for
    the quarantine split: 'error' events lose their closing brace (not
    JSON), and 'signup' events of users with id % 10 = 0 carry the price as
    the text "n/a" (malformed: the price reads NULL)."""
    from sentimart.sources.landing import wire_value
    t = ticks_from_events(events, keep=[F.col("event_id").alias("offset"),
                                        F.col("event_type").alias("_et"),
                                        F.col("user_id").alias("_uid")])
    t = t.withColumn("_v", wire_value(t, "tick"))
    v = F.col("_v")
    if corrupt:
        v = (F.when(F.col("_et") == "error", F.expr("substring(_v, 1, length(_v) - 1)"))
             .when((F.col("_et") == "signup") & (F.col("_uid") % 10 == 0),
                   F.regexp_replace("_v", r'"price":[^,]*,', '"price":"n/a",'))
             .otherwise(F.col("_v")))
    return t.select(F.col("symbol").alias("key"), v.alias("value"), "offset", "ingested_at")


def _cut(value: str | Column, damaged: Column) -> Column:
    """A JSON text without its last character where ``damaged``."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(damaged, F.substring(v, F.lit(1), F.length(v) - 1)).otherwise(v)


def ticker_landing(events: DataFrame, damaged: bool = False) -> DataFrame:
    """Raw ticker envelopes ``{stream, data:{s,c,o,h,l,v,p,P}}`` with the
    numbers as strings and a lower-case pair, one per event. ``damaged``: one
    price in 13 is text, one payload in 17 is cut."""
    t = ticks_from_events(events, keep=[F.col("event_id").alias("offset")])
    if damaged:
        t = t.withColumn("price", F.when(F.col("offset") % 13 == 5, "n/a").otherwise(F.col("price").cast("string")))
    s = lambda c: F.col(c).cast("string")
    payload = F.struct(
        F.concat(F.lower("symbol"), F.lit("@ticker")).alias("stream"),
        F.create_map(F.lit("s"), F.lower("symbol"), F.lit("c"), s("price"), F.lit("o"), s("open"),
                     F.lit("h"), s("high"), F.lit("l"), s("low"), F.lit("v"), s("volume"),
                     F.lit("p"), s("price_change"), F.lit("P"), s("change_pct")).alias("data"),
    )
    value = _cut(F.to_json(payload), F.col("offset") % 17 == 3) if damaged else F.to_json(payload)
    return t.select(F.col("symbol").alias("key"), value.alias("value"), "offset", "ingested_at")


SOCIAL_BATCH = 100   # messages per polled page (bounded by construction)
NEWS_BATCH = 20      # articles per polled page


#: Offsets of pages that were polled once more.
REPOLL_OFFSET = 10**9


def _repolled(pages: DataFrame) -> DataFrame:
    """The pages, and one in three of them again at a later offset."""
    again = pages.filter(F.col("offset") % 3 == 0).withColumn("offset", F.col("offset") + REPOLL_OFFSET)
    return pages.unionByName(again)


def social_landing(events: DataFrame, repolled: bool = False, damaged: bool = False) -> DataFrame:
    """Raw social pages ``{symbol:{symbol}, messages:[...]}``: messages of one
    symbol whose ids share ``event_id div 100`` form one page (at most 100
    messages, so each collected array is bounded). ``damaged``: users whose id
    ends in 7 have a follower count of text, one page in 11 is cut."""
    from sentimart.sources.landing import iso_utc
    m = messages_from_events(events, keep=[F.col("event_id"), F.col("event_type").alias("_et")])
    basic = (F.when(F.col("_et") == "purchase", F.lit("Bullish"))
             .when(F.col("_et") == "error", F.lit("Bearish")))
    followers = F.col("user_followers")
    if damaged:
        followers = F.when(F.col("user_id").cast("long") % 10 == 7, "n/a").otherwise(followers.cast("string"))
    msg = F.struct(
        F.col("event_id").alias("id"),
        F.col("body"),
        iso_utc("created_at").alias("created_at"),
        F.struct(F.col("user_id").cast("long").alias("id"), F.col("username"),
                 followers.alias("followers"), F.col("user_following").alias("following"),
                 F.col("user_ideas").alias("ideas"),
                 F.col("user_watchlist_count").alias("watchlist_stocks_count")).alias("user"),
        F.struct(F.when(basic.isNotNull(), F.struct(basic.alias("basic"))).alias("sentiment"),
                 F.array(F.struct(F.col("symbol").alias("symbol"))).alias("symbols")).alias("entities"),
    )
    pages = (m.select("symbol", (F.col("event_id") / SOCIAL_BATCH).cast("long").alias("page"),
                      F.col("ingested_at"), F.struct(F.col("event_id").alias("k"), msg.alias("m")).alias("e"))
             .groupBy("symbol", "page")
             .agg(F.sort_array(F.collect_list("e"), asc=False).alias("es"),
                  F.max("ingested_at").alias("ingested_at")))
    payload = F.struct(F.struct(F.col("symbol").alias("symbol")).alias("symbol"),
                       F.transform("es", lambda e: e["m"]).alias("messages"))
    # offset: a unique page number per (page, symbol), like a queue offset
    out = pages.select(F.col("symbol").alias("key"), F.to_json(payload).alias("value"),
                       (F.col("page") * 10 + F.expr(_index_sql([*MESSAGE_SYMBOLS, OFF_LIST["message"]], "symbol"))).alias("offset"),
                       "ingested_at")
    if damaged:
        out = out.withColumn("value", _cut("value", F.col("offset") % 11 == 5))
    return _repolled(out) if repolled else out


def news_landing(pages: DataFrame, repolled: bool = False, damaged: bool = False) -> DataFrame:
    """Raw news pages ``{status, query, articles:[...]}``: articles of one
    query whose page ids share ``page_id div 20`` form one response.
    ``damaged``: one response in 7 reports an error, one in 11 is cut."""
    from sentimart.sources.landing import iso_utc
    a = articles_from_pages(pages, keep=[F.col("page_id")])
    art = F.struct(
        F.col("url"),
        F.struct(F.lit(None).cast("string").alias("id"), F.col("source").alias("name")).alias("source"),
        F.col("author"), F.col("title"), F.col("description"),
        iso_utc("published_at").alias("publishedAt"),
    )
    g = (a.select("query", (F.col("page_id") / NEWS_BATCH).cast("long").alias("page"),
                  F.col("ingested_at"), F.struct(F.col("page_id").alias("k"), art.alias("a")).alias("e"))
         .groupBy("query", "page")
         .agg(F.sort_array(F.collect_list("e")).alias("es"), F.max("ingested_at").alias("ingested_at")))
    offset = F.col("page") * 8 + F.expr(_index_sql(NEWS_QUERIES, "query"))
    status = F.when(offset % 7 == 3, "error").otherwise("ok") if damaged else F.lit("ok")
    payload = F.struct(status.alias("status"), F.col("query"),
                       F.transform("es", lambda e: e["a"]).alias("articles"))
    out = g.select(F.substring("query", 1, 50).alias("key"), F.to_json(payload).alias("value"), offset.alias("offset"), "ingested_at")
    if damaged:
        out = out.withColumn("value", _cut("value", F.col("offset") % 11 == 5))
    return _repolled(out) if repolled else out


def lexicon_from_items(items: DataFrame) -> DataFrame:
    """A (token, valence) table of the words of a small text table, valence
    by a rule: evidence for scoring texts in the fixtures' invented languages."""
    from sentimart.functions.text import tokens
    t = items.select(F.explode(tokens("text")).alias("token")).distinct()
    return t.select("token", F.expr("((length(token) * 17 + length(replace(token, 'e', '')) * 5) % 41 - 20) / 10D").alias("valence"))


def phrases_from_items(items: DataFrame) -> DataFrame:
    """An (entry, valence) table: neighbouring word pairs and triples of a small
    text table whose text has a length divisible by 3, valence by the rule above."""
    from sentimart.functions.text import tokens
    t = items.select(tokens("text").alias("w"))
    runs = "transform(sequence(1, size(w) - {k} + 1), i -> array_join(slice(w, i, {k}), ' '))"
    found = [t.where(f"size(w) >= {k}").select(F.explode(F.expr(runs.format(k=k))).alias("entry")) for k in (2, 3)]
    e = found[0].unionByName(found[1]).distinct().where("length(entry) % 3 = 0")
    return e.select("entry", F.expr("((length(entry) * 17 + length(replace(entry, 'e', '')) * 5) % 41 - 20) / 10D").alias("valence"))


def boosters_from_items(items: DataFrame) -> DataFrame:
    """A (token, valence) table of amounts: words of a small text table by a rule."""
    from sentimart.functions.text import tokens
    t = items.select(F.explode(tokens("text")).alias("token")).distinct().where("length(token) % 4 = 2")
    return t.select("token", F.expr("CASE WHEN contains(token, 'r') THEN -0.293D ELSE 0.293D END").alias("valence"))
