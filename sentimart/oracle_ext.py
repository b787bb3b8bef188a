"""Oracle SQL for the ingest, text, de-duplication, quality and stream queries."""

from __future__ import annotations

from sentimart.oracle import (ARTICLES, FACTS, MESSAGES, SQL, TICKS, agreement, article_facts, dbl, facts,
                              message_facts, polarity, quote, r, tick_facts, with_)

TICK_COLS = "symbol, price, open, high, low, volume, price_change, change_pct, ingested_at, source"
SHARES = f"""greatest(sentiment_compound, 0.0) AS sentiment_pos, greatest(-sentiment_compound, 0.0) AS sentiment_neg,
  {dbl('1.0')} - abs(sentiment_compound) AS sentiment_neu, sentiment_compound, {polarity('sentiment_compound')} AS sentiment_label"""
USER = "user_id, username, user_followers, user_following, user_ideas, user_watchlist_count, user_sentiment"

SQL["parse_ticks_json"] = with_(TICKS) + f"SELECT {TICK_COLS} FROM ticks"
SQL["parse_messages_json"] = with_(MESSAGES) + f"""
SELECT message_id, symbol, body, created_at, ingested_at, {USER}, {SHARES}, {agreement('sentiment_compound')} AS sentiment_agreement,
  coalesce(symbol, '') AS symbols_mentioned_csv, 'stocktwits' AS data_source FROM messages"""
SQL["parse_articles_json"] = with_(ARTICLES) + f"""
SELECT article_id, query, source, author, title, description, url, published_at, ingested_at, {SHARES}, 'newsapi' AS data_source FROM articles"""

SQL["quarantine_split"] = with_(TICKS) + """
SELECT row_id AS "offset", bad AS quarantined, NOT bad AND text_price AS malformed, CASE WHEN NOT bad THEN symbol END AS symbol,
  CASE WHEN NOT bad AND NOT text_price THEN price END AS price
FROM (SELECT *, source = 'error' OR symbol IS NULL AS bad, source = 'signup' AND user_id % 10 = 0 AND price IS NOT NULL AS text_price FROM ticks)"""

SQL["normalize_ticker_payload"] = with_(TICKS) + """
SELECT row_id AS "offset", symbol, coalesce(price, 0.0) AS price, coalesce(open, 0.0) AS open, coalesce(high, 0.0) AS high,
  coalesce(low, 0.0) AS low, coalesce(volume, 0.0) AS volume, coalesce(price_change, 0.0) AS price_change,
  coalesce(change_pct, 0.0) AS change_pct, ingested_at, 'binance_ws' AS source, FALSE AS quarantined
FROM ticks WHERE symbol IS NOT NULL"""


# --- lexicon scorer, by UNNEST and windows ------------------------------------------

# Fixed values, spelled out again: the lexicon in thousandths, and the negators.
VALENCES = {
    3200: "best love", 3100: "great", 3000: "excellent", 2800: "win", 2700: "happy success", 2400: "gain gains", 2300: "strong gewinn",
    2100: "bullish profit", 1900: "good bon bonne gut bueno buena safe", 1800: "moon", 1500: "bull", 900: "buy", 600: "up",
    -400: "selling", -600: "sell", -1100: "falling risk", -1200: "bear", -1300: "loss verlust", -1700: "crash problem", -1900: "weak",
    -2000: "bearish", -2100: "terrible sad", -2200: "fear peur angst miedo", -2500: "bad mauvais schlecht malo mala",
    -2700: "hate", -2900: "scam", -3100: "worst crisis",
}
NEGATIONS = "not no never none nobody cannot without pas jamais sans nicht kein keine nie nunca sin".split()
SPLIT = "list_filter(string_split_regex(lower(coalesce({x}, '')), '[^\\p{{L}}]+'), lambda t: t <> '')"
FIXED = ", ".join(f"({quote(w)}, {v})" for v, ws in VALENCES.items() for w in ws.split())
LEXICON_SQL = f"""lexicon AS (
  SELECT * FROM (VALUES {FIXED}) AS f(token, milli)
  UNION ALL
  SELECT token, CAST(round(CAST((length(token) * 17 + length(replace(token, 'e', '')) * 5) % 41 - 20 AS DOUBLE) / 10.0 * 1000) AS BIGINT)
  FROM (SELECT DISTINCT unnest({SPLIT.format(x='text')}) AS token FROM benchmark)
  WHERE token NOT IN (SELECT token FROM (VALUES {FIXED}) AS f(token, milli)))"""


def scored(src: str, ids: list[str], text: str) -> list[str]:
    """CTEs ending in ``scores``, a row for each row of ``src``."""
    key = ", ".join(ids)
    unit = dbl("100000.0")
    total = f"(CAST(pos_u - neg_u AS DOUBLE) / {unit} + CAST(n_tokens - n_scored AS DOUBLE))"
    share = lambda x: f"CASE WHEN {total} > 0 THEN {r(f'abs(({x}) / {total})', 3)} ELSE 0.0 END"
    return [LEXICON_SQL, f"""token_lists AS (SELECT {key}, {SPLIT.format(x=text)} AS tl FROM {src})""",
            f"""placed AS (SELECT {key}, unnest(tl) AS token, unnest(generate_series(1, len(tl))) AS spot FROM token_lists)""",
            f"""weighed AS (
  SELECT p.*, coalesce(l.milli, 0) * CASE WHEN max(CASE WHEN p.token IN ({', '.join(map(quote, NEGATIONS))}) THEN 1 ELSE 0 END)
    OVER (PARTITION BY {key} ORDER BY spot ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 1 THEN -74 ELSE 100 END AS v
  FROM placed p LEFT JOIN lexicon l ON p.token = l.token)""",
            f"""summed AS (
  SELECT {key}, sum(v) AS s_u, sum(v + 100000) FILTER (WHERE v > 0) AS pos_u, sum(v - 100000) FILTER (WHERE v < 0) AS neg_u,
    count(*) FILTER (WHERE v <> 0) AS n_scored FROM weighed GROUP BY {key})""",
            f"""filled AS (
  SELECT {', '.join(f't.{i}' for i in ids)}, len(t.tl) AS n_tokens, coalesce(s_u, 0) AS s_u, coalesce(pos_u, 0) AS pos_u, coalesce(neg_u, 0) AS neg_u,
    coalesce(n_scored, 0) AS n_scored FROM token_lists t LEFT JOIN summed s ON {' AND '.join(f't.{i} = s.{i}' for i in ids)})""",
            f"""scores AS (
  SELECT {key}, n_tokens, {share(f'CAST(pos_u AS DOUBLE) / {unit}')} AS sentiment_pos, {share(f'CAST(neg_u AS DOUBLE) / {unit}')} AS sentiment_neg,
    {share('CAST(n_tokens - n_scored AS DOUBLE)')} AS sentiment_neu,
    {r(f"(CAST(s_u AS DOUBLE) / {unit}) / sqrt((CAST(s_u AS DOUBLE) / {unit}) * (CAST(s_u AS DOUBLE) / {unit}) + {dbl('15.0')})", 4)} AS sentiment_compound
  FROM filled)"""]


SCORES = "sentiment_pos, sentiment_neg, sentiment_neu, sentiment_compound"
for _src, _ids in (("documents", ["doc_id"]), ("conversations", ["conv_id", "turn"])):
    SQL[f"lexicon_score_{_src}"] = with_(*scored(_src, _ids, "text")) + f"""
SELECT {', '.join(_ids)}, CAST(n_tokens AS BIGINT) AS n_tokens, {SCORES}, {polarity('sentiment_compound')} AS sentiment_label FROM scores"""

# Phrases, boosters and contrast: entries of one to three words by joining all runs of a text.
RULE = "CAST(round(CAST((length({x}) * 17 + length(replace({x}, 'e', '')) * 5) % 41 - 20 AS DOUBLE) / 10.0 * 1000) AS BIGINT)"
SQL["lexicon_phrase_scores"] = with_(
    LEXICON_SQL,
    f"items AS (SELECT {SPLIT.format(x='text')} AS tl FROM benchmark)",
    f"""entries AS (
  SELECT token AS entry, milli FROM lexicon
  UNION ALL SELECT entry, {RULE.format(x='entry')} FROM (
    SELECT DISTINCT array_to_string(tl[i:i + k - 1], ' ') AS entry FROM (
      SELECT tl, k, unnest(generate_series(1, len(tl) - k + 1)) AS i FROM items, (VALUES (2), (3)) AS s(k) WHERE len(tl) >= k))
  WHERE length(entry) % 3 = 0)""",
    """boosters AS (SELECT DISTINCT token, CASE WHEN contains(token, 'r') THEN -293 ELSE 293 END AS amount
  FROM (SELECT unnest(tl) AS token FROM items) WHERE length(token) % 4 = 2)""",
    f"token_lists AS (SELECT doc_id, {SPLIT.format(x='text')} AS tl FROM documents)",
    "spots AS (SELECT doc_id, tl, unnest(tl) AS token, unnest(generate_series(1, len(tl))) AS spot FROM token_lists)",
    """hits AS (
  SELECT doc_id, spot, k AS n, milli FROM (SELECT doc_id, spot, k, array_to_string(tl[spot:spot + k - 1], ' ') AS g
    FROM spots, (VALUES (1), (2), (3)) AS s(k) WHERE spot + k - 1 <= len(tl)) JOIN entries ON g = entry
  QUALIFY row_number() OVER (PARTITION BY doc_id, spot ORDER BY k DESC) = 1)""",
    """beaten AS (
  SELECT a.doc_id, a.spot FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND b.spot BETWEEN a.spot - 2 AND a.spot + 2 AND b.spot <> a.spot
  WHERE b.spot < a.spot + a.n AND a.spot < b.spot + b.n AND (b.n > a.n OR b.n = a.n AND b.spot < a.spot))""",
    """around AS (
  SELECT s.doc_id, spot, 100 * coalesce(lag(amount, 1) OVER w, 0) + 95 * coalesce(lag(amount, 2) OVER w, 0) + 90 * coalesce(lag(amount, 3) OVER w, 0) AS boost,
    max(CASE WHEN token IN (""" + ", ".join(map(quote, NEGATIONS)) + """) THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 1 AS negated,
    min(CASE WHEN token IN ('with', 'avec', 'mit', 'con') THEN spot END) OVER (PARTITION BY s.doc_id) AS turn
  FROM spots s LEFT JOIN boosters USING (token) WINDOW w AS (PARTITION BY s.doc_id ORDER BY spot))""",
    """valued AS (
  SELECT doc_id, n, CASE WHEN milli = 0 THEN 0 ELSE (milli * 100 + sign(milli) * boost) * CASE WHEN negated THEN -74 ELSE 100 END
    * CASE WHEN turn IS NULL OR spot = turn THEN 100 WHEN spot < turn THEN 50 ELSE 150 END END AS v
  FROM hits ANTI JOIN beaten USING (doc_id, spot) JOIN around USING (doc_id, spot))""",
    """sums AS (
  SELECT doc_id, sum(v) AS s_u, sum(v + 1000000000) FILTER (WHERE v > 0) AS pos_u, sum(v - 1000000000) FILTER (WHERE v < 0) AS neg_u,
    sum(n) FILTER (WHERE v <> 0) AS n_scored FROM valued GROUP BY doc_id)""",
    """totals AS (SELECT doc_id, len(tl) AS n_tokens, coalesce(s_u, 0) AS s_u, coalesce(pos_u, 0) AS pos_u, coalesce(neg_u, 0) AS neg_u,
    coalesce(n_scored, 0) AS n_scored FROM token_lists LEFT JOIN sums USING (doc_id))""",
    *(lambda unit, total: [f"""scores AS (
  SELECT doc_id, n_tokens, {', '.join(f"CASE WHEN {total} > 0 THEN {r(f'abs(({x}) / {total})', 3)} ELSE 0.0 END AS sentiment_{n}" for n, x in (
      ('pos', f'CAST(pos_u AS DOUBLE) / {unit}'), ('neg', f'CAST(neg_u AS DOUBLE) / {unit}'), ('neu', 'CAST(n_tokens - n_scored AS DOUBLE)')))},
    {r(f"(CAST(s_u AS DOUBLE) / {unit}) / sqrt((CAST(s_u AS DOUBLE) / {unit}) * (CAST(s_u AS DOUBLE) / {unit}) + {dbl('15.0')})", 4)} AS sentiment_compound
  FROM totals)"""])(dbl("1000000000.0"), f"(CAST(pos_u - neg_u AS DOUBLE) / {dbl('1000000000.0')} + CAST(n_tokens - n_scored AS DOUBLE))")) + f"""
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens, {SCORES}, {polarity('sentiment_compound')} AS sentiment_label FROM scores"""

WATCHED = "'BTC.X', 'ETH.X', 'SOL.X', 'AAPL', 'TSLA', 'NVDA'"
SOCIAL = """social AS (
  SELECT * EXCLUDE (sentiment_compound), row_id // 100 AS page, max(ingested_at) OVER (PARTITION BY symbol, row_id // 100) AS polled_at
  FROM messages)"""
PAGE_PLACE = "CASE symbol WHEN 'BTC.X' THEN 0 WHEN 'ETH.X' THEN 1 WHEN 'SOL.X' THEN 2 WHEN 'AAPL' THEN 3 WHEN 'DOGE.X' THEN 4 ELSE 5 END"
NEWS = """news AS (
  SELECT * EXCLUDE (sentiment_compound), concat_ws(' ', title, description) AS score_text,
    max(ingested_at) OVER (PARTITION BY query, row_id // 20) AS polled_at FROM articles)"""
SOCIAL_SCORED = [MESSAGES, SOCIAL, *scored("social", ["row_id"], "body")]
NEWS_SCORED = [ARTICLES, NEWS, *scored("news", ["row_id"], "score_text")]
NEWS_WATCHED = ", ".join(map(quote, ("bitcoin cryptocurrency", "ethereum crypto", "stock market Wall Street", "NASDAQ S&P 500", "Tesla Apple Nvidia earnings")))

SOCIAL_RECORDS = f"""SELECT CAST(m.row_id AS VARCHAR) AS message_id, m.symbol, m.body, m.created_at, m.polled_at AS ingested_at, {USER}, {SCORES},
  {polarity('sentiment_compound')} AS sentiment_label, {agreement('sentiment_compound')} AS sentiment_agreement
FROM social m JOIN scores s ON m.row_id = s.row_id WHERE m.symbol IN ({WATCHED})"""
NEWS_RECORDS = f"""SELECT md5(coalesce(a.url, '')) AS article_id, a.query, a.source, a.author, a.title, a.description, a.url, a.published_at,
  a.polled_at AS ingested_at, {SCORES}, {polarity('sentiment_compound')} AS sentiment_label
FROM news a JOIN scores s ON a.row_id = s.row_id WHERE a.query IN ({NEWS_WATCHED})"""

SQL["normalize_social_payload"] = with_(*SOCIAL_SCORED) + f"""
SELECT *, symbol AS symbols_mentioned_csv, 'stocktwits' AS data_source, FALSE AS quarantined FROM ({SOCIAL_RECORDS})"""
SQL["normalize_news_payload"] = with_(*NEWS_SCORED) + f"SELECT *, 'newsapi' AS data_source FROM ({NEWS_RECORDS})"

SQL["latest_n_per_query"] = with_(ARTICLES) + """
SELECT article_id, query, title, published_at FROM articles
WHERE published_at >= CAST(CAST(TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 24 HOUR AS DATE) AS TIMESTAMP)
QUALIFY row_number() OVER (PARTITION BY query ORDER BY published_at DESC NULLS LAST, article_id NULLS FIRST) <= 20"""

SQL["dedup_first_wins"] = """
SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars, text FROM documents
QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1"""

# Pages polled again come 10^9 offsets later; the first arrival of an id stays.
SQL["dedup_messages"] = with_(MESSAGES, SOCIAL) + f""",
polled AS (
  SELECT row_id, symbol, page * 10 + {PAGE_PLACE} AS o, row_number() OVER (PARTITION BY symbol, page ORDER BY row_id DESC) - 1 AS spot FROM social),
arrivals AS (
  SELECT row_id, symbol, o * 1000 + spot AS arrival FROM polled
  UNION ALL SELECT row_id, symbol, (o + 1000000000) * 1000 + spot FROM polled WHERE o % 3 = 0)
SELECT CAST(row_id AS VARCHAR) AS message_id, min_by(symbol, arrival) AS symbol, min(arrival) AS arrival FROM arrivals GROUP BY row_id"""

# Producers over damaged payloads: where every landed entry goes.
NEWS_PLACE = f"CASE query {' '.join(f'WHEN {q} THEN {i}' for i, q in enumerate(NEWS_WATCHED.split(', ')))} ELSE 5 END"
ENTRIES = [TICKS, MESSAGES, ARTICLES, SOCIAL, NEWS, f"""entries AS (
  SELECT 'tick' AS kind, row_id AS o, 0 AS spot, 'o' || row_id AS page, row_id AS ident, symbol IS NULL AS no_symbol, FALSE AS off_list,
    row_id % 17 = 3 AS torn, CASE WHEN row_id % 13 = 5 THEN 'bad number' END AS reason FROM ticks
  UNION ALL
  SELECT 'message', page * 10 + {PAGE_PLACE}, row_number() OVER (PARTITION BY symbol, page ORDER BY row_id DESC) - 1, NULL, row_id, FALSE,
    symbol IS NULL OR symbol NOT IN ({WATCHED}), (page * 10 + {PAGE_PLACE}) % 11 = 5, CASE WHEN CAST(user_id AS BIGINT) % 10 = 7 THEN 'bad number' END FROM social
  UNION ALL
  SELECT 'article', o, row_number() OVER (PARTITION BY o ORDER BY row_id) - 1, NULL, first_id, FALSE,
    query NOT IN ({NEWS_WATCHED}), o % 11 = 5, CASE WHEN o % 7 = 3 THEN 'status' END
  FROM (SELECT *, row_id // 20 * 8 + {NEWS_PLACE} AS o, min(row_id) OVER (PARTITION BY coalesce(url, '')) AS first_id FROM news)),
polled AS (SELECT * EXCLUDE (page) FROM entries
  UNION ALL SELECT * EXCLUDE (page) REPLACE (o + 1000000000 AS o) FROM entries WHERE kind <> 'tick' AND o % 3 = 0),
landed_entries AS (
  SELECT kind, o, spot, ident, no_symbol, off_list, CASE WHEN NOT off_list AND NOT no_symbol THEN reason END AS reason FROM polled WHERE NOT torn
  UNION ALL SELECT kind, o, 0, NULL, FALSE, FALSE, 'unreadable' FROM polled WHERE torn GROUP BY kind, o)"""]
SQL["publish_rejects"] = with_(*ENTRIES) + """
SELECT kind, o AS "offset", CAST(spot AS INTEGER) AS pos, reason FROM landed_entries WHERE reason IS NOT NULL"""
SQL["publish_reconciliation"] = with_(*ENTRIES) + """
SELECT kind, count(*) AS landed, published, count(*) FILTER (WHERE good) - published AS repeated, count(*) FILTER (WHERE off_list) AS off_list,
  count(*) FILTER (WHERE no_symbol) AS no_symbol, count(reason) AS quarantined, 0 AS unexplained
FROM (SELECT *, reason IS NULL AND NOT off_list AND NOT no_symbol AS good FROM landed_entries)
  JOIN (SELECT kind, count(DISTINCT ident) FILTER (WHERE reason IS NULL AND NOT off_list AND NOT no_symbol) AS published FROM landed_entries GROUP BY kind) USING (kind)
GROUP BY kind, published"""

SQL["polarity_class"] = with_(*facts("message")) + "SELECT message_id, sentiment_compound, sentiment_label FROM stg_sentiment"
SQL["label_agreement"] = with_(*facts("message")) + "SELECT message_id, user_sentiment, sentiment_compound, sentiment_agreement FROM stg_sentiment"


# --- quality ------------------------------------------------------------------------

CHECKS_SQL = [
    ("not_null", "stg_crypto_prices", "symbol", None),
    ("accepted_values", "stg_crypto_prices", "symbol", "'BTCUSDT', 'ETHUSDT', 'SOLUSDT'"),
    ("not_null", "stg_crypto_prices", "price", None),
    ("accepted_values", "stg_crypto_prices", "price_direction", "'bullish', 'bearish', 'neutral'"),
    ("not_null", "stg_sentiment", "message_id", None),
    ("unique", "stg_sentiment", "message_id", None),
    ("accepted_values", "stg_sentiment", "final_sentiment", "'bullish', 'bearish', 'neutral'"),
    ("not_null", "stg_sentiment", "influence_score", None),
    ("not_null", "stg_news", "article_id", None),
    ("unique", "stg_news", "article_id", None),
    ("accepted_values", "stg_news", "sentiment_strength", "'strong_positive', 'mild_positive', 'neutral', 'mild_negative', 'strong_negative'"),
]


def _failing(kind, model, col, values) -> str:
    which = {"not_null": f"{col} IS NULL", "unique": f"{col} IS NOT NULL", "accepted_values": f"{col} NOT IN ({values})"}[kind]
    least = 2 if kind == "unique" else 1
    return (f"SELECT '{kind}_{model}_{col}' AS test_name, '{model}' AS model, '{col}' AS column_name, CAST({col} AS VARCHAR) AS value, "
            f"count(*) AS n_records FROM {model} WHERE {which} GROUP BY {col} HAVING count(*) >= {least}")


LANDED = [TICKS, tick_facts(valid="TRUE"), MESSAGES, "landed_messages AS (SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE row_id % 5 = 0)",
          message_facts(valid="TRUE", source="landed_messages"), ARTICLES,
          "landed_articles AS (SELECT * FROM articles UNION ALL SELECT * FROM articles WHERE row_id % 3 = 0)", article_facts(valid="TRUE", source="landed_articles")]

for _kind in ("not_null", "unique", "accepted_values"):
    SQL[f"dq_{_kind}"] = with_(*LANDED) + "\nUNION ALL\n".join(_failing(*c) for c in CHECKS_SQL if c[0] == _kind)

REDATED = [MESSAGES, "redated_messages AS (SELECT * FROM messages UNION ALL SELECT * FROM messages WHERE row_id % 97 = 0)",
           message_facts(valid="TRUE", source="redated_messages"), ARTICLES,
           "redated_articles AS (SELECT * FROM articles UNION ALL SELECT * FROM articles WHERE row_id % 41 = 0)",
           article_facts(valid="TRUE", source="redated_articles")]
SQL["dq_unique_incremental"] = with_(*REDATED) + "\nUNION ALL\n".join(_failing(*c) for c in CHECKS_SQL if c[0] == "unique")


def _verdicts(tables: list[str]) -> str:
    rows = [f"""SELECT '{k}_{m}_{c}' AS test_name, '{m}' AS model, '{c}' AS column_name, '{k}' AS test_kind,
  (SELECT {'coalesce(sum(n_records), 0)' if k == 'not_null' else 'count(*)'} FROM ({_failing(k, m, c, v)})) AS failures""" for k, m, c, v in CHECKS_SQL]
    return with_(*tables) + f"""SELECT test_name, model, column_name, test_kind, CAST(failures AS BIGINT) AS failures, failures <> 0 AS should_warn,
  failures <> 0 AS should_error, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({' UNION ALL '.join(rows)})"""


SQL["dq_report"] = _verdicts(facts("tick", "message", "article"))
SQL["dq_report_landed"] = _verdicts(LANDED)

# Both dominant-direction implementations answer the same SQL.
SQL["hourly_price_rollup_mode"] = SQL["hourly_price_rollup"]


# --- streams: the SQL of the batch twins, and where records go -------------------------

SQL["stream_tick_silver"] = SQL["tick_silver"]
SQL["stream_message_dedup"] = SQL["message_silver"]
SQL["batch_preview"] = with_(TICKS) + "SELECT symbol, price, ingested_at FROM ticks WHERE price IS NOT NULL ORDER BY ingested_at, row_id LIMIT 3"
SQL["stream_processing_time"] = SQL["stream_log_replay"] = SQL["stream_seen_keys"] = SQL["message_silver"]
SQL["stream_article_silver"] = with_(*facts("article")) + "SELECT * EXCLUDE (ingested_at) FROM stg_news"
SQL["stream_latest_n"] = SQL["latest_n_per_query"]
SQL["stream_mood_changelog"] = SQL["stream_market_mood_refresh"] = SQL["market_mood"]

REPLAYED = """{kind}_copies AS (
  SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE row_id % 53 <> 0 AND row_id % 7 = 0 UNION ALL SELECT * FROM {table} WHERE row_id % 3 = 0)"""
KINDS = {"tick": ("ticks", "symbol IS NULL", "price > 0", "row_id"),
         "message": ("messages", "message_id IS NULL OR symbol IS NULL", "TRUE", "message_id"),
         "article": ("articles", "article_id IS NULL", "title IS NOT NULL", "article_id")}


def _whereabouts(kind: str) -> str:
    """landed = bronze + quarantined; bronze = silver + repeated + invalid."""
    table, keyless, valid, ident = KINDS[kind]
    src = table if kind == "tick" else f"{kind}_copies"
    return f"""SELECT '{kind}' AS kind, n + noise AS landed, n - keyless AS bronze, firsts AS silver, valid - firsts AS repeated,
  n - keyless - valid AS invalid, keyless + noise AS quarantined, 0 AS unexplained
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {keyless}) AS keyless, count(*) FILTER (WHERE NOT ({keyless}) AND {valid}) AS valid,
        count(DISTINCT {ident}) FILTER (WHERE NOT ({keyless}) AND {valid}) AS firsts FROM {src}),
     (SELECT count(*) AS noise FROM {table} WHERE row_id % 101 = 0)"""


REPLAYS = [TICKS, MESSAGES, ARTICLES, *[REPLAYED.format(kind=k, table=KINDS[k][0]) for k in ("message", "article")]]
SQL["stream_reconciliation"] = with_(*REPLAYS) + "\nUNION ALL\n".join(_whereabouts(k) for k in KINDS)
SQL["stream_batch_counts"] = with_(*REPLAYS, f"w AS ({_whereabouts('message')})") + """
SELECT 'bronze' AS layer, bronze AS n_rows FROM w UNION ALL SELECT 'silver', silver FROM w UNION ALL SELECT 'quarantine', quarantined FROM w"""

SQL["layer_schema_evolution"] = """
SELECT event_id, lpad(CAST(user_id AS VARCHAR), 6, '0') AS symbol, CASE WHEN event_id % 2 = 1 THEN value END AS price, CAST(ts AS DATE) AS event_date FROM events"""

SQL["hourly_top_word"] = with_(MESSAGES) + f"""
SELECT * FROM (SELECT CAST(created_at AS DATE) AS date, CAST(hour(created_at) AS INTEGER) AS hour, word, count(*) AS n
  FROM (SELECT created_at, unnest({SPLIT.format(x='body')}) AS word FROM messages) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY date, hour ORDER BY n DESC, word) = 1"""
SQL["variant_ingest"] = with_(TICKS) + """
SELECT row_id AS "offset", CASE WHEN torn THEN 'no json' WHEN symbol IS NULL THEN 'incomplete' ELSE 'record' END AS status,
  CASE WHEN NOT torn THEN symbol END AS symbol, CASE WHEN NOT torn THEN price END AS price, CASE WHEN NOT torn THEN ingested_at END AS ingested_at,
  CASE WHEN NOT torn AND row_id % 4 = 0 THEN 'V' || (row_id % 3) END AS venue
FROM (SELECT *, row_id % 17 IN (3, 4) AS torn FROM ticks)"""

# A rebuild from silver since the 15th shows nothing older.
_SINCE = {"tick": "ingested_at", "message": "created_at", "article": "published_at"}
SQL["gold_rebuild"] = SQL["crypto_dashboard"]
for _k, _t in (("tick", "ticks"), ("message", "messages"), ("article", "articles")):
    _fact = FACTS[_k][1]
    SQL["gold_rebuild"] = SQL["gold_rebuild"].replace(
        _fact, _fact.replace(f"FROM {_t} WHERE ", f"FROM {_t} WHERE CAST({_SINCE[_k]} AS DATE) >= DATE '2024-01-15' AND "))

SQL["gold_publish"] = f"SELECT * FROM ({SQL['crypto_dashboard']}) WHERE symbol <> 'DOGEUSDT'"

# Stateful mood: the hours the watermark closed, i.e. window end at or before
# the smaller of the two streams' (latest event time - 2 hours).
SQL["stream_market_mood_stateful"] = SQL["market_mood"] + """
WHERE CAST(date AS TIMESTAMP) + to_hours(CAST(hour + 1 AS BIGINT)) <= (
  SELECT least((SELECT max(created_at) FROM stg_sentiment), (SELECT max(published_at) FROM stg_news)) - INTERVAL 2 HOUR)"""


# --- keyed publish ---------------------------------------------------------------------

# Keyed publish: the JSON text exactly as the JVM writes it. Doubles use the
# JVM's rendering: plain decimal for 1e-3 <= |x| < 1e7 (DuckDB's shortest
# text; an integral value keeps ".0"), otherwise d.dddE<exp> with the same
# shortest digits. NULL members are omitted (concat_ws skips NULLs).
def jvm_double(x: str) -> str:
    a = f"CAST(abs({x}) AS VARCHAR)"
    small_zeros = f"length(regexp_extract({a}, '^0\\.(0*)', 1))"
    small_digits = f"regexp_extract({a}, '^0\\.0*([0-9]+)$', 1)"
    big_int = f"regexp_extract({a}, '^([0-9]+)', 1)"
    big_digits = f"rtrim({big_int} || regexp_extract({a}, '\\.([0-9]+)$', 1), '0')"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '' END"

    def sci(digits: str, exp: str) -> str:
        return (f"{sign} || substr({digits}, 1, 1) || '.' || coalesce(nullif(substr({digits}, 2), ''), '0')"
                f" || 'E' || CAST({exp} AS VARCHAR)")
    e_mant = f"regexp_extract({a}, '^([0-9.]+)e', 1)"
    e_mant_jvm = f"CASE WHEN contains({e_mant}, '.') THEN {e_mant} ELSE {e_mant} || '.0' END"
    e_exp = f"CAST(CAST(regexp_extract({a}, 'e([-+]?[0-9]+)$', 1) AS INTEGER) AS VARCHAR)"
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN {x} = 0 OR (abs({x}) >= 0.001 AND abs({x}) < 10000000) THEN CAST({x} AS VARCHAR) "
            f"WHEN contains({a}, 'e') THEN {sign} || {e_mant_jvm} || 'E' || {e_exp} "
            f"WHEN abs({x}) < 0.001 THEN {sci(small_digits, f'-({small_zeros} + 1)')} "
            f"ELSE {sci(big_digits, f'length({big_int}) - 1')} END")



def _object(members: list[tuple[str, str]]) -> str:
    """A JSON object text; members that are NULL are left out."""
    parts = ",\n    ".join(f"""'"{name}":' || ({value})""" for name, value in members)
    return f"'{{' || concat_ws(',',\n    {parts}) || '}}'"


def _text(c: str) -> tuple[str, str]:
    return c, f"to_json({c})"


def _number(c: str) -> tuple[str, str]:
    return c, jvm_double(c)


def _whole(c: str) -> tuple[str, str]:
    return c, f"CAST({c} AS VARCHAR)"


def _time(c: str) -> tuple[str, str]:
    return c, f"to_json(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00'))"


_PRICES = [_number(c) for c in ("price", "open", "high", "low", "volume", "price_change", "change_pct")]
_SCORES = [_number(c) for c in ("sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_compound")]
TICK_JSON = _object([_text("symbol"), *_PRICES, _time("ingested_at"), _text("source")])
MESSAGE_JSON = _object([_text("message_id"), _text("symbol"), _text("body"), _time("created_at"), _time("ingested_at"), _text("user_id"), _text("username"),
                        *[_whole(c) for c in ("user_followers", "user_following", "user_ideas", "user_watchlist_count")], _text("user_sentiment"),
                        *_SCORES, _text("sentiment_label"), _whole("sentiment_agreement"), ("symbols_mentioned", "'[' || to_json(symbol) || ']'"),
                        _text("data_source")])
ARTICLE_JSON = _object([*[_text(c) for c in ("article_id", "query", "source", "author", "title", "description", "url")],
                        _time("published_at"), _time("ingested_at"), *_SCORES, _text("sentiment_label"), _text("data_source")])

SQL["keyed_publish"] = with_(TICKS) + f"SELECT 'crypto.prices' AS topic, symbol AS key, {TICK_JSON} AS value FROM ticks"
SQL["keyed_publish_news"] = f"""SELECT 'market.news' AS topic, substring(query, 1, 50) AS key, {ARTICLE_JSON} AS value
FROM ({SQL['parse_articles_json']})"""
SQL["publish_ticks"] = f"SELECT 'crypto.prices' AS topic, symbol AS key, {TICK_JSON} AS value FROM ({SQL['normalize_ticker_payload']})"
SQL["publish_social"] = with_(*SOCIAL_SCORED) + f"""SELECT 'market.sentiment' AS topic, symbol AS key, {MESSAGE_JSON} AS value
FROM (SELECT *, 'stocktwits' AS data_source FROM ({SOCIAL_RECORDS}))"""
SQL["publish_news"] = with_(*NEWS_SCORED) + f"""SELECT 'market.news' AS topic, substring(query, 1, 50) AS key, {ARTICLE_JSON} AS value
FROM (SELECT *, 'newsapi' AS data_source FROM ({NEWS_RECORDS}))"""
SQL["publish_twice"] = SQL["publish_ticks"]
