"""Fixed schemas of the three wire records and their raw landing payloads.

All fields are nullable; ``from_json`` drops unknown keys and turns missing
or unparsable values into NULL. Timestamps travel as ISO-8601 strings.
"""

from pyspark.sql import types as T

S, D, I, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- wire records (JSON values on the three topics) -------------------------

TICK = _struct(
    ("symbol", S), ("price", D), ("open", D), ("high", D), ("low", D),
    ("volume", D), ("price_change", D), ("change_pct", D),
    ("ingested_at", S), ("source", S),
)

MESSAGE = _struct(
    ("message_id", S), ("symbol", S), ("body", S), ("created_at", S),
    ("ingested_at", S), ("user_id", S), ("username", S),
    ("user_followers", I), ("user_following", I), ("user_ideas", I),
    ("user_watchlist_count", I), ("user_sentiment", S),
    ("sentiment_pos", D), ("sentiment_neg", D), ("sentiment_neu", D),
    ("sentiment_compound", D), ("sentiment_label", S),
    ("sentiment_agreement", B), ("symbols_mentioned", T.ArrayType(S)),
    ("data_source", S),
)

ARTICLE = _struct(
    ("article_id", S), ("query", S), ("source", S), ("author", S),
    ("title", S), ("description", S), ("url", S), ("published_at", S),
    ("ingested_at", S), ("sentiment_pos", D), ("sentiment_neg", D),
    ("sentiment_neu", D), ("sentiment_compound", D), ("sentiment_label", S),
    ("data_source", S),
)

# Time columns parsed from strings after decoding, per record kind.
TIME_COLUMNS = {
    "tick": ("ingested_at",),
    "message": ("created_at", "ingested_at"),
    "article": ("published_at", "ingested_at"),
}

WIRE = {"tick": TICK, "message": MESSAGE, "article": ARTICLE}

# --- raw landing payloads (before normalisation) ----------------------------
# Numbers arrive as strings in the ticker envelope; they are read as strings
# and converted with try_cast so one bad field never aborts a batch.

# The ticker object uses keys that differ only by case ("p" absolute change,
# "P" percent change), so it is read as a case-sensitive map.
TICKER_PAYLOAD = _struct(("stream", S), ("data", T.MapType(S, S)))

SOCIAL_USER = _struct(
    ("id", S), ("username", S), ("followers", S), ("following", S),
    ("ideas", S), ("watchlist_stocks_count", S),
)

SOCIAL_PAYLOAD = _struct(
    ("symbol", _struct(("symbol", S))),
    ("messages", T.ArrayType(_struct(
        ("id", S), ("body", S), ("created_at", S),
        ("user", SOCIAL_USER),
        ("entities", _struct(
            ("sentiment", _struct(("basic", S))),
            ("symbols", T.ArrayType(_struct(("symbol", S)))),
        )),
    ))),
)

NEWS_PAYLOAD = _struct(
    ("status", S),
    ("query", S),
    ("articles", T.ArrayType(_struct(
        ("url", S), ("source", _struct(("id", S), ("name", S))),
        ("author", S), ("title", S), ("description", S), ("publishedAt", S),
    ))),
)
