"""Wire records, raw landing payloads and their parsers.

Landing tables have the shape of a message-queue record:
``(key string, value string, offset bigint, ingested_at timestamp)``.
Everything here is a per-row projection (``from_json`` / ``to_json`` /
``explode``), so it runs identically on batch and streaming DataFrames and
never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart import schemas as SC
from sentimart.functions import enrich as R
from sentimart.sources import topic_log

CORRUPT = "_corrupt_record"
ISO_MICROS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def iso_utc(ts) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and a UTC offset."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz"), ISO_MICROS_UTC)


# --- wire records (PRJ-1..3, FN-1..5) --------------------------------------

def wire_value(parsed: DataFrame, kind: str) -> Column:
    """JSON text of a parsed record, times as ISO strings (FN-3)."""
    times = set(SC.TIME_COLUMNS[kind])
    fields = [iso_utc(f.name).alias(f.name) if f.name in times else F.col(f.name)
              for f in SC.WIRE[kind].fields]
    return F.to_json(F.struct(*fields))


def to_wire(parsed: DataFrame, kind: str, keep: list | None = None) -> DataFrame:
    """Parsed record -> one JSON text per row."""
    return parsed.select(*(keep or []), wire_value(parsed, kind).alias("value"))


def parse_records(raw: DataFrame, kind: str, keep: list[str] | None = None) -> DataFrame:
    """JSON value -> typed record (permissive: unknown keys dropped, bad
    values NULL), time strings parsed with ``try_to_timestamp`` (an empty or
    malformed time is NULL, not an error), plus ``processed_at``."""
    schema = SC.WIRE[kind]
    keep = keep or []
    d = raw.select(*keep, F.from_json(F.col("value").cast("string"), schema).alias("d")).select(*keep, "d.*")
    d = d.withColumns({c: F.try_to_timestamp(F.col(c)) for c in SC.TIME_COLUMNS[kind]})
    return d.withColumn("processed_at", F.current_timestamp())


#: Keys a record must carry; without them it is no record of its kind.
REQUIRED = {"tick": ("symbol",), "message": ("message_id", "symbol"), "article": ("article_id",)}


def split_quarantine(raw: DataFrame, kind: str, keep: list[str] | None = None) -> DataFrame:
    """FLT-7: parse and flag, never drop.

    ``quarantined``: the value is not JSON, or lacks a required key.
    ``malformed``: the record stands, but a field of the wrong type reads
    NULL. Both keep their original text in ``_corrupt_record``, so callers
    can route quarantined rows to a table of their own and repair the rest.
    """
    keep = keep or []
    schema = T.StructType(SC.WIRE[kind].fields + [T.StructField(CORRUPT, T.StringType(), True)])
    text = F.col("value").cast("string")
    record = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a generator, so that no filter on the record's fields is moved below it and parses each text again
    d = raw.select(*keep, text.alias("_text"), F.inline(F.array(record)))
    d = d.withColumns({c: F.try_to_timestamp(F.col(c)) for c in SC.TIME_COLUMNS[kind]})
    lacking = F.lit(False)
    for c in REQUIRED[kind]:
        lacking = lacking | F.col(c).isNull()
    return (d.withColumn("quarantined", lacking)
            .withColumn("malformed", F.col(CORRUPT).isNotNull() & ~lacking)
            .withColumn(CORRUPT, F.when(F.col("quarantined") | F.col("malformed"), F.col("_text")))
            .drop("_text")
            .withColumn("processed_at", F.current_timestamp()))


# --- keyed publish (SNK-6) --------------------------------------------------

PUBLISH_KEY = {"tick": "symbol", "message": "symbol", "article": "query"}


def keyed_records(parsed: DataFrame, kind: str) -> DataFrame:
    """(topic, key, value): key = symbol, or the first 50 characters of the
    news query (FN-24); value = the JSON wire record."""
    key = F.col(PUBLISH_KEY[kind])
    if kind == "article":
        key = F.substring(key, 1, R.PUBLISH_KEY_CHARS)
    return parsed.select(F.lit(R.TOPICS[kind]).alias("topic"), key.alias("key"),
                         wire_value(parsed, kind).alias("value"))


# --- raw payloads: normalisers (SRC-6..8) ----------------------------------

def _number(field: Column, to: str, default) -> tuple[Column, Column]:
    """Missing -> default; present but unparsable -> NULL and a bad flag."""
    v = F.when(field.isNull(), F.lit(default).cast(to)).otherwise(field.try_cast(to))
    bad = field.isNotNull() & field.try_cast(to).isNull()
    return v, bad


TICKER_FIELDS = [("price", "c"), ("open", "o"), ("high", "h"), ("low", "l"),
                 ("volume", "v"), ("price_change", "p"), ("change_pct", "P")]


ENVELOPE = {"tick": (SC.TICKER_PAYLOAD, "data"), "message": (SC.SOCIAL_PAYLOAD, "messages"), "article": (SC.NEWS_PAYLOAD, "articles")}


def unreadable(landing: DataFrame, kind: str) -> DataFrame:
    """``(offset, pos, value)`` of what no normaliser turns into a row: payloads
    that are not JSON or lack their envelope (with their text), and null
    entries of a page. A page without entries holds nothing and is not listed."""
    schema, field = ENVELOPE[kind]
    text = F.col("value").cast("string")
    p = landing.select("offset", text.alias("value"), F.from_json(text, schema)[field].alias("e"))
    torn = p.filter(F.col("e").isNull()).select("offset", F.lit(0).alias("pos"), "value")
    if kind == "tick":
        return torn
    entries = p.select("offset", F.posexplode("e").alias("pos", "entry")).filter("entry is null")
    return torn.unionByName(entries.select("offset", "pos", F.lit("null").alias("value")))


def normalize_ticker(landing: DataFrame, source: str = R.DATA_SOURCES["tick"], raw: bool = False) -> DataFrame:
    """Ticker envelope ``{data:{s,c,o,h,l,v,p,P}}`` -> tick records.

    Symbol is upper-cased (missing -> '' and dropped, FLT-5); numbers arrive
    as strings: missing -> 0.0, unparsable -> the row is flagged
    ``quarantined`` (one bad record never aborts the batch)."""
    d = landing.select("offset", "ingested_at",
                       F.from_json(F.col("value").cast("string"), SC.TICKER_PAYLOAD).alias("p"))
    cols, bads = {}, []
    for name, f in TICKER_FIELDS:
        v, bad = _number(F.element_at(F.col("p.data"), F.lit(f)), "double", 0.0)
        cols[name] = v
        bads.append(bad)
    quarantined = F.col("p").isNull()
    for b in bads:
        quarantined = quarantined | b
    return (
        d.select(
            "offset", *([F.to_json("p.data").alias("value")] if raw else []),
            F.upper(F.coalesce(F.element_at(F.col("p.data"), F.lit("s")), F.lit(""))).alias("symbol"),
            *[c.alias(n) for n, c in cols.items()],
            F.col("ingested_at"),
            F.lit(source).alias("source"),
            quarantined.alias("quarantined"),
        )
        .filter(F.col("symbol") != "")
    )


SOCIAL_INTS = [("user_followers", "followers"), ("user_following", "following"),
               ("user_ideas", "ideas"), ("user_watchlist_count", "watchlist_stocks_count")]


def normalize_social(landing: DataFrame, raw: bool = False) -> DataFrame:
    """Social envelope ``{symbol, messages:[...]}`` -> message records
    without text scores (see :func:`sentimart.operators.scoring.attach_scores`).

    Nested user fields default to ''/0; the self label is the lower-cased
    ``entities.sentiment.basic`` or 'neutral' when absent or NULL; the
    mentioned symbols are extracted from the entity array (FN-27)."""
    p = landing.select("offset", "ingested_at",
                       F.from_json(F.col("value").cast("string"), SC.SOCIAL_PAYLOAD).alias("p"))
    # only the page's symbol goes along with each message, not the page
    p = p.select("offset", "ingested_at", F.col("p.symbol.symbol").alias("symbol"), F.col("p.messages").alias("messages"))
    m = p.select("offset", "ingested_at", "symbol", F.posexplode("messages").alias("msg_pos", "m"))
    m = m.filter(F.col("m").isNotNull())
    ints, bads = {}, []
    for name, f in SOCIAL_INTS:
        v, bad = _number(F.col(f"m.user.{f}"), "int", 0)
        ints[name] = v
        bads.append(bad)
    quarantined = F.lit(False)
    for b in bads:
        quarantined = quarantined | b
    return m.select(
        "offset", "msg_pos", *([F.to_json("m").alias("value")] if raw else []),
        F.coalesce(F.col("m.id"), F.lit("")).alias("message_id"),
        F.col("symbol"),
        F.coalesce(F.col("m.body"), F.lit("")).alias("body"),
        F.try_to_timestamp(F.coalesce(F.col("m.created_at"), F.lit(""))).alias("created_at"),
        F.col("ingested_at"),
        F.coalesce(F.col("m.user.id"), F.lit("")).alias("user_id"),
        F.coalesce(F.col("m.user.username"), F.lit("")).alias("username"),
        *[c.alias(n) for n, c in ints.items()],
        R.self_label("m.entities.sentiment.basic").alias("user_sentiment"),
        F.coalesce(F.transform(F.col("m.entities.symbols"),
                               lambda s: F.coalesce(s["symbol"], F.lit(""))),
                   F.array().cast("array<string>")).alias("symbols_mentioned"),
        F.lit(R.DATA_SOURCES["message"]).alias("data_source"),
        quarantined.alias("quarantined"),
    )


def normalize_news(landing: DataFrame, raw: bool = False) -> DataFrame:
    """News envelope ``{status, query, articles:[...]}`` -> article records
    without text scores. Id = md5(url); source name defaults to 'unknown';
    the text to score is title and description joined, skipping NULLs."""
    p = landing.select("offset", "ingested_at",
                       F.from_json(F.col("value").cast("string"), SC.NEWS_PAYLOAD).alias("p"))
    p = p.select("offset", "ingested_at", *[F.col(f"p.{c}").alias(c) for c in ("status", "query", "articles")])
    a = p.select("offset", "ingested_at", "status", "query", F.posexplode("articles").alias("art_pos", "a"))
    a = a.filter(F.col("a").isNotNull())
    url = F.coalesce(F.col("a.url"), F.lit(""))
    return a.select(
        "offset", "art_pos", *([F.to_json("a").alias("value")] if raw else []), "status",
        R.article_id("a.url").alias("article_id"),
        F.col("query"),
        F.coalesce(F.col("a.source.name"), F.lit(R.UNKNOWN_NEWS_SOURCE)).alias("source"),
        F.coalesce(F.col("a.author"), F.lit("")).alias("author"),
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        url.alias("url"),
        F.try_to_timestamp(F.coalesce(F.col("a.publishedAt"), F.lit(""))).alias("published_at"),
        F.col("ingested_at"),
        F.concat_ws(" ", F.col("a.title"), F.col("a.description")).alias("score_text"),
        F.lit(R.DATA_SOURCES["article"]).alias("data_source"),
    )


def watchlist_filter(df: DataFrame, column: str, watchlist: list[str]) -> DataFrame:
    """SRC-9: keep rows whose symbol / query is on the configured list."""
    return df.filter(F.col(column).isin(watchlist))


def publish(records: DataFrame, bootstrap: str | None = None, folder: str | None = None, log: str | None = None,
            writer: str | None = None, epoch: int | None = None, topics: tuple = tuple(R.TOPICS.values()),
            order: Column | None = None) -> None:
    """Write ``(topic, key, value)`` records (SNK-6).

    ``bootstrap``: to the broker, if its connector is on the classpath (the
    ``topic`` column routes each record). ``log``: to the topic logs under that
    folder, records of a key to one partition, in ``order`` if given; an ``epoch``
    of a ``writer`` is published once, however often it is tried. ``folder``: as one-JSON-per-line
    text files per topic, appended to. All are plain distributed writes.
    """
    if bootstrap:
        (records.select("topic", "key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).save())
    elif log is not None:
        for topic in topics:
            topic_log.append(records.filter(F.col("topic") == topic), f"{log.rstrip('/')}/{topic}", writer, epoch, order=order)
    elif folder is not None:
        records.select("topic", "value").write.mode("append").partitionBy("topic").text(folder)
    else:
        raise ValueError("name a broker, a log or a folder")
