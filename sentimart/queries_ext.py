"""Registered queries: ingest, text scoring, de-duplication, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentimart.functions import enrich as R
from sentimart.operators import dedup as DD
from sentimart.operators import phrases as PH
from sentimart.operators import quality as DQ
from sentimart.operators import scoring as SCO
from sentimart.operators import silver as SV
from sentimart.operators import staging as ST
from sentimart.operators.unique_index import UniqueIndex
from sentimart.plans.inputs import parsed_articles, staged
from sentimart.plans import producers as PR
from sentimart.queries import register
from sentimart.session import run_folder
from sentimart.sources import fixtures as FX
from sentimart.sources import landing as L
from sentimart.sources.catalog import read_table


def _csv(col: str):
    """FN-23: list -> delimited text (comparable across engines)."""
    return F.array_join(F.col(col), ",").alias(f"{col}_csv")


# --- ingest: wire JSON round trip (PRJ-1..3, FN-1..5) ------------------------

@register("parse_ticks_json")
def q_parse_ticks_json(spark, sf_dir):
    t = FX.ticks_from_events(read_table(spark, sf_dir, "events"))
    return L.parse_records(L.to_wire(t, "tick"), "tick").drop("processed_at")


@register("parse_messages_json")
def q_parse_messages_json(spark, sf_dir):
    m = FX.messages_from_events(read_table(spark, sf_dir, "events"))
    p = L.parse_records(L.to_wire(m, "message"), "message").drop("processed_at")
    return p.select(*[c for c in p.columns if c != "symbols_mentioned"], _csv("symbols_mentioned"))


@register("parse_articles_json")
def q_parse_articles_json(spark, sf_dir):
    a = FX.articles_from_pages(read_table(spark, sf_dir, "pages"))
    return L.parse_records(L.to_wire(a, "article"), "article").drop("processed_at")


@register("quarantine_split")
def q_quarantine_split(spark, sf_dir):
    """FLT-7: damaged wire records are flagged, never silently dropped; a bad
    field alone leaves the record standing."""
    raw = FX.tick_wire_landing(read_table(spark, sf_dir, "events"), corrupt=True)
    q = L.split_quarantine(raw, "tick", keep=["offset"])
    ok = ~F.col("quarantined")
    return q.select("offset", "quarantined", "malformed", F.when(ok, F.col("symbol")).alias("symbol"),
                    F.when(ok, F.col("price")).alias("price"))


@register("keyed_publish")
def q_keyed_publish(spark, sf_dir):
    """SNK-6: (topic, key, JSON value) records of every canonical tick."""
    t = FX.ticks_from_events(read_table(spark, sf_dir, "events"))
    return L.keyed_records(t, "tick")


@register("keyed_publish_news")
def q_keyed_publish_news(spark, sf_dir):
    """SNK-6 for articles: key = first 50 characters of the query (FN-24)."""
    a = FX.articles_from_pages(read_table(spark, sf_dir, "pages"))
    return L.keyed_records(a, "article")


@register("publish_ticks")
def q_publish_ticks(spark, sf_dir):
    """SRC-6, FLT-5, SNK-6 end to end: raw tickers to topic records."""
    return PR.ticks(FX.ticker_landing(read_table(spark, sf_dir, "events")))


@register("publish_social")
def q_publish_social(spark, sf_dir):
    """SRC-7, SRC-9, FLT-6, ENR-12..14, SNK-6 end to end, pages polled twice."""
    raw = FX.social_landing(read_table(spark, sf_dir, "events"), repolled=True)
    return PR.social(raw, lexicon(spark, sf_dir))


@register("publish_news")
def q_publish_news(spark, sf_dir):
    """SRC-8, SRC-9, FLT-6, ENR-14, SNK-6 end to end, pages polled twice."""
    raw = FX.news_landing(read_table(spark, sf_dir, "pages"), repolled=True)
    return PR.news(raw, lexicon(spark, sf_dir))


def damaged_landing(spark, sf_dir):
    """Raw payloads of every kind, polled twice, some of them damaged."""
    events, pages = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "pages")
    return {"tick": FX.ticker_landing(events, damaged=True), "message": FX.social_landing(events, repolled=True, damaged=True),
            "article": FX.news_landing(pages, repolled=True, damaged=True)}


@register("publish_rejects")
def q_publish_rejects(spark, sf_dir):
    """FLT-7 in the producers: every entry that cannot be published."""
    parts = [PR.rejects(raw, kind) for kind, raw in damaged_landing(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("kind", "offset", "pos", "reason")


@register("publish_reconciliation")
def q_publish_reconciliation(spark, sf_dir):
    """Landed = published + repeated + off-list + without symbol + quarantined, by kind."""
    parts = [PR.reconciliation(raw, kind) for kind, raw in damaged_landing(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- ingest: raw payload normalisers (SRC-6..9) -------------------------------

@register("normalize_ticker_payload")
def q_normalize_ticker_payload(spark, sf_dir):
    raw = FX.ticker_landing(read_table(spark, sf_dir, "events"))
    return L.normalize_ticker(raw)


def lexicon(spark, sf_dir):
    """The fixed lexicon and the words of the benchmark table: an input table,
    so that texts of the fixtures' invented languages score."""
    fixed = SCO.lexicon_table(spark)
    return fixed.unionByName(FX.lexicon_from_items(read_table(spark, sf_dir, "benchmark")).join(fixed, "token", "left_anti"))


def social_messages(spark, sf_dir):
    raw = FX.social_landing(read_table(spark, sf_dir, "events"))
    m = L.watchlist_filter(L.normalize_social(raw), "symbol", R.SOCIAL_SYMBOLS)
    m = SCO.attach_scores(m, ["offset", "msg_pos"], "body", lexicon(spark, sf_dir))
    return (m.withColumn("sentiment_label", R.polarity_class())
             .withColumn("sentiment_agreement", R.label_agreement()))


@register("normalize_social_payload")
def q_normalize_social_payload(spark, sf_dir):
    m = social_messages(spark, sf_dir)
    return m.select(
        "message_id", "symbol", "body", "created_at", "ingested_at", "user_id", "username",
        "user_followers", "user_following", "user_ideas", "user_watchlist_count",
        "user_sentiment", *SCO.SCORE_COLUMNS, "sentiment_label", "sentiment_agreement",
        _csv("symbols_mentioned"), "data_source", "quarantined")


@register("normalize_news_payload")
def q_normalize_news_payload(spark, sf_dir):
    raw = FX.news_landing(read_table(spark, sf_dir, "pages"))
    a = L.watchlist_filter(L.normalize_news(raw), "query", R.NEWS_QUERIES)
    a = SCO.attach_scores(a, ["offset", "art_pos"], "score_text", lexicon(spark, sf_dir))
    return a.select("article_id", "query", "source", "author", "title", "description", "url",
                    "published_at", "ingested_at", *SCO.SCORE_COLUMNS,
                    R.polarity_class().alias("sentiment_label"), "data_source")


# --- request semantics and de-duplication ------------------------------------

LATEST_REFERENCE_TIME = "2024-01-20 12:00:00"


@register("latest_n_per_query")
def q_latest_n_per_query(spark, sf_dir):
    """SRC-10/SORT-2: lookback from a reference time, newest 20 per query."""
    a = parsed_articles(spark, sf_dir).drop("processed_at")
    return DD.latest_per_query(a, LATEST_REFERENCE_TIME, 24, 20).select(
        "article_id", "query", "title", "published_at")


@register("dedup_first_wins")
def q_dedup_first_wins(spark, sf_dir):
    """STR-7 batch form: one document per exact text, the lowest id wins."""
    docs = read_table(spark, sf_dir, "documents")
    out = DD.first_wins(docs, [F.md5(F.col("text"))], "doc_id")
    return out.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars", "text")


@register("dedup_messages")
def q_dedup_messages(spark, sf_dir):
    """FLT-6: social messages de-duplicated on message id, first arrival wins."""
    raw = FX.social_landing(read_table(spark, sf_dir, "events"), repolled=True)
    m = PR.first_arrivals(L.normalize_social(raw), "message")
    return m.select("message_id", "symbol", (F.col("offset") * 1000 + F.col("msg_pos")).alias("arrival"))


# --- text (ENR-12..14) ----------------------------------------------------------

@register("polarity_class")
def q_polarity_class(spark, sf_dir):
    st = staged(spark, sf_dir)
    return st.sentiment.select("message_id", "sentiment_compound",
                               R.polarity_class().alias("sentiment_label"))


@register("label_agreement")
def q_label_agreement(spark, sf_dir):
    st = staged(spark, sf_dir)
    return st.sentiment.select("message_id", "user_sentiment", "sentiment_compound",
                               R.label_agreement().alias("sentiment_agreement"))


@register("lexicon_score_documents")
def q_lexicon_score_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    sc = SCO.score_texts(docs, ["doc_id"], "text", lexicon(spark, sf_dir))
    return sc.withColumn("sentiment_label", R.polarity_class())


@register("lexicon_score_conversations")
def q_lexicon_score_conversations(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    sc = SCO.score_texts(conv, ["conv_id", "turn"], "text", lexicon(spark, sf_dir))
    return sc.withColumn("sentiment_label", R.polarity_class())


#: Words of the fixtures' invented languages that serve as contrast words.
FIXTURE_CONTRAST = ["with", "avec", "mit", "con"]


@register("lexicon_phrase_scores")
def q_lexicon_phrase_scores(spark, sf_dir):
    """ENR-14 with entries of several words, boosters and contrast clauses; the
    phrase and booster tables come from the benchmark table."""
    items = read_table(spark, sf_dir, "benchmark")
    entries = lexicon(spark, sf_dir).withColumnRenamed("token", "entry").unionByName(FX.phrases_from_items(items))
    docs = read_table(spark, sf_dir, "documents")
    sc = PH.phrase_scores(docs, ["doc_id"], "text", entries, FX.boosters_from_items(items), FIXTURE_CONTRAST)
    return sc.withColumn("sentiment_label", R.polarity_class())


# --- quality (DQ-1..4) ----------------------------------------------------------

def _tables(spark, sf_dir):
    st = staged(spark, sf_dir)
    return {"stg_crypto_prices": st.prices, "stg_sentiment": st.sentiment, "stg_news": st.news}


def _landed_tables(spark, sf_dir):
    """The checked relations over records as they landed: no validity filter,
    and the copies that polling brings (one message in five, one article in three)."""
    events, pages = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "pages")
    messages = FX.messages_from_events(events).unionByName(FX.messages_from_events(events.filter("event_id % 5 = 0")))
    articles = FX.articles_from_pages(pages).unionByName(FX.articles_from_pages(pages.filter("page_id % 3 = 0")))
    return {"stg_crypto_prices": ST.stg_crypto_prices(SV.tick_silver(FX.ticks_from_events(events), guard=False), guard=False),
            "stg_sentiment": ST.stg_sentiment(SV.message_silver(messages, guard=False), guard=False),
            "stg_news": ST.stg_news(SV.article_silver(articles, guard=False), guard=False)}


@register("dq_not_null")
def q_dq_not_null(spark, sf_dir):
    return DQ.failures(_landed_tables(spark, sf_dir), "not_null")


@register("dq_unique")
def q_dq_unique(spark, sf_dir):
    return DQ.failures(_landed_tables(spark, sf_dir), "unique")


def _again_later(df, every: str, date: str):
    """``df`` and, of its rows ``every``, copies whose date is one to five days later."""
    later = F.col(date) + F.expr("make_interval(0, 0, 0, 1 + cast(_row % 5 as int))")
    return df.unionByName(df.where(every).withColumn(date, later)).drop("_row")


def _kept_by_date(spark, sf_dir):
    """``(model, key, date, table, path)``: the relations with a unique key as tables kept by date, with copies on other dates."""
    events, pages = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "pages")
    messages = FX.messages_from_events(events, [F.col("event_id").alias("_row")])
    articles = FX.articles_from_pages(pages, [F.col("page_id").alias("_row")])
    relations = {
        "stg_sentiment": ("message_id", "sentiment_date", ST.stg_sentiment(SV.message_silver(_again_later(messages, "_row % 97 = 0", "created_at"), guard=False), guard=False)),
        "stg_news": ("article_id", "publish_date", ST.stg_news(SV.article_silver(_again_later(articles, "_row % 41 = 0", "published_at"), guard=False), guard=False))}
    for model, (key, date, rows) in relations.items():
        path = f"{run_folder(spark, 'unique')}/{model}"
        rows = rows.select(key, date)
        rows.repartition(date, F.pmod(F.xxhash64(key), F.lit(4))).write.partitionBy(date).parquet(path)
        yield model, key, date, spark.read.schema(rows.schema).parquet(path), path


@register("dq_unique_incremental")
def q_dq_unique_incremental(spark, sf_dir):
    """DQ-2, AGG-11: all dates but the last three at once, then one date a step."""
    parts = []
    for model, key, date, rows, path in _kept_by_date(spark, sf_dir):
        index = UniqueIndex(f"{path}_index", key, date)
        dates = [r[0] for r in rows.select(date).distinct().orderBy(date).collect()]
        for step in [dates[:-3], *([d] for d in dates[-3:])]:
            index.add(rows, step, str(step[-1]) if step else "none")
        parts.append(index.failures(spark).select(
            F.lit(f"unique_{model}_{key}").alias("test_name"), F.lit(model).alias("model"), F.lit(key).alias("column_name"), "value", "n_records"))
    return parts[0].unionByName(parts[1])


@register("dq_accepted_values")
def q_dq_accepted_values(spark, sf_dir):
    return DQ.failures(_landed_tables(spark, sf_dir), "accepted_values")


@register("dq_report")
def q_dq_report(spark, sf_dir):
    return DQ.report(_tables(spark, sf_dir))


@register("dq_report_landed")
def q_dq_report_landed(spark, sf_dir):
    return DQ.report(_landed_tables(spark, sf_dir))
