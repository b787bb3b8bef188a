"""The producer jobs: raw landing payloads -> keyed topic records.

normalise -> watch-list (SRC-9) -> first arrival of each id (FLT-6) -> text
scores (ENR-14) -> labels -> keyed JSON (SNK-6). Everything but the
first-arrival step is row-local, so with ``dedup=False`` the same function
runs on a stream; there the ingest job keeps the first arrival of an id.

What is not published is kept or counted (FLT-7): :func:`rejects` has every
entry that cannot be read, and :func:`reconciliation` says for
each kind where all landed entries went.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.functions import enrich as R
from sentimart.operators import dedup as DD
from sentimart.operators import scoring as SCO
from sentimart.session import run_folder
from sentimart.sources import landing as L

NORMALIZE = {"tick": L.normalize_ticker, "message": L.normalize_social, "article": L.normalize_news}
POSITION = {"message": "msg_pos", "article": "art_pos"}
ID = {"message": "message_id", "article": "article_id"}
LISTED = {"message": ("symbol", R.SOCIAL_SYMBOLS), "article": ("query", R.NEWS_QUERIES)}
#: Why a normalised row is not published; false and NULL let it pass.
BAD = {"tick": {"bad number": "quarantined"}, "message": {"bad number": "quarantined"}, "article": {"status": "not status <=> 'ok'"}}
#: What tells where a normalised row goes.
JUDGED = {"tick": ("offset", "quarantined"), "message": ("offset", "msg_pos", "message_id", "symbol", "quarantined"),
          "article": ("offset", "art_pos", "article_id", "query", "status")}


def ticks(landing: DataFrame) -> DataFrame:
    return L.keyed_records(readable(L.normalize_ticker(landing), "tick"), "tick")


def social(landing: DataFrame, lexicon: DataFrame | None = None, dedup: bool = True,
           watchlist: list[str] = R.SOCIAL_SYMBOLS) -> DataFrame:
    m = readable(L.watchlist_filter(L.normalize_social(landing), "symbol", watchlist), "message")
    if dedup:
        m = first_arrivals(m, "message")
    m = SCO.attach_scores(m, ["offset", "msg_pos"], "body", lexicon)
    return L.keyed_records(m.withColumn("sentiment_label", R.polarity_class())
                            .withColumn("sentiment_agreement", R.label_agreement()), "message")


def news(landing: DataFrame, lexicon: DataFrame | None = None, dedup: bool = True,
         watchlist: list[str] = R.NEWS_QUERIES) -> DataFrame:
    a = readable(L.watchlist_filter(L.normalize_news(landing), "query", watchlist), "article")
    if dedup:
        a = first_arrivals(a, "article")
    a = SCO.attach_scores(a, ["offset", "art_pos"], "score_text", lexicon)
    return L.keyed_records(a.withColumn("sentiment_label", R.polarity_class()), "article")


def _reason(kind: str):
    return F.coalesce(*[F.when(F.expr(cond), F.lit(name)) for name, cond in BAD[kind].items()])


def readable(rows: DataFrame, kind: str) -> DataFrame:
    return rows.filter(_reason(kind).isNull())


def _arrivals(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumn("arrival", F.struct("offset", POSITION[kind]))


def first_arrivals(rows: DataFrame, kind: str) -> DataFrame:
    """Of each id the entry of the least offset, then the least position in its page."""
    return DD.first_wins(_arrivals(rows, kind), [ID[kind]], "arrival").drop("arrival")


def rejects(landing: DataFrame, kind: str) -> DataFrame:
    """``(kind, offset, pos, reason, value)``: entries that cannot be published: their
    own JSON, or the whole payload where that cannot be read.

    Entries off the watch-list are nobody's and are not listed."""
    rows = NORMALIZE[kind](landing, raw=True)
    if kind in LISTED:
        rows = L.watchlist_filter(rows, *LISTED[kind])
    pos = F.col(POSITION[kind]) if kind in POSITION else F.lit(0)
    bad = rows.withColumn("reason", _reason(kind)).filter("reason is not null")
    torn = L.unreadable(landing, kind).withColumn("reason", F.lit("unreadable"))
    columns = [F.lit(kind).alias("kind"), "offset", "pos", "reason", F.col("value").cast("string").alias("value")]
    return bad.withColumn("pos", pos).select(*columns).unionByName(torn.select(*columns))


def reconciliation(landing: DataFrame, kind: str) -> DataFrame:
    """One row: where the landed entries of a kind went.

    ``landed`` = ``published`` + ``repeated`` + ``off_list`` + ``no_symbol`` +
    ``quarantined``, each counted by itself; ``unexplained`` is what breaks that.
    Entries are counted in the payloads, independently of the normalisers. The
    payloads are normalised once for all counts of rows, into a table of JUDGED."""
    schema, field = L.ENVELOPE[kind]
    n = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    entries = F.from_json(F.col("value").cast("string"), schema)[field]
    size = F.lit(1) if kind == "tick" else F.coalesce(F.when(entries.isNotNull(), F.size(entries)), F.lit(1))
    spark, path = landing.sparkSession, f"{run_folder(landing.sparkSession, 'judged')}/{kind}"
    rows = NORMALIZE[kind](landing).select(*JUDGED[kind])
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    listed = L.watchlist_filter(rows, *LISTED[kind]) if kind in LISTED else rows
    good = readable(listed, kind)
    parts = [landing.agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("n")).select(F.lit("landed").alias("what"), "n"),
             n(rows, "rows"), n(listed, "listed"), n(good, "good"),
             rejects(landing, kind).groupBy((F.col("reason") == "unreadable").alias("torn")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.explode(F.expr("if(torn, array('quarantined', 'torn'), array('quarantined'))")).alias("what"), "n")]
    if kind in ID:
        parts += [n(first_arrivals(good, kind), "published"), n(DD.losers(_arrivals(good, kind), [ID[kind]], "arrival"), "repeated")]
    counts = reduce(DataFrame.unionByName, parts)
    names = ["landed", "rows", "listed", "good", "quarantined", "torn", "published", "repeated"]
    one = counts.agg(*[F.sum(F.when(F.col("what") == c, F.col("n"))).alias(c) for c in names])
    one = one.fillna(0, ["quarantined", "torn"])
    one = one.withColumns({"published": F.coalesce("published", "good"), "repeated": F.coalesce("repeated", F.lit(0)),
                           "off_list": F.col("rows") - F.col("listed"), "no_symbol": F.col("landed") - F.col("rows") - F.col("torn")})
    return one.select(F.lit(kind).alias("kind"), "landed", "published", "repeated", "off_list", "no_symbol", "quarantined",
                      F.abs(F.col("landed") - F.col("published") - F.col("repeated") - F.col("off_list") - F.col("no_symbol")
                            - F.col("quarantined")).alias("unexplained"))
