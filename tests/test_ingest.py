"""JSON and payload edge cases (FIXTURES §C)."""

import json

import pytest
from pyspark.sql import functions as F

from sentimart.operators import dedup as DD
from sentimart.plans import producers as PR
from sentimart.sources import landing as L


def _raw(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value string")


def test_quarantine_edge_cases(spark):
    good = json.dumps({"symbol": "BTCUSDT", "price": 1.5, "ingested_at": "2024-01-01T00:00:00+00:00",
                       "extra": 1})
    values = ["not json", "{}", json.dumps({"symbol": "X", "price": "n/a"}), good, None,
              json.dumps({"symbol": "X", "price": 2.0, "ingested_at": ""})]
    out = {r["offset"]: r for r in L.split_quarantine(_raw(spark, values), "tick", keep=["offset"]).collect()}
    assert [out[i]["quarantined"] for i in range(6)] == [True, True, False, False, True, False]
    assert [out[i]["malformed"] for i in range(6)] == [False, False, True, False, False, False]
    assert out[0]["_corrupt_record"] == "not json" and out[1]["_corrupt_record"] == "{}"
    assert out[2]["symbol"] == "X" and out[2]["price"] is None and "n/a" in out[2]["_corrupt_record"]
    assert out[3]["price"] == 1.5 and out[3]["ingested_at"] is not None and out[3]["_corrupt_record"] is None
    assert out[5]["ingested_at"] is None          # empty time -> NULL, no error


def test_ticker_defaults_and_bad_numbers(spark):
    vals = [json.dumps({"data": {"s": "btcusdt", "c": "1.5", "P": "0.7", "p": "0.01"}}),
            json.dumps({"data": {"s": "", "c": "1"}}),
            json.dumps({"data": {"c": "1"}}),
            json.dumps({"data": {"s": "ethusdt", "c": "abc"}})]
    raw = _raw(spark, vals).withColumn("ingested_at", F.current_timestamp())
    out = {r["offset"]: r for r in L.normalize_ticker(raw).collect()}
    assert set(out) == {0, 3}                      # empty / missing symbol dropped (FLT-5)
    assert out[0]["symbol"] == "BTCUSDT" and out[0]["open"] == 0.0          # missing -> 0
    assert out[0]["change_pct"] == 0.7 and out[0]["price_change"] == 0.01    # case-sensitive keys
    assert out[0]["quarantined"] is False
    assert out[3]["price"] is None and out[3]["quarantined"] is True


def test_social_payload_defaults(spark):
    page = {"symbol": {"symbol": "BTC.X"}, "messages": [
        {"id": 1, "body": "good", "created_at": "2024-01-01T00:00:00Z",
         "user": {"id": 7, "username": "a", "followers": None, "following": 3},
         "entities": {"sentiment": {"basic": "Bullish"}, "symbols": [{"symbol": "BTC.X"}, {}]}},
        {"id": 2, "created_at": "", "user": {"followers": "many"},
         "entities": {"sentiment": {"basic": None}}},
        {"id": 3, "user": {}, "entities": {"sentiment": None}},
    ]}
    raw = _raw(spark, [json.dumps(page)]).withColumn("ingested_at", F.current_timestamp())
    out = {r["message_id"]: r for r in L.normalize_social(raw).collect()}
    assert out["1"]["user_sentiment"] == "bullish" and out["1"]["user_followers"] == 0
    assert out["1"]["symbols_mentioned"] == ["BTC.X", ""] and out["1"]["user_following"] == 3
    assert out["2"]["user_sentiment"] == "neutral" and out["2"]["created_at"] is None
    assert out["2"]["quarantined"] is True and out["2"]["body"] == ""
    assert out["3"]["user_sentiment"] == "neutral" and out["3"]["symbols_mentioned"] == []


def test_news_payload_defaults(spark):
    page = {"status": "ok", "query": "q", "articles": [
        {"url": "http://a/1", "source": {"name": None}, "title": None, "description": "d"},
        {"url": "http://a/2", "source": {"name": "S"}, "title": "t", "description": None,
         "publishedAt": "2024-01-01T10:00:00Z"}]}
    raw = _raw(spark, [json.dumps(page)]).withColumn("ingested_at", F.current_timestamp())
    out = {r["url"]: r for r in L.normalize_news(raw).collect()}
    assert out["http://a/1"]["source"] == "unknown" and out["http://a/1"]["score_text"] == "d"
    assert out["http://a/2"]["score_text"] == "t"          # NULL description is skipped, not "None"
    import hashlib
    assert out["http://a/2"]["article_id"] == hashlib.md5(b"http://a/2").hexdigest()


def test_wire_round_trip_is_lossless(spark):
    from conftest import SMALL
    from sentimart.sources import fixtures as FX
    from sentimart.sources.catalog import read_table
    t = FX.ticks_from_events(read_table(spark, SMALL, "events"))
    back = L.parse_records(L.to_wire(t, "tick"), "tick").drop("processed_at")
    assert t.exceptAll(back).count() == 0 and back.exceptAll(t).count() == 0


def test_keyed_publish(spark):
    df = spark.createDataFrame([("x" * 60, "id1")], "query string, article_id string")
    out = L.keyed_records(df.select("query", "article_id", *[F.lit(None).cast("string").alias(c)
                                                              for c in ("source", "author", "title", "description",
                                                                        "url", "sentiment_label", "data_source")],
                                    *[F.lit(None).cast("timestamp").alias(c) for c in ("published_at", "ingested_at")],
                                    *[F.lit(None).cast("double").alias(c) for c in
                                      ("sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_compound")]),
                          "article").collect()[0]
    assert out["topic"] == "market.news" and out["key"] == "x" * 50
    assert json.loads(out["value"])["article_id"] == "id1"


def test_first_wins_and_idempotence(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "off long, k string")
    once = DD.first_wins(df, ["k"], "off")
    assert sorted(r["off"] for r in once.collect()) == [1, 3, 4]
    twice = DD.first_wins(once, ["k"], "off")
    assert sorted(r["off"] for r in twice.collect()) == [1, 3, 4]


def test_latest_n_window(spark):
    import datetime as dt
    rows = [(f"id{i}", "q1" if i % 2 else "q2", dt.datetime(2024, 1, 2, i)) for i in range(10)]
    rows.append(("old", "q1", dt.datetime(2023, 12, 30)))
    df = spark.createDataFrame(rows, "article_id string, query string, published_at timestamp")
    out = DD.latest_per_query(df, "2024-01-03 05:00:00", 24, 2).collect()
    got = sorted((r["query"], r["article_id"]) for r in out)
    assert got == [("q1", "id7"), ("q1", "id9"), ("q2", "id6"), ("q2", "id8")]


def test_publish_to_folder_round_trip(spark):
    from conftest import SMALL
    from sentimart.session import run_folder
    from sentimart.sources import fixtures as FX
    from sentimart.sources.catalog import read_table
    root = run_folder(spark, "publish")
    t = FX.ticks_from_events(read_table(spark, SMALL, "events"))
    L.publish(L.keyed_records(t, "tick"), folder=root)
    raw = spark.read.text(f"{root}/topic=crypto.prices")
    back = L.parse_records(raw, "tick").drop("processed_at")
    assert back.exceptAll(t).count() == 0 and t.exceptAll(back).count() == 0


def test_latest_n_language_filter(spark):
    import datetime as dt
    rows = [("a", "q", dt.datetime(2024, 1, 2, 1), "en"), ("b", "q", dt.datetime(2024, 1, 2, 2), "fr"),
            ("c", "q", dt.datetime(2024, 1, 2, 3), "en")]
    df = spark.createDataFrame(rows, "article_id string, query string, published_at timestamp, language string")
    out = DD.latest_per_query(df, "2024-01-02 12:00:00", 24, 1, language="en").collect()
    assert [r["article_id"] for r in out] == ["c"]


@pytest.mark.parametrize("size", [999, 1000, 1001, 5000])
def test_long_pages_lose_no_message(spark, size):
    """A page of any length, followed by one that repeats one of its messages."""
    page = lambda ids: json.dumps({"symbol": {"symbol": "BTC.X"}, "messages": [{"id": i, "body": "b"} for i in ids]})
    raw = spark.createDataFrame([("k", page(range(size)), 0, None), ("k", page([size - 1, size, 0]), 1, None)],
                                "key string, value string, offset long, ingested_at timestamp")
    ids = [json.loads(r.value)["message_id"] for r in PR.social(raw).collect()]
    assert sorted(map(int, ids)) == list(range(size + 1))
    assert PR.reconciliation(raw, "message").first()[1:4] == (size + 3, size + 1, 2)


def test_every_entry_is_published_or_kept(spark):
    """Torn payloads, null entries, empty pages, bad numbers and off-list symbols."""
    texts = ["{torn", "null", '{"symbol":{"symbol":"BTC.X"}}', '{"symbol":{"symbol":"BTC.X"},"messages":[]}',
             '{"symbol":{"symbol":"BTC.X"},"messages":[null,{"id":1,"user":{"followers":"x"}},{"id":2},{"id":2}]}',
             '{"symbol":{"symbol":"ZZZ"},"messages":[{"id":3,"user":{"followers":"x"}}]}', None]
    raw = spark.createDataFrame([("k", t, i, None) for i, t in enumerate(texts)], "key string, value string, offset long, ingested_at timestamp")
    assert PR.reconciliation(raw, "message").first().asDict() == {
        "kind": "message", "landed": 9, "published": 1, "repeated": 1, "off_list": 1, "no_symbol": 0, "quarantined": 6, "unexplained": 0}
    assert sorted((r.offset, r.pos, r.reason, r.value) for r in PR.rejects(raw, "message").collect() if r.value) == sorted(
        [(0, 0, "unreadable", texts[0]), (1, 0, "unreadable", "null"), (2, 0, "unreadable", texts[2]), (4, 0, "unreadable", "null"),
         (4, 1, "bad number", '{"id":"1","user":{"followers":"x"}}')])
    ticks = spark.createDataFrame([("k", t, i, None) for i, t in enumerate(['{"data":{"s":"btcusdt","c":"x"}}', '{"data":{"c":"1"}}', "{", '{"data":{"s":"a"}}'])],
                                  "key string, value string, offset long, ingested_at timestamp")
    assert PR.reconciliation(ticks, "tick").first()[1:] == (4, 1, 0, 0, 1, 2, 0)
