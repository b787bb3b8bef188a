"""Streaming at the shipped settings: nothing is lost, nothing is kept twice,
and a replayed stream equals its batch twin."""

import json
import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from sentimart.operators import silver as SV
from sentimart.plans import producers as PR
from sentimart.plans.publish import read_published
from sentimart.queries_stream import land, run_kind, source_records
from sentimart.session import run_folder
from sentimart.sources import fixtures as FX
from sentimart.sources import landing as L
from sentimart.sources.catalog import read_table
from sentimart.streaming import jobs as J
from sentimart.streaming.app import compact_dates, run, start_ingest
from sentimart.streaming.compaction import compact, retire
from sentimart.streaming.refresh import refresh
from sentimart.streaming.sinks import BatchMetrics, LayerSpec, conform, read_layer, write_layer, write_layers

PRICES = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType())])


def test_retry_of_a_batch_does_not_duplicate(spark):
    root = run_folder(spark, "retry")
    batch = spark.createDataFrame([("BTCUSDT", 1.0), ("ETHUSDT", 2.0), ("SOLUSDT", 3.0)], PRICES)
    layers = [LayerSpec(f"{root}/bronze"), LayerSpec(f"{root}/silver", transform=lambda b: b.filter(F.col("price") > 1))]
    m = BatchMetrics()
    write_layers(batch, 0, layers, m)
    write_layers(batch.filter(F.col("symbol") != "ETHUSDT"), 0, layers, m)  # the retry of epoch 0
    write_layers(batch.limit(0), 1, layers, m)          # empty batch: short-circuit, nothing written
    assert read_layer(spark, f"{root}/bronze", PRICES).count() == 2
    assert [r["symbol"] for r in read_layer(spark, f"{root}/silver", PRICES).collect()] == ["SOLUSDT"]
    assert m.rows[(0, "bronze")] == 2 and (1, "bronze") not in m.rows
    assert not os.path.exists(f"{root}/bronze/batch_id=1")


def _land(where, name, records):
    os.makedirs(where, exist_ok=True)
    with open(os.path.join(where, name), "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _msg(i, t, sym="BTC.X", **more):
    return {"message_id": str(i), "symbol": sym, "created_at": t, "ingested_at": t,
            "sentiment_compound": 0.5, "user_sentiment": "bullish", "user_followers": 50} | more


def _run(spark, kind, where, paths, **options):
    raw = J.read_topic(spark, kind, folder=where, max_files_per_trigger=1)
    J.await_all(spark, [J.start_stream(spark, kind, raw, paths, available_now=True, **options)])


def _ids(spark, paths, layer="silver"):
    return sorted((r["message_id"], r["symbol"]) for r in J.layer_table(spark, paths, "message", layer).collect())


@pytest.mark.parametrize("seen", ["state", "silver"])
def test_first_arrival_wins_across_batches_and_restarts(spark, seen):
    root = run_folder(spark, "dedup")
    where, paths = root + "/landing", J.StreamPaths(root)
    day = "2024-01-01T0{}:00:00Z"
    _land(where, "a.json", [_msg(1, day.format(0)), _msg(2, day.format(1), ingested_at=day.format(5), body="copy"), _msg(2, day.format(1), body="first"),
                            _msg(9, day.format(1), ingested_at=None)])  # no arrival time: kept
    _land(where, "b.json", [_msg(1, day.format(0), "ETH.X"), _msg(3, day.format(2))])
    _run(spark, "message", where, paths, seen=seen)
    _land(where, "c.json", [_msg(2, day.format(1), "SOL.X"), _msg(4, day.format(3)), _msg(5, "2023-12-01T00:00:00Z")])  # a month late: kept
    _run(spark, "message", where, paths, seen=seen)
    assert _ids(spark, paths) == [(i, "BTC.X") for i in "123459"]
    body = {r["message_id"]: r["body"] for r in J.layer_table(spark, paths, "message", "silver").collect()}
    assert body["2"] == "first"
    assert J.layer_table(spark, paths, "message", "bronze").count() == 9
    assert J.layer_table(spark, paths, "message", "quarantine").count() == 0 and not os.path.exists(paths.layer("message", "quarantine"))


def test_a_copy_under_another_date_is_a_copy(spark):
    """The seen-key index knows no dates; its batches read nothing of silver and
    look up their own ids only, however many are there."""
    root = run_folder(spark, "redated")
    where, paths = root + "/landing", J.StreamPaths(root)
    for day in range(1, 7):  # each batch: 30 new ids, and 10 old ones under a new date
        ids = [*range(day * 30, day * 30 + 30), *range(30, 40)]
        _land(where, f"{day}.json", [_msg(i, f"2024-01-{day:02d}T00:00:00Z") for i in ids])
        os.utime(f"{where}/{day}.json", (1.7e9 + day, 1.7e9 + day))  # batches in this order
    with pytest.MonkeyPatch.context() as m:
        m.setattr(J, "layer_table", lambda *a: (_ for _ in ()).throw(AssertionError("a layer was read")))
        raw = J.read_topic(spark, "message", folder=where, max_files_per_trigger=1)
        q = J.start_stream(spark, "message", raw, paths, available_now=True)
        J.await_all(spark, [q])
    rows = J.layer_table(spark, paths, "message", "silver").collect()
    assert sorted(int(r["message_id"]) for r in rows) == list(range(30, 210))
    assert {str(r["event_date"]) for r in rows if int(r["message_id"]) < 40} == {"2024-01-01"}
    state = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"]]
    assert [s["numRowsUpdated"] for s in state] == [30] * 6 and state[-1]["numRowsTotal"] == 180


def test_seen_keys_inside_a_batch_and_after_their_time():
    from pyspark.sql import Row

    from sentimart.streaming.seen import SeenKeys

    class Handle:
        def getMapState(self, name, key, value, ttl):
            self.held, self.ttl = {}, ttl
            return self

        def containsKey(self, key):
            return key in self.held

        def updateValue(self, key, value):
            self.held[key] = value
    p, h = SeenKeys(ttl_hours=2), Handle()
    p.init(h)
    assert h.ttl == 7_200_000
    row = lambda i, at, v: Row(id=i, arrival=at, value=v)
    call = lambda *rows: sorted((r.value, r.first) for r in p.handleInputRows((0,), iter(rows), None))
    assert call(row("a", None, "untimed"), row("a", 5, "later"), row("a", 3, "z"), row("a", 3, "y"), row(None, 1, "bad"), row(None, 1, "bad")) == [
        ("bad", False), ("bad", False), ("later", False), ("untimed", False), ("y", True), ("z", False)]
    assert call(row("a", 1, "copy"), row("b", None, "only")) == [("copy", False), ("only", True)]
    h.held.clear()  # what the store does when the time is up
    assert call(row("a", 1, "again")) == [("again", True)]


def test_part_bad_records_stand_as_in_batch(spark):
    root = run_folder(spark, "dirty")
    where, paths = root + "/landing", J.StreamPaths(root)
    t = "2024-01-01T00:00:00Z"
    lines = [_msg(1, t), _msg(2, t, user_following="n/a"), _msg(3, t, ingested_at=None), {"symbol": "BTC.X"}, "{broken", _msg(4, t, sym=None)]
    _land(where, "a.json", lines)
    _run(spark, "message", where, paths)
    batch = SV.message_silver(L.parse_records(spark.read.text(where), "message"))
    assert _ids(spark, paths) == sorted((r.message_id, r.symbol) for r in batch.collect()) == [(i, "BTC.X") for i in "123"]
    bronze = {r["message_id"]: r["malformed"] for r in J.layer_table(spark, paths, "message", "bronze").collect()}
    assert bronze == {"1": False, "2": True, "3": False}
    bad = J.layer_table(spark, paths, "message", "quarantine").collect()
    assert sorted(r["_corrupt_record"][:8] for r in bad) == ['{"messag', '{"symbol', "{broken"]
    one = J.reconciliation(spark, paths, "message", spark.read.text(where)).first()
    assert (one.landed, one.bronze, one.silver, one.quarantined, one.repeated, one.invalid, one.unexplained) == (6, 3, 3, 3, 0, 0, 0)


def test_dedup_key_per_symbol(spark):
    root = run_folder(spark, "dedupsym")
    where, paths = root + "/landing", J.StreamPaths(root)
    recs = [_msg(1, "2024-01-01T00:00:00Z", s) for s in ("BTC.X", "ETH.X")]
    _land(where, "a.json", recs[:1])
    _land(where, "b.json", recs[1:] + recs[:1])
    _run(spark, "message", where, paths, dedup_keys=["message_id", "symbol"])
    assert _ids(spark, paths) == [("1", "BTC.X"), ("1", "ETH.X")]


def test_broker_without_connector_is_an_error(spark):
    assert not J.kafka_available(spark)
    with pytest.raises(RuntimeError, match="connector"):
        J.read_topic(spark, "t", bootstrap="host:9092")
    with pytest.raises(ValueError):
        J.read_topic(spark, "t")
    options = J.kafka_options("t", "host:9092", 7)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "7"


def test_layers_read_by_declared_schema(spark):
    root = run_folder(spark, "evolve")
    full = T.StructType.fromDDL("symbol string, price double, volume double")
    write_layers(spark.createDataFrame([("005930", 1.0)], PRICES), 0, [LayerSpec(f"{root}/t")])
    write_layers(spark.createDataFrame([("005931", 2.0, 5.0)], full), 1, [LayerSpec(f"{root}/t")])
    got = sorted((r["symbol"], r["volume"]) for r in read_layer(spark, f"{root}/t", full).collect())
    assert got == [("005930", None), ("005931", 5.0)]
    assert conform(read_layer(spark, f"{root}/t", PRICES), full).columns == ["symbol", "price", "volume"]
    assert read_layer(spark, f"{root}/none", full).count() == 0   # never committed: empty
    os.makedirs(f"{root}/broken/batch_id=0")
    with open(f"{root}/broken/batch_id=0/part.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        read_layer(spark, f"{root}/broken", full).collect()       # anything else is raised


def test_app_equals_batch_and_one_refresher_keeps_gold(spark):
    """Three concurrent streams at the defaults, over hard replays; then late
    rows in a second run. Gold equals the batch build, late rows included."""
    root = run_folder(spark, "app")
    for kind in ("tick", "message", "article"):
        land(spark, SMALL, kind, root)
    run(spark, root, f"{root}/landing", available_now=True)
    gold = lambda: read_published(spark, f"{root}/models", "gold_crypto_dashboard").drop("updated_at")
    want = E.queries()["crypto_dashboard"](spark, SMALL)
    key = ["symbol", "date", "hour", "composite_signal", "sentiment_message_count", "news_article_count", "price_tick_count"]
    assert gold().select(key).exceptAll(want.select(key)).count() == 0 and want.select(key).exceptAll(gold().select(key)).count() == 0
    hours = gold().groupBy("date").count().collect()
    _land(f"{root}/landing/topic=crypto.prices/chunk=late", "z.json",
          [{"symbol": "BTCUSDT", "price": 5.0, "open": 5.0, "ingested_at": "2024-01-02T23:59:00Z"}])
    run(spark, root, f"{root}/landing", available_now=True)
    after = {r["date"]: r["n"] for r in gold().groupBy("date").agg(F.sum("price_tick_count").alias("n")).collect()}
    before = {r["date"]: r["n"] for r in want.groupBy("date").agg(F.sum("price_tick_count").alias("n")).collect()}
    assert {str(d): after[d] - before[d] for d in after if after[d] != before.get(d)} == {"2024-01-02": 1}
    assert len(hours) == len(after)


def _layer_of_batches(path, dates, batches):
    """Batches of a (symbol, price) layer, a file each, laid down as the sink does."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    rows = pa.table({"symbol": ["A"], "price": [1.0]})
    for d in dates:
        for n in batches:
            os.makedirs(f"{path}/event_date={d}/batch_id={n}")
            pq.write_table(rows, f"{path}/event_date={d}/batch_id={n}/part-0.parquet")


def test_reading_a_date_lists_that_date_only(spark):
    """The files in the relation's index (not only those read) are those of the
    date asked for, after few and after many batches and compacted dates of others."""
    root = run_folder(spark, "history")
    path, schema = f"{root}/silver", T.StructType.fromDDL("symbol string, price double, event_date date")
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 6) for d in range(1, 22)]
    import datetime as dt
    asked = dt.date.fromisoformat(days[0])
    _layer_of_batches(path, days[:1], range(5))
    index = lambda: sorted(read_layer(spark, path, schema, [asked]).inputFiles())
    before = index()
    _layer_of_batches(path, days[1:], range(5))  # 500 and more batches of other dates
    assert index() == before and len(before) == 5
    for d in days[3:]:  # and a hundred compacted dates
        os.makedirs(f"{path}_compact/event_date={d}/upto=3")
        os.system(f"cp {path}/event_date={d}/batch_id=3/part-0.parquet {path}_compact/event_date={d}/upto=3/ && touch {path}_compact/event_date={d}/upto=3/_SUCCESS")
    df = read_layer(spark, path, schema, [asked])
    assert sorted(df.inputFiles()) == before and "Union" not in df._jdf.queryExecution().analyzed().toString()
    one = read_layer(spark, path, schema, [asked, dt.date.fromisoformat(days[50]), None, dt.date(2030, 1, 1)])
    assert len(one.inputFiles()) == 11 and one.count() == 7  # five; batch 4 and the compact file of the other
    assert read_layer(spark, path, schema).count() == 15 + 102 * 2
    assert read_layer(spark, path, schema, []).count() == 0


def test_a_refresh_of_one_date_rebuilds_that_date(spark):
    root = run_folder(spark, "onedate")
    paths = J.StreamPaths(root)
    rows = source_records(spark, SMALL, "tick")
    silver = J._dated(SV.tick_silver(rows.drop("_row").withColumn("processed_at", F.current_timestamp())), "tick")
    partials = J.PARTIALS["tick"](silver).cache()
    write_layer(partials, 0, LayerSpec(paths.layer("tick", "partials"), add_columns={"event_date": F.col("trade_date")}))
    date = partials.agg(F.min("trade_date")).first()[0]
    refresh(spark, paths, f"{root}/models", [date])
    got = read_published(spark, f"{root}/models", "mart_price_sentiment_correlation")
    assert [r[0] for r in got.select("date").distinct().collect()] == [date]


def test_compaction_retires_batches_and_survives_a_crash(spark):
    root = run_folder(spark, "compact")
    path, schema = f"{root}/silver", T.StructType.fromDDL("symbol string, price double, event_date date")
    rows = spark.createDataFrame([("A", float(i), f"2024-01-0{1 + i % 2}") for i in range(40)], "symbol string, price double, d string")
    rows = rows.select("symbol", "price", F.col("d").cast("date").alias("event_date")).cache()
    for epoch in range(4):
        write_layer(rows.filter(F.col("price") % 4 == epoch), epoch, LayerSpec(path))
    total = lambda: sorted(r["price"] for r in read_layer(spark, path, schema).collect())
    want = [float(i) for i in range(40)]
    import datetime as dt
    day = dt.date(2024, 1, 1)
    with pytest.MonkeyPatch.context() as m:  # a crash between writing and retiring
        m.setattr("sentimart.streaming.compaction.retire", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            compact(spark, path, schema, [day])
    assert total() == want
    retire(spark, path, "2024-01-01")
    assert total() == want and not os.path.exists(f"{path}/event_date=2024-01-01/batch_id=0")
    write_layer(rows.filter("price = 0"), 9, LayerSpec(path))  # a late row of the closed date
    compact(spark, path, schema, [day, day])
    compact(spark, path, schema, [day])
    assert total() == sorted(want + [0.0])
    assert os.listdir(f"{path}_compact/event_date=2024-01-01") == ["upto=9"]


def test_compacted_layers_feed_the_build(spark):
    from sentimart.plans.build import silver_tables
    root = run_folder(spark, "compactapp")
    where = land(spark, SMALL, "message", root)
    paths = J.StreamPaths(root)
    run_kind(spark, "message", where, paths)
    before = silver_tables(spark, root)["message"].count()
    compact_dates(spark, root, ["2024-01-03", "2024-01-04"])
    assert silver_tables(spark, root)["message"].count() == before
    assert not os.path.exists(f"{paths.layer('message', 'silver')}/event_date=2024-01-03/batch_id=0")
    run_kind(spark, "message", where, paths)  # a restart finds nothing new
    assert silver_tables(spark, root)["message"].count() == before


def test_producers_run_on_a_stream(spark):
    """The row-local producer gives the same records on a stream as in batch."""
    root = run_folder(spark, "producer")
    raw = FX.social_landing(read_table(spark, SMALL, "events"))
    raw.write.parquet(f"{root}/raw")
    stream = spark.readStream.schema(raw.schema).parquet(f"{root}/raw")
    q = (PR.social(stream, dedup=False).writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start())
    J.await_all(spark, [q])
    got, want = spark.read.parquet(f"{root}/out"), PR.social(raw, dedup=False)
    assert got.count() > 900 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_failing_stream_stops_the_others(spark):
    root = run_folder(spark, "fail")
    _land(f"{root}/landing/topic=crypto.prices", "a.json", [{"symbol": "A", "price": 1.0, "ingested_at": "2024-01-01T00:00:00Z"}])
    for t in ("market.sentiment", "market.news"):
        os.makedirs(f"{root}/landing/topic={t}")
    os.makedirs(f"{root}/bronze")
    with open(f"{root}/bronze/tick", "w") as f:  # a file where the layer's folder should be
        f.write("x")
    with pytest.raises(RuntimeError):
        J.run_until_failure(spark, start_ingest(spark, root, f"{root}/landing", available_now=True))
