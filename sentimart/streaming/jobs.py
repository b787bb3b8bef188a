"""Streaming jobs (SRC-1, SRC-2, STR-1..9, SNK-1..5).

One streaming query per topic. Inside the stream records are parsed and the ids
that are new found (:mod:`sentimart.streaming.seen`); no watermark, so nothing
is ever late. The batch function writes

* ``bronze``: every record, repeated ids included;
* ``quarantine``: values that are no record of the kind, with their text;
* ``silver``: valid records, of each id the first arrival (STR-7);
* ``partials``: what the batch adds to the hourly roll-ups (mergeable sums
  and counts of its new silver rows);
* ``touched``: the dates it added to, for the refresher.

First arrival. Inside a batch the row with the least arrival time wins (a row
without one loses to any other); against earlier batches, the seen-key index
decides. It looks up the batch's ids only and knows no dates: a copy that comes
a month late, or under another date, is still a copy, and a late first arrival
is still kept (STR-9). ``seen="silver"`` does without the index and reads the
ids of the batch's dates from silver (a copy under another date then stays).

Every parsed row ends in exactly one place: rows in = bronze + quarantine, and
bronze = silver + repeated + invalid (:func:`reconciliation`).
"""

from __future__ import annotations

import contextlib
import functools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import StreamingQueryException

from sentimart.operators import rollups as G
from sentimart.operators import silver as SV
from sentimart.operators import staging as ST
from sentimart.sources import landing as L
from sentimart.sources import topic_log
from sentimart.streaming.metrics import MetricsTable, observed
from sentimart.streaming.seen import first_of_new, mark_first, with_new_ids
from sentimart.streaming.sinks import BATCH, DATE, BatchMetrics, LayerSpec, read_layer, write_layer

TRIGGER_SECONDS = {"tick": 10, "message": 15, "article": 15}
ID_COLUMN = {"message": "message_id", "article": "article_id"}
DATE_SOURCE = {"tick": "ingested_at", "message": "created_at", "article": "published_at"}
SILVER = {"tick": SV.tick_silver, "message": SV.message_silver, "article": SV.article_silver}
PARTIALS = {"tick": lambda silver: G.tick_partials(ST.stg_crypto_prices(silver)),
            "message": lambda silver: G.message_partials(ST.stg_sentiment(silver)),
            "article": lambda silver: G.news_partials(ST.stg_news(silver))}
PARTIAL_DATE = {"tick": "trade_date", "message": "sentiment_date", "article": "publish_date"}
#: What a batch knows of its rows' ids; no layer keeps it.
SEEN = ("value", "id", "arrival", "new", "first")
#: Input of one trigger, so that a replay from the start comes in batches of bounded size.
MAX_OFFSETS_PER_TRIGGER, MAX_FILES_PER_TRIGGER = 5_000_000, 24
#: Partitions of a stream's state and shuffles, for each core. A trigger bounds what a batch brings, so they need not
#: grow with the topic: each is a state store, and a file for each date that a batch touches.
PARTITIONS_PER_CORE = 2


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def read_topic(spark: SparkSession, topic: str, folder: str | None = None,
               bootstrap: str | None = None, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
               max_offsets_per_trigger: int | None = None, log: str | None = None, progress: str | None = None) -> DataFrame:
    """Raw records ``value`` (string) of a topic, from the earliest on (STR-5).

    ``bootstrap``: a broker, ``failOnDataLoss=false``; asking for it without
    the connector is an error. ``log``: the topic log under that folder, with
    its offsets; ``progress`` names the file its admission needs. ``folder``: a
    landing folder of text files, oldest first."""
    if sum(x is not None for x in (bootstrap, folder, log)) != 1:
        raise ValueError("name either a broker, a log or a folder")
    if bootstrap:
        if not kafka_available(spark):
            raise RuntimeError("a broker was named, but the Kafka connector is not on the classpath")
        return (spark.readStream.format("kafka")
                .options(**kafka_options(topic, bootstrap, max_offsets_per_trigger or MAX_OFFSETS_PER_TRIGGER)).load()
                .select(F.col("value").cast("string").alias("value")))
    if log:
        limit = max_offsets_per_trigger or (MAX_OFFSETS_PER_TRIGGER if progress else None)
        return topic_log.read_stream(spark, f"{log.rstrip('/')}/{topic}", limit, progress).select("value")
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(folder)


def kafka_options(topic: str, bootstrap: str, max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "60000",
        "maxOffsetsPerTrigger": str(max_offsets),
    }


@dataclass
class StreamPaths:
    root: str

    def layer(self, kind: str, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{kind}"

    def checkpoint(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{kind}"

    @property
    def metrics(self) -> str:
        return f"{self.root.rstrip('/')}/metrics"

    @property
    def touched(self) -> str:
        return f"{self.root.rstrip('/')}/touched"


@functools.cache
def _layer_schema(kind: str, layer: str) -> str:
    spark = SparkSession.builder.getOrCreate()
    parsed = L.split_quarantine(spark.createDataFrame([], "value string"), kind)
    out = parsed if layer == "quarantine" else _record(parsed)
    if layer in ("silver", "partials"):
        out = SILVER[kind](out).drop("malformed")
    out = PARTIALS[kind](out).withColumn(DATE, F.col(PARTIAL_DATE[kind])) if layer == "partials" else _dated(out, kind)
    return out.schema.json()


def layer_schema(kind: str, layer: str) -> T.StructType:
    """The declared schema of a layer (SRC-4, SNK-5)."""
    import json
    return T.StructType.fromJson(json.loads(_layer_schema(kind, layer)))


def layer_table(spark: SparkSession, paths: StreamPaths, kind: str, layer: str, dates: list | None = None) -> DataFrame:
    return read_layer(spark, paths.layer(kind, layer), layer_schema(kind, layer), dates)


def _record(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("quarantined")).drop("quarantined", L.CORRUPT)


def _dated(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn(DATE, F.to_date(DATE_SOURCE[kind]))


def first_arrivals(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row that arrived first; ties go to the least row."""
    rest = [c for c in batch.columns if c != "ingested_at"]
    row = F.struct(F.col("ingested_at").isNull().alias("late"), F.col("ingested_at"), *rest)
    one = batch.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(row).alias("r"))
    return one.select(*[F.col("r")[c].alias(c) for c in batch.columns])


def marked(spark: SparkSession, raw: DataFrame, kind: str, keys: list[str], ttl_hours: float | None) -> DataFrame:
    """The parsed stream and what the seen-key index says of it: the rows' SEEN and a row for each new id, or,
    with ``ttl_hours``, the mark ``first``."""
    parsed = L.split_quarantine(raw.select("value"), kind, keep=["value"])
    ok = ~F.col("quarantined") & F.coalesce(F.expr(SV.VALID[kind]), F.lit(False))
    ident = F.to_json(F.struct(*keys)) if len(keys) > 1 else F.col(keys[0])
    seen = {"id": F.when(ok, ident), "arrival": F.unix_micros("ingested_at")}
    if ttl_hours is None:
        return with_new_ids(spark, parsed.withColumns(seen))
    return L.split_quarantine(mark_first(spark, parsed.withColumns(seen).select("value", *seen), ttl_hours), kind, keep=["first"])


def new_silver(spark: SparkSession, records: DataFrame, kind: str, paths: StreamPaths, epoch: int,
               keys: list[str]) -> DataFrame:
    """The batch's rows that silver lacks: valid, of each id the first."""
    if "first" in records.columns:
        return _dated(SILVER[kind](records.filter("first").drop("first", "malformed")), kind)
    rows = _dated(SILVER[kind](records).drop("malformed"), kind)
    if not keys:
        return rows
    dates = [r[0] for r in rows.select(DATE).distinct().collect()]  # of one batch, bounded by its trigger
    known = layer_table(spark, paths, kind, "silver", dates).filter(F.col(BATCH) != epoch)
    return first_arrivals(rows, keys).join(known.select(*keys), keys, "left_anti").select(*rows.columns)


@contextlib.contextmanager
def _sized(spark: SparkSession):
    """A query started inside has the partitions of a stream, for as long as its checkpoint lives."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def start_stream(spark: SparkSession, kind: str, raw: DataFrame, paths: StreamPaths,
                 available_now: bool = False, metrics: BatchMetrics | None = None,
                 dedup_keys: list[str] | None = None, fmt: str = "parquet", seen: str = "state",
                 ttl_hours: float | None = None):
    """Start the query of one record kind. ``dedup_keys`` defaults to the
    record id (a message seen under several symbols is kept once);
    ``["message_id", "symbol"]`` keeps one copy per symbol. ``seen`` says what
    tells a copy: the index (``state``, of ids first seen in the last
    ``ttl_hours``; by default for ever) or ``silver``. ``fmt`` is the table
    format of the layers (Parquet by default; a transactional format when its
    jars are on the classpath)."""
    keys = dedup_keys or ([ID_COLUMN[kind]] if kind in ID_COLUMN else [])
    if seen not in ("state", "silver"):
        raise ValueError("seen is state or silver")
    stateful = bool(keys) and seen == "state"
    rows = marked(spark, raw, kind, keys, ttl_hours) if stateful else L.split_quarantine(raw, kind)
    # with seen="silver" the stream itself cannot know the copies of earlier batches: it counts valid rows
    rows = observed(rows, F.col("first" if ttl_hours is not None else "new") if stateful else F.expr(SV.VALID[kind]))

    def sink(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            n, bad = batch.agg(F.count("quarantined"), F.count_if("quarantined")).first()
            if not n:
                return
            records = _record(batch)
            if "new" in batch.columns:
                first = first_of_new(batch, [c for c in records.columns if c not in (*SEEN, "malformed")])
                silver = _dated(SILVER[kind](first), kind).persist()
            else:
                silver = new_silver(spark, records, kind, paths, epoch, keys).persist()
            partials = PARTIALS[kind](silver).repartition(F.col(PARTIAL_DATE[kind]))  # a few rows an hour: one file a date
            layers = [(records.drop(*SEEN), LayerSpec(paths.layer(kind, "bronze"), lambda b: _dated(b, kind), name="bronze")),
                      (silver, LayerSpec(paths.layer(kind, "silver"), name="silver")),
                      (partials, LayerSpec(paths.layer(kind, "partials"), add_columns={DATE: F.col(PARTIAL_DATE[kind])}, name="partials"))]
            if bad:
                layers.append((batch.filter("quarantined").drop(*SEEN), LayerSpec(paths.layer(kind, "quarantine"), lambda b: _dated(b, kind), name="quarantine")))
            try:
                # the layers don't depend on each other; a batch that fails half-way is written again whole
                with ThreadPoolExecutor(len(layers)) as pool:
                    rows = list(pool.map(lambda x: write_layer(x[0], epoch, x[1], metrics, fmt), layers))
                if rows[1]:  # note the dates last, when everything about them is there
                    (silver.select(F.lit(kind).alias("kind"), DATE, F.lit(epoch).alias("epoch")).distinct().coalesce(1)
                     .write.mode("overwrite").parquet(f"{paths.touched}/{kind}-{epoch}"))
            finally:
                silver.unpersist()
        finally:
            batch.unpersist()

    w = (rows.writeStream.foreachBatch(sink)
         .outputMode("append").option("checkpointLocation", paths.checkpoint(kind)))
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{TRIGGER_SECONDS[kind]} seconds")
    with _sized(spark):
        return w.queryName(query_name(kind, paths)).start()


def query_name(kind: str, paths: StreamPaths) -> str:
    return f"{kind}_{abs(hash(paths.root)) % 10**6}"


def keep_metrics(spark: SparkSession, paths: StreamPaths) -> MetricsTable:
    """From now on the batches of this root's streams leave their figures in its metrics table."""
    listener = MetricsTable(paths.metrics, {query_name(kind, paths): kind for kind in SILVER})
    spark.streams.addListener(listener)
    return listener


def reconciliation(spark: SparkSession, paths: StreamPaths, kind: str, landed: DataFrame) -> DataFrame:
    """One row: where the ``landed`` raw records of a kind went.

    ``bronze`` = ``silver`` + ``repeated`` + ``invalid`` and ``landed`` =
    ``bronze`` + ``quarantined``; ``unexplained`` counts what breaks that."""
    ok = F.coalesce(F.expr(SV.VALID[kind]), F.lit(False))
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    bronze = layer_table(spark, paths, kind, "bronze")
    copies = bronze.filter(ok)
    ids = copies.select(ID_COLUMN[kind]).distinct() if kind in ID_COLUMN else copies
    parts = [n(landed, "landed"), n(bronze, "bronze"), n(bronze.filter(~ok), "invalid"), n(copies, "valid"), n(ids, "first"),
             n(layer_table(spark, paths, kind, "silver"), "silver"), n(layer_table(spark, paths, kind, "quarantine"), "quarantined")]
    counts = functools.reduce(DataFrame.unionByName, parts)
    one = counts.agg(*[F.sum(F.when(F.col("what") == c, F.col("n"))).alias(c) for c in
                       ("landed", "bronze", "silver", "valid", "first", "invalid", "quarantined")])
    return one.withColumn("repeated", F.col("valid") - F.col("first")).select(
        F.lit(kind).alias("kind"), "landed", "bronze", "silver", "repeated", "invalid", "quarantined",
        (F.abs(F.col("landed") - F.col("bronze") - F.col("quarantined"))
         + F.abs(F.col("bronze") - F.col("silver") - F.col("repeated") - F.col("invalid"))).alias("unexplained"))


def await_all(spark: SparkSession, queries, timeout_s: int | None = None) -> None:
    """Wait for finite (``availableNow``) queries; the first failure is raised."""
    for q in queries:
        q.awaitTermination(timeout_s)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def run_until_failure(spark: SparkSession, queries) -> None:
    """STR-6: several continuous queries in one session. Returns when all
    have stopped; when any query fails, the others are stopped and the
    failure is raised, so the process exits non-zero and the supervisor
    restarts it from the checkpoints."""
    active = list(queries)
    while any(q.isActive for q in active):
        with contextlib.suppress(StreamingQueryException):  # raised below, once the others have stopped
            spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
        if any(q.exception() is not None for q in active):
            break
    failed = [q.exception() for q in active if q.exception() is not None]
    if failed:
        for q in active:
            q.stop()
        raise RuntimeError(str(failed[0]))
