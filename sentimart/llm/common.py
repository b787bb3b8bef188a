"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words, and what a word is, in every contract here.
WHITESPACE = r"[\x20\x09-\x0D]+"
CHECKPOINT_CONF = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(column: str | Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text_of(column), WHITESPACE), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, as a lambda variable.

    A plain column used inside a lambda may be inlined by the optimizer and
    then evaluated again for every array element.
    """
    return F.transform(F.array(value), body)[0]


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor shares, as named in ``spark.checkpoint.dir``.

    Where the session names none, only a local master may fall back to a
    fresh folder of its own; a cluster has to name one.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sentimart-llm-")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder.rstrip("/")


def written(df: DataFrame, release: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives executors.

    With ``release`` the driver collects its garbage, so that Spark's cleaner
    lets the shuffle files of the finished step go now and not at its next
    periodic collection. (The listener bus holds the last event, and with it
    the plan just run, until another event comes; the empty statement is one.)
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if release:
        del df
        gc.collect()
        spark.sql("SELECT 1").collect()
        spark.sparkContext._jvm.System.gc()
    return table


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)``: rows ``(node, root)``.

    ``root`` is the smallest node that ``node`` reaches. Alternates large-star
    and small-star steps, so every round shortens the paths and the edge
    table never grows beyond its first size. Nodes without an edge are absent.
    Each round is written, so a lost executor costs one round at most.
    """
    pairs = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = _digest(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k"))
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        pairs = written(small)
        now = _digest(pairs)
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def ranked(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """``df`` with a gapless global position, without one task seeing all rows.

    Rows are range-partitioned and written once; each partition's count gives
    the next one's offset, and only partitions (not rows) meet in one task.
    Equal rows take neighbouring positions.
    """
    part = "_part"
    parts = written(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    offsets = parts.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_offset", F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)))
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return (parts.withColumn("_within", within).join(offsets.select(part, "_offset"), part)
            .withColumn(name, F.col("_offset") + F.col("_within") - 1 + start)
            .drop(part, "_offset", "_within"))


def blocks_by_weight(df: DataFrame, weight: Column, limit: int, seed: int = 0) -> Iterator[DataFrame]:
    """``df`` (a written table of distinct rows) in parts of at most ``limit`` in weight, or of one row that weighs more.

    Rows fall into hash bins of half the limit on average; a bin beyond the
    limit is split again. Only sums come to the driver.
    """
    total, rows = df.agg(F.sum(weight), F.count(F.lit(1))).first()
    if not rows:
        return
    if rows == 1 or total <= limit:
        yield df
        return
    bins = max(2, int(-(-2 * total // limit)))
    bin_of = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(bins))
    for k in range(bins):
        yield from blocks_by_weight(df.where(bin_of == k), weight, limit, seed + 1)
