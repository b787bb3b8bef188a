"""Weighted rendezvous sharding, in Spark expressions only.

Every record key scores every shard with a hash of (key, shard); the record
goes to the shard with the lowest ``-ln(u) / weight``, ``u`` being the hash as
a number between 0 and 1. Key and shard count alone decide, a shard's share
follows its weight, and one more shard takes rows only into itself. Assigning
is a projection: no shuffle, no state, and any executor gives the same answer.

:func:`numbered` gives each shard's rows gapless slots. Equal rows are counted
before the shuffle, rows are range-partitioned, and only the partitions'
counts meet, so neither a hot key nor a large shard lands in one task.

Defined results: a null key counts as the empty string (all such rows share a
shard); a null text is empty; repeated rows share a shard and get slots of
their own; an empty table gives an empty result; an input column named like
an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimart.llm.common import let, text_of, written

SHARDS = 40
#: Bytes a record costs beside its text.
OVERHEAD = 16
#: Bits of the hash that make ``u`` (13 hexadecimal digits: exact in a double).
BITS = 52


def unit(key: Column, shard: Column) -> Column:
    """A number between 0 and 1, exclusive, from (key, shard)."""
    digits = F.substring(F.md5(F.concat(key, F.lit("/"), shard.cast("string")).cast("binary")), 1, BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << BITS)


def placed(df: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS,
           grown_weight: float = 1.0) -> DataFrame:
    """``df`` with ``shard`` and ``grown_shard`` (with one more shard of ``grown_weight``)."""
    if not weights or min(*weights, grown_weight, 1) <= 0:
        raise ValueError("weights must be positive")
    n = len(weights)
    weight = F.array(*[F.lit(float(w)) for w in [*weights, grown_weight]])
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    scores = F.transform(F.sequence(F.lit(0), F.lit(n)),
                         lambda j: F.struct((-F.log(unit(name, j)) / weight[j]).alias("score"), j.alias("shard")))
    best = let(scores, lambda s: F.struct(F.array_min(F.slice(s, 1, n))["shard"].alias("shard"),
                                          F.array_min(s)["shard"].alias("grown_shard")))
    return df.withColumn("_best", best).withColumn("shard", F.col("_best.shard")).withColumn(
        "grown_shard", F.col("_best.grown_shard")).drop("_best")


def numbered(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """``rows`` (narrow: every column takes part in the order) with ``slot``, 0 to n - 1 in each shard."""
    order = [shard, *[c for c in rows.columns if c != shard]]
    distinct = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    parts = written(distinct.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part", shard).agg(F.sum("_n").alias("_sum")).select(
        "_part", shard, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part", shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (parts.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
            .join(offsets, ["_part", shard])
            .withColumn("_first", F.col("_offset") + F.col("_before"))
            .withColumn("slot", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)))
            .select(*rows.columns, "slot"))


def records(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32)`` of ``docs``: UTF-8 bytes with overhead, unsigned checksum."""
    raw = text_of("text").cast("binary")
    return docs.select("doc_id", (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
