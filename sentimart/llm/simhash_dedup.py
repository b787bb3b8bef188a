"""SimHash near-duplicate classes by multi-index hashing.

Texts become 64-bit fingerprints (the majority bit of their word shingles'
hashes). Two fingerprints link if they differ in at most ``MAX_BITS`` bits; a
document's class is its connected component.

Search. A fingerprint has two 32-bit segments. If two fingerprints differ in
three bits or fewer, one segment differs in at most one: so every fingerprint
is filed under both segments, the ball of radius one round each segment is
enumerated, table matches are fetched by an equi-join, and complete distances
are verified. Segments one bit apart have different parity, so only those of
even parity enumerate their 32 neighbours; the others look up themselves.

Large groups. Equal fingerprints are one node, so copies never pair up. A
segment value that more than ``bucket`` different fingerprints share (many
near copies of one text) would still pair all of them; for such values balls
meet instead of rows. With the segment equal, the other halves link if they
differ in three bits or fewer: rows under each centre at distance two or less
meet a row at distance one or less from it, all of them linked by the triangle
inequality, so joining each row to one such row of the centre loses nothing
and keeps the work in proportion to the rows. With the segment one bit off,
both sides enumerate radius one (two bits in the other half).

Defined results: a null text is an empty one; texts without a word get
fingerprint zero and link like any other; a null doc_id links, but never
names a component (a component of null ids only gets null); repeated rows are
returned as often as they come; an empty table gives an empty result; other
columns are ignored by :func:`classes` and kept by :func:`deduplicated`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.llm.common import components, text_of, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Different fingerprints under one segment value from which balls meet instead of rows.
BUCKET = 64
BLOCK = 1 << 16


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one UTF-8 text."""
    tokens = raw.lower().split()  # bytes: A-Z only, and ASCII white space
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    n = min(shingle, len(tokens))
    starts, ends = (ends - sizes)[: len(tokens) - n + 1], ends[n - 1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprint_column(text: str | Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return of(text_of(text).cast("binary"))


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of all pairs within ``MAX_BITS``.

    ``fps``: distinct ``fp``.
    """
    halves = [F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)]
    filed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), halves[i].alias("home"), halves[1 - i].alias("rest")) for i in (0, 1)
    ])).alias("x")).select("fp", "x.*")
    size = filed.groupBy("seg", "home").agg((F.count(F.lit(1)) > bucket).alias("large"))
    filed = written(filed.join(size, ["seg", "home"]))
    return _by_rows(filed.where("not large")).unionByName(_by_balls(filed, filed.where("large")))


def _flips(value: Column) -> Column:
    """The 32 numbers one bit away from a 32-bit number."""
    return F.transform(F.sequence(F.lit(0), F.lit(31)),
                       lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


def _ball(value: Column, radius: int) -> Column:
    """All 32-bit numbers within ``radius`` bits of ``value``, with their distances."""
    masks = [(0, 0)] + [(1 << i, 1) for i in range(32)]
    if radius == 2:
        masks += [((1 << i) | (1 << j), 2) for i in range(32) for j in range(i)]
    table = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(d).alias("d")) for m, d in masks])
    return F.explode(F.transform(table, lambda x: F.struct(value.bitwiseXOR(x["m"]).alias("centre"), x["d"].alias("d"))))


def _by_rows(filed: DataFrame) -> DataFrame:
    """Enumerate, fetch and verify: segment values of few fingerprints."""
    home = F.col("home")
    even = F.bit_count(home) % 2 == 0
    ball = F.concat(F.array(home), F.when(even, _flips(home)).otherwise(F.array().cast("array<bigint>")))
    probes = filed.select("seg", home, F.col("fp").alias("u"), F.explode(ball).alias("key"))
    at = filed.select("seg", home.alias("key"), F.col("fp").alias("v"))
    return (probes.join(at, ["seg", "key"]).where("key <> home or u < v")
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).select("u", "v"))


def _by_balls(filed: DataFrame, large: DataFrame) -> DataFrame:
    """Segment values of many fingerprints: balls in the other half meet."""
    at = ["seg", "home", "centre"]
    rows = large.select("seg", "home", "fp", _ball(F.col("rest"), 2).alias("b")).select("seg", "home", "fp", "b.*")
    hubs = rows.where("d <= 1").groupBy(*at).agg(F.min("fp").alias("hub"))
    values = large.select("seg", "home").distinct()
    beside = values.select("seg", F.col("home").alias("large_home"), F.explode(_flips(F.col("home"))).alias("home"))
    guests = filed.select("seg", "home", "fp", "rest").join(beside, ["seg", "home"]).select(
        "seg", F.col("large_home").alias("home"), "fp", _ball(F.col("rest"), 1).alias("b"))
    met = rows.select(*at, "fp").unionByName(guests.select("seg", "home", F.col("b.centre").alias("centre"), "fp"))
    return met.join(hubs, at).where("hub <> fp").select(F.col("hub").alias("u"), F.col("fp").alias("v"))


def prints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row, written once: texts are read only here."""
    return written(docs.select("doc_id", fingerprint_column("text", shingle).alias("fp")))


def classes(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs(doc_id, text, ...)``."""
    marked = prints(docs, shingle)
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), bucket))
    own = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = written(own.join(least, "root").select("fp", "component_id"))
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """One document of each class: the row of its smallest doc_id, all columns.

    Rows that repeat a doc_id count as one document (the least row stays).
    Rows without a doc_id cannot be named as anyone's copy and all stay.
    """
    rest = [c for c in docs.columns if c != "doc_id"]
    first = classes(docs, shingle, bucket).where("doc_id = component_id").select("doc_id").distinct()
    one = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("_row"))
    kept = one.join(first, "doc_id", "left_semi").select("doc_id", *[F.col("_row")[c].alias(c) for c in rest])
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def fingerprint_text(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
