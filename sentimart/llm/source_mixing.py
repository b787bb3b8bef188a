"""Mixing sources to target weights by entropy balancing, in Spark expressions only.

Targets. Sources share a multiple of the corpus's tokens by weight; a source
stops at ``MAX_COPIES`` times its own tokens, and what it cannot use is shared
again among the others until none is above.

Rates. Every token of document i enters at rate r_i. Among all rates that give
each source its target and leave the mix's length profile (the token-weighted
mean of z, the standardised log size) as it is in the corpus, the chosen ones
have the largest entropy relative to the corpus. The convex dual has one
multiplier per source and one for the profile, and the rates are its
exponential tilt, r_i = min(cap, exp(lambda_source + mu * z_i)). Newton steps
solve it: each step sums gradient and curvature over the documents on the
executors; only one row (the step for mu) comes to the driver, and the
multipliers stay a table with a row per source. Documents of equal source and
size have equal rates, so the sums run over a table of (source, size) cells
that is counted once.

Copies. Rates are rounded within each source by systematic rounding: along the
documents in order of size, the number of copies so far is the rounded sum of
the rates so far. Neighbours have nearly equal sizes, so a source's tokens miss
its target by about one document at most. Each cell is dealt into hash bins
whose number grows with the corpus, and ranks are taken within a bin, so
neither a hot source nor many documents of one size meet in one task.

Defined results: a null text has size 0 and a document of size 0 gets rate 0;
null is a source of its own, last in order; repeated rows are documents of
their own; an empty table gives an empty result; if no source has a token, all
targets are 0; an input column named like an output column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimart.llm.common import ranked, words, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2
#: Newton steps, and the relative error in a source's tokens at which they end.
STEPS, TOLERANCE = 40, 1e-9
#: Bound on mu, should a length profile be out of reach.
MAX_TILT = 1.0
#: Rates are rounded, so that the order of summation cannot show in the copies.
RATE_DIGITS = 7
#: Documents a hash bin of a (source, size) cell holds about, at most.
BIN_ROWS = 20_000


#: What names a cell: the source (null apart) and the size.
SOURCE = ["src", "no_src"]
CELL = [*SOURCE, "size"]


def records(docs: DataFrame) -> DataFrame:
    """``(doc_id, src, no_src, size, rows)``: equal rows counted."""
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("no_src"),
                       F.size(words("text")).cast("long").alias("size")).groupBy("doc_id", *CELL).agg(F.count(F.lit(1)).alias("rows"))


def targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> DataFrame:
    """``totals(src, no_src, source_size)`` with ``target``."""
    weight = F.array(*[F.lit(float(w)) for w in weights])
    sources = written(ranked(totals, [F.col("no_src"), F.col("src")], "_rank").select(
        *SOURCE, "source_size", weight[(F.col("_rank") % len(weights)).cast("int")].alias("w"),
        (F.col("source_size") * float(cap)).alias("most")))
    wanted = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0  # tokens per weight; sources that may give no more than level * w are full
    while True:
        full = F.col("most") <= level * F.col("w")
        held, open_ = sources.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("w")))).first()
        new = (wanted - (held or 0.0)) / open_ if open_ else level
        if new == level:
            return sources.select(*SOURCE, "source_size", F.least("most", level * F.col("w")).alias("target"))
        level = new


def rates(cells: DataFrame, aims: DataFrame, cap: float = MAX_COPIES, steps: int = STEPS) -> DataFrame:
    """``cells(src, no_src, size, n)`` with source_size, target and the ``rate`` of the cell's documents."""
    some = cells.where("size > 0")
    tokens = F.col("n") * F.col("size")
    z = F.log(F.col("size").cast("double"))
    total, mean, square = some.agg(F.sum(tokens), F.sum(tokens * z) / F.sum(tokens), F.sum(tokens * z * z) / F.sum(tokens)).first()
    if not total:
        return cells.join(aims, SOURCE).withColumn("rate", F.lit(0.0))
    z = (z - F.lit(mean)) / F.lit(math.sqrt(max(square - mean * mean, 0.0)) or 1.0)
    # A source whose target is all that it may give has the highest rate throughout.
    state = aims.where("source_size > 0").withColumn("at_cap", F.col("target") >= F.col("source_size") * cap * (1 - 1e-12))
    state = state.withColumn("lam", F.log(F.col("target") / F.col("source_size")))
    mu, highest = 0.0, math.log(cap)
    for step in range(steps):
        tilt = F.col("lam") + F.lit(mu) * z
        bound = F.col("at_cap") | (tilt >= highest)
        rate = F.when(bound, float(cap)).otherwise(F.exp(tilt))
        free = F.when(bound, 0.0).otherwise(tokens * rate)
        sums = written(some.join(state, SOURCE).groupBy(*SOURCE, "source_size", "target", "at_cap", "lam").agg(
            F.sum(tokens * rate).alias("got"), F.sum(tokens * rate * z).alias("profile"),
            F.sum(free).alias("a"), F.sum(free * z).alias("b"), F.sum(free * z * z).alias("c")))
        miss = F.col("target") - F.col("got")
        slope = F.when(F.col("a") > 0, F.col("b") / F.col("a")).otherwise(0.0)
        worst, off, curve = sums.agg(F.max(F.abs(miss) / F.col("target")), -F.sum("profile") - F.sum(slope * miss),
                                     F.sum(F.col("c") - slope * F.col("b"))).first()
        # The multiplier table eliminated (Schur complement): one equation is left, for mu.
        move = off / curve if curve > 1e-9 * total and step < steps // 2 else 0.0
        move = max(-MAX_TILT - mu, -0.5, min(MAX_TILT - mu, 0.5, move))
        if worst < TOLERANCE and abs(move) < 1e-6:
            break
        mu += move
        change = F.when(F.col("a") > 0, (miss - F.col("b") * F.lit(move)) / F.when(F.col("a") > 0, F.col("a"))).otherwise(
            F.signum(miss) * 0.5)
        state = sums.select(*SOURCE, "source_size", "target", "at_cap",
                            (F.col("lam") + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), change))).alias("lam"))
    tilt = F.col("lam") + F.lit(mu) * z
    rate = F.when(F.col("at_cap") | (tilt >= highest), float(cap)).otherwise(F.exp(tilt))
    found = cells.join(aims, SOURCE).join(state.select(*SOURCE, "at_cap", "lam"), SOURCE, "left")
    return found.select(*CELL, "n", "source_size", "target",
                        F.when(F.col("size") == 0, 0.0).otherwise(F.round(F.coalesce(rate, F.lit(0.0)), RATE_DIGITS)).alias("rate"))


def mix(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES,
        seed: int = 0) -> DataFrame:
    """``rows`` of :func:`records` with source_size, target, rate, ``copies`` and ``extra``.

    Each of the ``rows`` equal documents enters ``copies`` times, the first
    ``extra`` of them once more.
    """
    rows = written(rows)
    cells = written(rows.groupBy(*CELL).agg(F.sum("rows").alias("n")))
    aims = written(targets(cells.groupBy(*SOURCE).agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap))
    rated = written(rates(cells, aims, cap))
    # Systematic rounding along the cells of a source: a cell's share of the running sum.
    part = F.col("n") * (F.col("rate") - F.floor("rate"))
    along = Window.partitionBy(*SOURCE).orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(part).over(along)
    rated = rated.withColumn("_upto", F.floor(upto + 0.5)).select(
        *CELL, "n", "source_size", "target", "rate", F.floor("rate").cast("int").alias("copies"),
        F.least("n", F.greatest(F.lit(0), F.col("_upto") - F.coalesce(F.lag("_upto").over(Window.partitionBy(*SOURCE).orderBy("size")), F.lit(0)))).alias("more"))
    # The cell's extra copies, dealt to hash bins in proportion, then to a bin's documents in order.
    bins = max(1, -(-(cells.agg(F.sum("n")).first()[0] or 0) // BIN_ROWS))
    rows = rows.withColumn("_spot", F.xxhash64(F.lit(seed), "doc_id")).withColumn("_bin", F.pmod("_spot", F.lit(bins)))
    counts = rows.groupBy(*CELL, "_bin").agg(F.sum("rows").alias("_in"))
    past = F.sum("_in").over(Window.partitionBy(*CELL).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    shares = counts.withColumn("_past", past).join(rated, CELL)
    upto = lambda c: F.expr(f"more * ({c}) div n")
    shares = shares.withColumn("_share", upto("_past") - upto("_past - _in")).drop("_past", "_in", "n", "more")
    within = Window.partitionBy(*CELL, "_bin").orderBy("_spot", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(within), F.lit(0))
    got = rows.join(shares, [*CELL, "_bin"]).withColumn("_left", F.col("_share") - before)
    return got.select("doc_id", *CELL, "rows", "source_size", "target", "rate", "copies",
                      F.greatest(F.lit(0), F.least("rows", "_left")).cast("long").alias("extra"))


def taken(mixed: DataFrame) -> DataFrame:
    """One row per document of a :func:`mix`, with the words the mix takes of it."""
    each = mixed.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", "size", "source_size", "target", "rate",
                       (F.col("size") * (F.col("copies") + (F.col("_i") <= F.col("extra")).cast("int"))).alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs``, each row as often as the mix takes it; its columns only.

    Documents without a word have rate 0 and go.
    """
    found = mix(records(docs), **options)
    same = [F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("no_src"),
            F.size(words("text")).cast("long").alias("size"), F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    keys = [*CELL, "id", "no_id"]
    found = found.select(*CELL, F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "rows", "copies", "extra")
    there = docs.select(F.struct(*docs.columns).alias("row"), *same).join(found, keys)
    # Only a repeated document needs its place among the rows equal to it.
    single = there.where("rows = 1").withColumn("nth", F.lit(1))
    several = there.where("rows > 1").withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("row"))))
    out = single.unionByName(several).withColumn("times", F.col("copies") + (F.col("nth") <= F.col("extra")).cast("int"))
    return out.where("times > 0").select("row.*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_copy")).drop("_copy").select(*docs.columns)
