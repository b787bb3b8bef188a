"""The most frequent value of a group over an open set of values (AGG-6).

Partials are bounded: of each group and batch the ``k`` most frequent values
with their counts, and ``missed``, the most that any value left out can count
there. Merged over batches they bound every value's count from both sides: at
least the counts seen, at most those plus ``missed`` of each batch that does not
list it. Only values whose most reaches the best least can be the mode; a second
pass counts exactly those, by a semi-join, and the largest count wins (ties go
to the smallest value). If nothing unlisted can win, listed values are all that
the second pass looks at; else every value of that group is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 16


def summaries(rows: DataFrame, group: list[str], value: str, k: int = K) -> DataFrame:
    """``(group..., value, n, missed)``: at most ``k`` rows a group."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*group).orderBy(F.desc("n"), "value")
    top = counts.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    next_one = F.max(F.when(F.col("at") == k + 1, F.col("n"))).over(Window.partitionBy(*group))
    return top.withColumn("missed", F.coalesce(next_one, F.lit(0))).where(F.col("at") <= k).drop("at")


def contenders(partials: DataFrame, group: list[str], part: str) -> DataFrame:
    """``(group..., value)`` that can be the mode; a NULL value stands for all that no partial lists.

    ``partials``: summaries of several batches, told apart by ``part``."""
    missed = (partials.groupBy(*group, part).agg(F.max("missed").alias("m")).groupBy(*group).agg(F.sum("m").alias("missed_all")))
    seen = partials.groupBy(*group, "value").agg(F.sum("n").alias("least"), F.sum("missed").alias("own"))
    bounds = seen.join(missed, group).withColumn("most", F.col("least") + F.col("missed_all") - F.col("own"))
    best = bounds.groupBy(*group).agg(F.max("least").alias("best"), F.max("missed_all").alias("missed_all"))
    listed = bounds.join(best.drop("missed_all"), group).where("most >= best").select(*group, "value")
    unlisted = best.where("missed_all >= best").select(*group, F.lit(None).cast("string").alias("value"))
    return listed.unionByName(unlisted)


def mode_of(rows: DataFrame, partials: DataFrame, group: list[str], value: str, part: str) -> DataFrame:
    """``(group..., value, n)``: the exact mode of each group of ``rows``, whose batches gave ``partials``."""
    can = contenders(partials, group, part)
    pairs = rows.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("value"))
    named = pairs.join(can.where("value is not null"), [*group, "value"], "left_semi")
    open_ = pairs.join(can.where("value is null").select(*group), group, "left_semi").join(
        can.where("value is not null"), [*group, "value"], "left_anti")
    counts = named.unionByName(open_).groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*group).agg(F.min(F.struct((-F.col("n")).alias("less"), F.col("value"))).alias("b"))
    return best.select(*group, F.col("b.value").alias("value"), (-F.col("b.less")).alias("n"))
