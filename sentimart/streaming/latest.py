"""Latest N per group, kept current (SRC-10, SORT-2).

State is a table of at most ``n`` rows a group, a version a batch. A batch's
own latest N (limited before its shuffle, so a hot group ships N rows a task)
join those of the version before, and the latest N of both are the next
version: the same as over all rows so far, as a row outside the latest N of a
part is outside the latest N of the whole. A batch that runs again starts from
the version before it and writes its version anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sentimart.operators.dedup import latest_n
from sentimart.sources import files

KEEP = 3


def versions(path: str) -> list[int]:
    """Complete versions, ascending."""
    return files.numbered(f"{path}/done")


def current(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The newest version (older than ``before``); empty if there is none."""
    known = [v for v in versions(path) if before is None or v < before]
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1]}") if known else spark.createDataFrame([], schema)


def fold(batch: DataFrame, epoch: int, path: str, group: str, time_col: str, n: int, tie: str, keep: int = KEEP) -> None:
    """Fold a batch into the state at ``path``."""
    both = latest_n(batch, group, time_col, n, tie).unionByName(current(batch.sparkSession, path, batch.schema, epoch))
    latest_n(both, group, time_col, n, tie).write.mode("overwrite").parquet(f"{path}/version={epoch}")
    files.put(f"{path}/done/{epoch:012d}.json", {"version": epoch})
    for old in versions(path)[:-keep]:  # readers of the last versions are not disturbed
        files.remove(f"{path}/done/{old:012d}.json")
        files.remove(f"{path}/version={old}")


def start_latest(rows: DataFrame, path: str, checkpoint: str, group: str, time_col: str, n: int, tie: str,
                 available_now: bool = False, seconds: int = 15, after=None):
    """Start the query that keeps the latest ``n`` rows of each group of a stream; ``after(epoch)`` runs behind each batch."""
    def sink(batch: DataFrame, epoch: int) -> None:
        fold(batch, epoch, path, group, time_col, n, tie)
        if after is not None:
            after(epoch)

    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{seconds} seconds")).start()
