"""Idempotent micro-batch sinks (SNK-1..5, STR-3, STR-4, SNK-10, AGG-13).

A layer is a folder of ``event_date=D/batch_id=N`` partitions, date first: a
reader that wants some dates loads the folders of those dates, and Spark lists
nothing else. A batch writes with a
dynamic overwrite of its (date, batch) partitions: a batch that is re-run
after a crash has the same input, hence the same partitions, and replaces its
own earlier output and nothing else. Table paths and checkpoint paths come
from one run folder, so a fresh checkpoint (epochs restarting at 0) never
meets an older run's batches.

Compaction (``compaction.py``) moves the batches of a date up to some epoch
into ``<layer>_compact/event_date=D/upto=N``; readers take the newest complete
compact folder of a date plus the batches after it.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("sentimart.streaming")

DATE, BATCH = "event_date", "batch_id"


@dataclass
class LayerSpec:
    path: str
    transform: Callable[[DataFrame], DataFrame] | None = None
    add_columns: dict = field(default_factory=dict)
    name: str | None = None

    @property
    def layer_name(self) -> str:
        return self.name or self.path.rstrip("/").rsplit("/", 1)[-1]


@dataclass
class BatchMetrics:
    """Row counts per epoch and layer, gathered with ``observe`` (no extra
    count jobs over the batch)."""
    rows: dict = field(default_factory=dict)

    def record(self, epoch: int, layer: str, n: int) -> None:
        self.rows[(epoch, layer)] = n

    def total(self, layer: str) -> int:
        return sum(n for (_, name), n in self.rows.items() if name == layer)


def write_layer(df: DataFrame, epoch: int, spec: LayerSpec, metrics: BatchMetrics | None = None,
                fmt: str = "parquet") -> int:
    """Write one layer of a batch; returns its row count. An empty result
    leaves no file behind."""
    if spec.transform:
        df = spec.transform(df)
    if spec.add_columns:
        df = df.withColumns(spec.add_columns)
    parts = [DATE, BATCH] if DATE in df.columns else [BATCH]
    obs = Observation(f"rows_{epoch}_{abs(hash(spec.path)) % 10**8}")
    df = df.withColumn(BATCH, F.lit(epoch)).observe(obs, F.count(F.lit(1)).alias("rows"))
    (df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
       .partitionBy(*parts).save(spec.path))
    n = obs.get.get("rows", 0)
    log.info("[%s] batch %d: %d rows -> %s", spec.layer_name, epoch, n, spec.path)
    if log.isEnabledFor(logging.DEBUG) and n:
        log.debug("[%s] batch %d preview: %s", spec.layer_name, epoch, preview(df))
    if metrics is not None:
        metrics.record(epoch, spec.layer_name, n)
    return n


def write_layers(batch: DataFrame, epoch: int, layers: list[LayerSpec],
                 metrics: BatchMetrics | None = None, fmt: str = "parquet") -> None:
    """Fan one micro-batch out to several layers with one persisted read."""
    batch = batch.persist()
    try:
        if not batch.isEmpty():
            for spec in layers:
                write_layer(batch, epoch, spec, metrics, fmt)
    finally:
        batch.unpersist()


# --- reading -------------------------------------------------------------------

def folder(spark: SparkSession, path: str):
    """(file system, path object) of a folder, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = folder(spark, path)
    return fs.exists(p)


NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def date_folder(path: str, date) -> str:
    return f"{path}/{DATE}={NO_DATE if date is None else date}"


def compacted(spark: SparkSession, path: str, dates: list | None = None) -> dict[str, int]:
    """The newest complete compact folder of each date (of ``dates``, or of all): date text -> epoch."""
    out: dict[str, int] = {}
    for d in ["*"] if dates is None else [str(d) for d in dates if d is not None]:
        fs, p = folder(spark, f"{path}_compact/{DATE}={d}/upto=*/_SUCCESS")
        for status in fs.globStatus(p) or []:
            m = re.search(rf"{DATE}=([^/]+)/upto=(\d+)/_SUCCESS$", status.getPath().toString())
            if m:
                out[m[1]] = max(int(m[2]), out.get(m[1], -1))
    return out


def read_layer(spark: SparkSession, path: str, schema: T.StructType, dates: list | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Every committed row of a layer, in its declared ``schema``.

    The schema names and types every column (also the partition column
    ``event_date``), so a symbol of digits stays text and a batch written
    before a column was added reads NULL there (SNK-5). A layer without a
    commit is empty; any other failure to read is raised. With ``dates`` (None
    in it means rows without a date) only the folders of those dates are listed
    and loaded, however many others the layer has."""
    full = T.StructType([f for f in schema.fields if f.name != BATCH] + [T.StructField(BATCH, T.IntegerType())])
    empty = spark.createDataFrame([], full)
    if not exists(spark, path):
        return empty
    if DATE not in full.fieldNames():
        return spark.read.format(fmt).schema(full).load(path)
    done = compacted(spark, path, dates)
    folders = [path] if dates is None else [f for f in dict.fromkeys(date_folder(path, d) for d in dates) if exists(spark, f)]
    df = spark.read.format(fmt).schema(full).option("basePath", path).load(folders) if folders else empty
    if done:
        # batches that a compact folder already holds are on their way out; both columns are partitions, so this prunes
        upto = F.create_map(*[F.lit(x) for d, n in sorted(done.items()) for x in (d, n)])
        df = df.filter(F.col(BATCH) > F.coalesce(F.try_element_at(upto, F.col(DATE).cast("string")), F.lit(-1)))
        compact = T.StructType([T.StructField("upto", f.dataType) if f.name == BATCH else f for f in full.fields])
        held = spark.read.format(fmt).schema(compact).option("basePath", f"{path}_compact").load(
            [f"{path}_compact/{DATE}={d}/upto={n}" for d, n in sorted(done.items())])
        df = df.unionByName(held.withColumnRenamed("upto", BATCH))
    return df if dates is None else df.filter(on_dates(dates))


def on_dates(dates: list):
    known = [d for d in dates if d is not None]
    cond = F.col(DATE).isin(known) if known else F.lit(False)
    return cond | F.col(DATE).isNull() if None in dates else cond


def conform(df: DataFrame, target) -> DataFrame:
    """Project ``df`` onto a declared target schema: missing columns become
    NULL of the declared type, extra columns are dropped (SNK-5)."""
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields])


def first_rows(df: DataFrame, n: int = 3, *order: str) -> DataFrame:
    """SORT-3: ``n`` rows of a batch, the first in ``order`` if given (a top-n per task, then of those)."""
    return (df.orderBy(*order) if order else df).limit(n)


def preview(batch: DataFrame, n: int = 3) -> list:
    """SNK-10: the first ``n`` rows of a batch for a debug log."""
    return first_rows(batch, n).collect()
