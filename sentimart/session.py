"""Session construction and shared-folder resolution.

The library never assumes a machine-local scratch folder on a cluster: any
table it must materialise (lineage cuts, streaming checkpoints, landing
folders) lives under the folder named by ``spark.checkpoint.dir``. Only when
that setting is absent (local tests, ad-hoc runs) does it create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "sentimart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings every job relies on.

    * UTC session zone: DATE()/HOUR() buckets must not depend on the host.
    * AQE on: coalesces small shuffle partitions, converts joins to broadcast
      when a side's *measured* size is under the threshold, splits skewed
      partitions of sort-merge joins.
    * UI off: no server is opened by library jobs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # models of a build run side by side, each in a pool of its own
        "spark.scheduler.mode": "FAIR",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        # no Python call-site capture per Column call (error-message context
        # only; it costs milliseconds per expression while plans are built)
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # streaming dedup state lives off-heap in RocksDB, with changelog
        # checkpoints (state grows with arrival rate x watermark delay)
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # reliable checkpoint files (lineage cuts) are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Reduce partitions of one shuffle, at most. Beyond it map-output metadata
#: grows as maps x reducers; above 25 TB in one shuffle raise it (the driver
#: then needs memory for it) or let reducers work on more than the target.
MAX_SHUFFLE_PARTITIONS = 100_000


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024,
                     max_shuffle_partitions: int = MAX_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Sizing for a large cluster run (e.g. 100 TB on 1000 executors).

    The initial shuffle width is chosen so each reducer starts at about
    ``target_partition_bytes`` of input (at least 3 waves of tasks, at most
    ``max_shuffle_partitions``); AQE then coalesces small partitions toward
    the advisory size and splits skewed ones (a partition 5x the median and
    above 512 MB is split). Scan splits stay at 256 MB so a task's input
    fits executor memory.
    """
    shuffle = min(max_shuffle_partitions, max(3 * total_cores, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(32 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def ship(spark: SparkSession) -> str:
    """Send the package to the executors, where functions of its tasks import it; returns the archive's path.

    Needed where ``sentimart`` is not installed on them (``pip install .``) and the
    driver runs from a checkout; the entry points call it on a cluster."""
    import shutil
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="sentimart-ship-"), "sentimart")
    archive = shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    return archive


def cluster_session(app: str = "sentimart", input_bytes: int = 0) -> SparkSession:
    """The session of an entry point: sized for the cluster it runs on.

    Settings the submitter gave are kept; the rest comes from
    :func:`cluster_settings` for ``input_bytes`` (0: from the cores alone).
    """
    spark = build_session(app=app)
    given = spark.sparkContext.getConf()
    if not spark.sparkContext.master.startswith("local"):
        for k, v in cluster_settings(input_bytes, spark.sparkContext.defaultParallelism).items():
            if not given.contains(k):
                spark.conf.set(k, v)
        ship(spark)
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """Session settings the query semantics depend on (bucket zone)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables and stream checkpoints.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared, fault-tolerant folder there). Only on a local master, as in
    tests, a fresh folder stands in where it is unset; a cluster must name it.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        d = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sentimart-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    One run id ties a stream's table paths and its checkpoint together, so a
    fresh checkpoint can never overwrite batches of an earlier run.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sentimart/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem checks in tests."""
    return path[5:] if path.startswith("file:") else path


def exists(path: str) -> bool:
    return os.path.exists(local_path(path))
