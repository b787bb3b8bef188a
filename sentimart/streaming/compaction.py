"""Small-file compaction for streamed layers, and retirement of their batches.

A micro-batch writes a few files per date every 10-15 s. For a closed date the
job writes all batches so far as one compact folder (a salted shuffle, so a
date of any size is written by several tasks), and only when that folder is
complete are the batches it holds deleted. Readers skip the batches of a date
that a complete compact folder holds, so a crash at any point neither loses
nor repeats a row, and running the job again finishes the work. Late rows
arrive in later batches and join the next compaction of their date.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sentimart.streaming.sinks import BATCH, DATE, compacted, exists, folder, read_layer


def compact(spark: SparkSession, path: str, schema, dates: list, writers: int = 8,
            max_records_per_file: int = 5_000_000) -> None:
    """Compact ``dates`` of the layer at ``path`` and retire their batches."""
    if not exists(spark, path):
        return
    for date in dates:  # closed dates of one maintenance run
        rows = read_layer(spark, path, schema, [date])
        upto = rows.agg(F.max(BATCH)).first()[0]
        if upto is None:
            continue
        if upto > compacted(spark, path, [date]).get(str(date), -1):
            out = rows.filter(F.col(BATCH) <= upto).drop(BATCH, DATE)
            salt = F.pmod(F.xxhash64(*out.columns), F.lit(writers))
            (out.repartition(writers, salt).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
                .parquet(f"{path}_compact/{DATE}={date}/upto={upto}"))
        retire(spark, path, str(date))


def retire(spark: SparkSession, path: str, date: str) -> None:
    """Delete what the newest complete compact folder of ``date`` has replaced."""
    upto = compacted(spark, path, [date]).get(date, -1)
    for pattern, name, last in ((f"{path}/{DATE}={date}/{BATCH}=*", BATCH, upto), (f"{path}_compact/{DATE}={date}/upto=*", "upto", upto - 1)):
        fs, p = folder(spark, pattern)
        for status in fs.globStatus(p) or []:
            if int(status.getPath().getName().removeprefix(f"{name}=")) <= last:
                fs.delete(status.getPath(), True)


