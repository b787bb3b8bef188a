"""Incremental uniqueness (DQ-2, AGG-11): new dates against sketches of the old ones.

A table kept by date is checked for repeated keys without reading it again.
Each date's keys fall into hash buckets, and a cell (date, bucket) keeps its row
count and a theta sketch of its keys. A sketch of at most ``2**lg`` keys holds
the hashes of all of them, so two such cells share a key only if their sketches
meet; the size of the buckets is chosen so that cells stay within that. A cell
of more rows is always asked: nothing is estimated.

Adding dates sketches them (one scan of the new dates), joins their sketches to
the older ones by bucket, and groups the keys of the new dates together with
those of the cells that met, read from their own date partitions. So a new day
costs itself, the sketches (8 bytes a key), and the suspects.

Defined results: null keys are ignored; equal rows count each; a date added
again (late rows) replaces its sketches and is checked as new; a step run again
gives the same tables; keys are reported with their count over all dates as of
the last step that saw them (rows taken out of the table later do not lower it).
A null date is no date to add: such rows need one first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "date date, bucket int, n long, sketch binary"
FAILURES = "step string, value string, n_records long"


@dataclass(frozen=True)
class UniqueIndex:
    """Sketches and failures under ``root`` (shared folder) of the keys ``key`` of a table kept by ``date``; readable from the first step on."""

    root: str
    key: str
    date: str
    buckets: int = 64
    lg: int = 16

    def _read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def _keys(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col(self.key).isNotNull()).select(
            F.col(self.date).alias("date"), self._bucket().alias("bucket"), F.col(self.key).cast("string").alias("value"))

    def cells(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "cells", CELLS)

    def suspects(self, spark: SparkSession, dates: Sequence) -> DataFrame:
        """``(date, bucket)`` of older cells that may share a key with those of ``dates``."""
        all_cells, full = self.cells(spark), F.lit(1 << self.lg)
        new = all_cells.where(F.col("date").isin(list(dates))).groupBy("bucket").agg(
            F.sum("n").alias("new_n"), F.theta_union_agg("sketch", self.lg).alias("new_sketch"))
        old = all_cells.where(~F.col("date").isin(list(dates))).join(new, "bucket")
        meet = F.theta_sketch_estimate(F.theta_intersection("sketch", "new_sketch")) > 0
        return old.where((F.col("n") > full) | (F.col("new_n") > full) | meet).select("date", "bucket")

    def add(self, table: DataFrame, dates: Sequence, step: str) -> list:
        """Check and index ``dates`` of ``table`` (partitioned by date) as ``step``; returns the older dates that were read."""
        spark = table.sparkSession
        rows = self._keys(table.where(F.col(self.date).isin(list(dates))))
        found = rows.groupBy("date", "bucket").agg(F.count(F.lit(1)).alias("n"), F.theta_sketch_agg("value", self.lg).alias("sketch"))
        _replace(found, f"{self.root}/cells", "date")
        cells = self.suspects(spark, dates)
        asked = [r.date for r in cells.select("date").distinct().orderBy("date").collect()]  # dates of the calendar
        known = rows.select("value", F.lit(1).alias("new"))
        if asked:
            old = self._keys(table.where(F.col(self.date).isin(asked))).join(cells, ["date", "bucket"], "left_semi")
            known = known.unionByName(old.select("value", F.lit(0).alias("new")))
        failing = known.groupBy("value").agg(F.count(F.lit(1)).alias("n_records"), F.sum("new").alias("new")).where("new > 0 and n_records > 1")
        _replace(failing.select(F.lit(step).alias("step"), "value", "n_records"), f"{self.root}/failures", "step")
        return asked

    def failures(self, spark: SparkSession) -> DataFrame:
        """``(value, n_records)`` of the keys that occur more than once."""
        return self._read(spark, "failures", FAILURES).groupBy("value").agg(F.max("n_records").alias("n_records"))


def _replace(df: DataFrame, path: str, by: str) -> None:
    df.write.partitionBy(by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
