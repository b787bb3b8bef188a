"""Table catalogue: logical names -> locations (SRC-3, SRC-4, SNK-7).

Locations are parameters, never hard-coded paths inside a model.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# Names of the driver-provided input tables.
INPUT_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Source(NamedTuple):
    """A declared source: which layer of a streaming root holds it."""

    kind: str
    layer: str
    description: str


# The declared silver sources of the models (SRC-4).
SILVER_SOURCES = {
    "crypto_prices": Source("tick", "silver", "Cleaned price ticks"),
    "sentiment": Source("message", "silver", "Cleaned social messages with sentiment scores"),
    "news": Source("article", "silver", "Cleaned news articles with sentiment scores"),
}


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A declared source below a streaming root, in its declared schema."""
    from sentimart.streaming.jobs import StreamPaths, layer_table
    source = SILVER_SOURCES[name]
    return layer_table(spark, StreamPaths(root), source.kind, source.layer)


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one input table (Parquet; filters and projections push down)."""
    return spark.read.parquet(table_path(base, name))


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Expose DataFrames under their model names (lazy views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` as a catalog table bucketed and sorted by ``key``.

    Joins and semi-joins on ``key`` against a bucketed table shuffle only
    the other side (the planner uses the buckets as the partitioning), so a
    large table such as the documents is not moved by a key-based
    de-duplication or score join-back. Returns the table as a DataFrame."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
