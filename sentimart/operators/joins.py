"""Join helpers with explicit size checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows; beyond the bound the
    DataFrame is returned unchanged and the planner uses a shuffle join.
    Meant for dimension tables (lexicon, watch-list), not for data that
    grows with the input.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
