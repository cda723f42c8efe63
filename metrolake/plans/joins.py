"""Join helpers: broadcast a side only when its size is checked."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Return ``broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df``.

    The check reads at most ``max_rows + 1`` rows (a limited count, cheap for
    dimension tables). Beyond the bound the plain frame is returned and Spark
    plans a shuffle join (AQE may still switch to broadcast at run time when
    the shuffled side turns out small)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
