"""Size-checked broadcast.

``broadcast_if_small`` marks a side for a broadcast hash join only when its
estimated size (Catalyst's plan statistics, no job) is under the limit;
otherwise the side is left alone and Spark plans a shuffle join.  Lookup
tables (lexicons, gazetteers, stop words, k-means centres, document
frequencies) are bounded by construction, but the check stays so an
unexpectedly large input degrades to a shuffle instead of an executor OOM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # plan statistics unavailable (e.g. Spark Connect)
        return None


def broadcast_if_small(df: DataFrame, limit_bytes: int = DEFAULT_LIMIT_BYTES) -> DataFrame:
    size = estimated_size_bytes(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df


def broadcast_if_few(df: DataFrame, limit_rows: int = 500_000) -> DataFrame:
    """Broadcast a lookup table whose rows are counted first; plan statistics say nothing
    about a table made from local rows or an aggregate.  A larger one is shuffled."""
    return F.broadcast(df) if df.limit(limit_rows + 1).count() <= limit_rows else df
