"""Shared planning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

# A per-group statistics table is broadcast only below this many rows.
SMALL_ROWS = 1_000_000


def bounded_side(df: DataFrame, limit_rows: int = SMALL_ROWS) -> DataFrame:
    """Materialise a (usually tiny) aggregate and return it broadcast-hinted only when
    its row count is within ``limit_rows``; otherwise the join stays a shuffle join.
    The checkpoint makes the count and the later join read the same rows."""
    df = checkpoint(df)
    return F.broadcast(df) if df.count() <= limit_rows else df
