"""Broadcast behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast if a count finds at most ``max_rows`` rows, else unchanged.

    The count runs at once and reads only the columns that decide the number of
    rows. Unmarked, the join shuffles both sides and adaptive execution may still
    split its large partitions.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
