"""Finding groups too large for one task, and cutting them into ordered slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridtide.operators.sizes import broadcast_if_small
from gridtide.session import materialize

SLICE = "__slice"
# Hot groups that are broadcast at most (their keys alone), beyond it they are joined by a shuffle.
SMALL_GROUPS = 500_000
# Rows of a range that one task writes; smaller slices are cut from such a range.
RANGE_ROWS = 100_000


def hot_groups(df: DataFrame, keys: list[str], min_rows: int = 1_000_000) -> DataFrame:
    """(keys, prefixed, and ``__n``) of the groups with more than ``min_rows`` rows, whatever the size of the table."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > min_rows)
    return counts.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], "__n")


def split_off(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other groups, rows of hot groups); NULL is a group too."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__hot_{k}"))
    hot = broadcast_if_small(hot, SMALL_GROUPS)
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def sliced(df: DataFrame, keys: list[str], order_by: list[str], rows: int, slice_rows: int = 100_000) -> DataFrame:
    """``df`` with the slice of each row: ranges of (keys, order_by) of about ``slice_rows`` rows.

    Ranges are cut by rows, not by the values, so a dense stretch gets more of them,
    and many rows at one value of the first column are cut by the others. The rows
    are written out once with their slice, so a recomputed task cannot see other
    ranges. A slice never falls as the order rises within a group. Slices of less than
    ``RANGE_ROWS`` rows are cut from ranges of so many by rank, so tasks and files follow the rows,
    not the slices; rows that are equal in (keys, order_by) stay in one slice.
    """
    n = max(1, -(-4 * rows // (3 * max(slice_rows, RANGE_ROWS))))
    ranges = materialize(df.repartitionByRange(n, *keys, *order_by).withColumn(SLICE, F.spark_partition_id().cast("bigint")))
    if slice_rows >= RANGE_ROWS:
        return ranges
    at = F.rank().over(Window.partitionBy(SLICE).orderBy(*keys, *order_by)) - 1
    inner = F.floor(at / slice_rows)
    return materialize(ranges.withColumn(SLICE, F.shiftleft(SLICE, 32) + inner))
