"""Long-to-wide pivot of several measures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gridtide.schemas import sanitize


def pivot_measures(
    df: DataFrame,
    keys: list[str],
    pivot_col: str,
    values: list[str],
    measures: list[str],
    order_cols: list[str],
    name: Callable[[str], str] = sanitize,
) -> DataFrame:
    """One row per ``keys`` with a column ``{measure}_{name(value)}`` per value and measure.

    Several rows for one cell: the one latest by ``order_cols`` is taken whole,
    and equal ones are told apart by the measures, so the result does not depend
    on row order. Values outside the list are dropped, absent ones are NULL. The
    value list is fixed, so no job runs to find it, and the maximum is combined
    map-side: a cell with very many copies sends one row per task.
    """
    row = F.struct(*[F.col(c) for c in [*order_cols, *measures]])
    wide = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.max(row))
    cells = [f"`{v}`.`{m}` AS `{m}_{name(v)}`" for v in values for m in measures]
    return wide.selectExpr(*keys, *cells)
