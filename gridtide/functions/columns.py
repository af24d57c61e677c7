"""Choosing columns from a schema, and handling of missing values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

NUMERIC_TYPES = ("double", "long", "integer")


def feature_columns(df: DataFrame, prefixes: Iterable[str]) -> list[str]:
    """Columns that start with one of ``prefixes``, in schema order. Runs no job."""
    wanted = tuple(prefixes)
    return [c for c in df.columns if c.startswith(wanted)]


def numeric_columns(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Those of ``cols`` that exist and are double, long or integer. Runs no job."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return [c for c in cols if kinds.get(c) in NUMERIC_TYPES]


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL or NaN in any (or any named) column.

    One condition per column: each can reach the scan on its own. A single
    condition over all columns would be copied by the optimizer once for every
    combination of renamed columns.
    """
    kinds = dict(df.dtypes)
    tests = []
    for c in df.columns if cols is None else cols:
        tests.append(f"`{c}` IS NOT NULL")
        if kinds[c] in ("double", "float"):
            tests.append(f"NOT isnan(`{c}`)")
    return df.filter(" AND ".join(tests)) if tests else df


def fill_numeric(df: DataFrame, value: float | None = 0) -> DataFrame:
    """Fill NULL and NaN of numeric columns; ``None`` leaves them."""
    return df if value is None else df.fillna(value)
