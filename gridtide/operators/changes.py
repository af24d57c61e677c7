"""What differs between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_HASH, _SIDE = "__hash", "__side"


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str], carry: list[str]) -> DataFrame:
    """(keys, ``old_{c}`` and ``new_{c}`` for each of ``carry``) of rows added, removed or altered.

    ``keys`` are unique on each side; NULL is a key like another. Rows are compared by a hash over the columns
    of ``after``, so what is shuffled is narrow however wide the rows are. A row that was added has NULL
    for the old values, one that was removed for the new ones.
    """
    columns = sorted(set(after.columns))

    def narrow(df: DataFrame, side: int) -> DataFrame:
        hashed = F.xxhash64(*columns).alias(_HASH)
        return df.select(*keys, *[F.col(c).alias(f"__{c}") for c in carry], hashed, F.lit(side).alias(_SIDE))

    def on(side: int, c: str):
        return F.max(F.when(F.col(_SIDE) == side, F.col(c)))

    both = narrow(before, 0).unionByName(narrow(after, 1)).groupBy(*keys).agg(
        on(0, _HASH).alias("__was"), on(1, _HASH).alias("__is"),
        *[on(side, f"__{c}").alias(f"{name}_{c}") for side, name in enumerate(("old", "new")) for c in carry],
    )
    return both.filter(~F.col("__was").eqNullSafe(F.col("__is"))).drop("__was", "__is")
