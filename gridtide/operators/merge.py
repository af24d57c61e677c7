"""Merges as DataFrame operators.

Keys compare with ``=``: a NULL key never matches, so such source rows are
always inserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_MATCHES, _NEW = "__matches", "__new"


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], validate: bool = True, small_source: bool = False
) -> DataFrame:
    """Target with each matched row replaced, and unmatched source rows added.

    The source rows are brought to one per key first (map-side), so copies of one
    key collapse before the join. Several target rows with one key are replaced one
    by one. With ``validate`` a target row matched by several source rows fails the
    job, as a merge must; without it the source row that is last by content
    replaces it. ``small_source`` is for a source known to be small: it is broadcast
    and the target is not shuffled for the replacement.
    """
    plain = [c for c in source.columns if c not in keys]
    counted = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_MATCHES), F.max_by(F.struct(F.lit(True), *plain), F.xxhash64(*source.columns)).alias(_NEW)
    )
    if small_source:
        counted = F.broadcast(counted)
    joined = target.join(counted, keys, "left")
    matched = F.col(_MATCHES).isNotNull()
    if validate:
        several = F.raise_error(F.lit("several source rows match one target row"))
        matched = F.when(F.col(_MATCHES) > 1, several.cast("boolean")).otherwise(matched)
    replaced = [
        F.col(c) if c in keys else F.when(matched, F.col(f"{_NEW}.{c}")).otherwise(F.col(c)).alias(c) for c in target.columns
    ]
    if small_source:  # only the target keys that the source has leave their task
        met = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi").distinct()
        fresh = source.join(F.broadcast(met), keys, "left_anti").select(*source.columns)
    else:
        fresh = unmatched_source(target, source, keys)
    return joined.select(*replaced).unionByName(fresh)


def unmatched_source(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows without a target row of equal keys.

    Target keys are made distinct first, so copies of one key cannot pile up in
    one task; the source side is the one that adaptive execution can split.
    """
    return source.join(target.select(*keys).distinct(), keys, "left_anti").select(*source.columns)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose keys it lacks; target rows stay as they are."""
    return target.unionByName(unmatched_source(target, source, keys))
