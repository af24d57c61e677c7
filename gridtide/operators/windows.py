"""Latest row per key, and lag / rolling-mean features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridtide.operators.hot import SLICE, hot_groups, sliced, split_off
from gridtide.operators.ranges import at_time
from gridtide.session import materialize

# Rows of a slice of a hot group.
SLICE_ROWS = 100_000

_RANK, _HALO, _NEXT, _BEFORE = "__rank", "__halo", "__next", "__before"


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The one row of each key that is last by ``order_cols``.

    A hash over the row breaks ties, so equal vintages give the same row on every
    run. ``row_number() = 1`` lets Spark cut each task to one row per key before
    the shuffle, so a key with very many copies stays cheap.
    """
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = [F.col(c).desc() for c in order_cols] + [F.xxhash64(*plain).desc()]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_snapshot(df: DataFrame, ts_col: str) -> DataFrame:
    """The rows at the latest ``ts_col``; the maximum enters as a scalar subquery."""
    return at_time(df, df.agg(F.max(ts_col)).scalar(), ts_col)


def lag_rolling_features(
    df: DataFrame,
    cols: list[str],
    partition_by: list[str],
    order_by: list[str],
    lags: tuple[int, ...] = (0, 1),
    window_rows: int = 24,
    split_hot: bool = True,
    hot_options: dict | None = None,
    stats_df: DataFrame | None = None,
) -> DataFrame:
    """Add ``lag_{c}_{n}h`` and ``rolling_avg_{c}_{window_rows}h`` for each of ``cols``.

    Row-based within ``partition_by``, ordered by ``order_by``, which must be
    unique there. Short frames at the start are kept; NULLs do not enter a mean.

    A count per group, run at once, tells whether a group is too large for one
    task (more than ``min_rows`` of ``hot_options``). Such groups are cut into ordered
    slices of about ``slice_rows`` rows, each given the few rows before it that its
    first frames need; the result equals that of the uncut window. ``stats_df`` may
    name a cheaper frame with the same groups for the count.
    """
    options = dict(hot_options or {})
    slice_rows = options.pop("slice_rows", SLICE_ROWS)
    hot = hot_groups(df if stats_df is None else stats_df, partition_by, **options) if split_hot else None
    hot = None if hot is None else materialize(hot)
    rows = 0 if hot is None else hot.agg(F.sum("__n")).head()[0] or 0
    if not rows:
        return df.selectExpr("*", *_features(cols, partition_by, order_by, lags, window_rows))

    reach = max(window_rows - 1, *lags)
    cool, warm = split_off(df, partition_by, hot)
    cut = sliced(warm, partition_by, order_by, rows, slice_rows)
    both = cut.withColumn(_HALO, F.lit(False)).unionByName(_halo(cut, df.columns, partition_by, order_by, reach))
    both = both.unionByName(cool.withColumns({SLICE: F.lit(-1).cast("bigint"), _HALO: F.lit(False)}))
    made = both.selectExpr("*", *_features(cols, [*partition_by, SLICE], order_by, lags, window_rows))
    return made.filter(~F.col(_HALO)).drop(SLICE, _HALO)


def _features(cols, partition_by, order_by, lags, window_rows) -> list[str]:
    """All feature expressions, as text: hundreds of them go to the JVM in one call."""
    names = [", ".join(f"`{c}`" for c in part) for part in (partition_by, order_by)]
    over = "PARTITION BY {} ORDER BY {}".format(*names)
    frame = f"{over} ROWS BETWEEN {window_rows - 1} PRECEDING AND CURRENT ROW"
    out = []
    for c in cols:
        for n in lags:
            value = f"`{c}`" if n == 0 else f"lag(`{c}`, {n}) OVER ({over})"
            out.append(f"{value} AS `lag_{c}_{n}h`")
        out.append(f"avg(`{c}`) OVER ({frame}) AS `rolling_avg_{c}_{window_rows}h`")
    return out


def _halo(of_hot: DataFrame, columns: list[str], groups: list[str], order_by: list[str], reach: int) -> DataFrame:
    """Copies of the last ``reach`` rows before each slice, labelled with that slice.

    Ranking keeps at most ``reach`` rows per slice and task before the shuffle.
    A slice may hold fewer rows than the reach, so a row can serve several of the
    following slices: it does while fewer than ``reach`` rows lie between.
    """
    newest = Window.partitionBy(*groups, SLICE).orderBy(*[F.col(c).desc() for c in order_by])
    tails = of_hot.withColumn(_RANK, F.row_number().over(newest)).filter(F.col(_RANK) <= reach)

    following = Window.partitionBy(*groups).orderBy(SLICE).rowsBetween(1, reach)
    sizes = of_hot.groupBy(*groups, SLICE).agg(F.count(F.lit(1)).alias("__rows"))
    upcoming = sizes.select(
        *[F.col(g).alias(f"__s_{g}") for g in groups],
        F.col(SLICE).alias("__from"),
        F.collect_list(F.struct(F.col(SLICE), F.col("__rows"))).over(following).alias(_NEXT),
    )
    match = F.col(SLICE) == F.col("__from")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"__s_{g}"))
    between = F.expr(f"aggregate(slice({_NEXT}, 1, __pos), 0L, (a, s) -> a + s.__rows)")
    return (
        tails.join(upcoming, match, "inner")
        .select(*columns, _RANK, _NEXT, F.posexplode(_NEXT).alias("__pos", "__target"))
        .filter(F.col(_RANK) + between <= reach)
        .select(*columns, F.col(f"__target.{SLICE}").alias(SLICE), F.lit(True).alias(_HALO))
    )
