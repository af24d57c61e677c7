"""Lag and rolling mean by time instead of by row: a gap in a series stays a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtide.operators.hot import SLICE, hot_groups, sliced, split_off
from gridtide.operators.sizes import broadcast_if_small
from gridtide.operators.windows import SLICE_ROWS
from gridtide.session import materialize

# Slices whose starts are broadcast at most (a key and two numbers each).
SMALL_STARTS = 500_000

_HALO, _FIRST, _BUCKET = "__halo", "__first", "__bucket"


def time_range_features(
    df: DataFrame,
    cols: list[str],
    partition_by: list[str],
    ts_col: str,
    lags: tuple[int, ...] = (1,),
    window_hours: int = 24,
    split_hot: bool = True,
    hot_options: dict | None = None,
) -> DataFrame:
    """Add ``lag_{c}_exact_{n}h`` and ``rolling_avg_{c}_range_{window_hours}h`` for each of ``cols``.

    A lag is the value exactly ``n`` hours earlier, NULL if the series has no such row. A
    mean covers the half-open span of ``window_hours`` that ends with the row's own time, however
    many rows lie in it; NULL values do not enter it. Rows must be unique by (``partition_by``,
    ``ts_col``); a row without a time gets NULL lags and means.

    A group with more rows than ``min_rows`` of ``hot_options`` is cut into slices of about
    ``slice_rows`` rows. Each slice gets copies of the rows that lie less than the longest
    reach before its first row, in whatever slices they are, so a gap costs no copies.
    """
    options = dict(hot_options or {})
    slice_rows = options.pop("slice_rows", SLICE_ROWS)
    timed, untimed = df.filter(F.col(ts_col).isNotNull()), df.filter(F.col(ts_col).isNull())
    hot = materialize(hot_groups(timed, partition_by, **options)) if split_hot else None
    rows = 0 if hot is None else hot.agg(F.sum("__n")).head()[0] or 0
    if rows:
        cool, warm = split_off(timed, partition_by, hot)
        cut = sliced(warm, partition_by, [ts_col], rows, slice_rows)
        reach = max(window_hours, *lags)
        both = cut.withColumn(_HALO, F.lit(False)).unionByName(_halo(cut, df.columns, partition_by, ts_col, reach))
        both = both.unionByName(cool.withColumns({SLICE: F.lit(-1).cast("bigint"), _HALO: F.lit(False)}))
        made = both.selectExpr("*", *_frames(cols, [*partition_by, SLICE], ts_col, lags, window_hours))
        made = made.filter(~F.col(_HALO)).drop(SLICE, _HALO)
    else:
        made = timed.selectExpr("*", *_frames(cols, partition_by, ts_col, lags, window_hours))
    return made.unionByName(untimed, allowMissingColumns=True)


def _frames(cols, partition_by, ts_col, lags, window_hours) -> list[str]:
    over = "PARTITION BY {} ORDER BY `{}`".format(", ".join(f"`{c}`" for c in partition_by), ts_col)
    # Times are whole microseconds, so this is the span without its far end.
    span = f"RANGE BETWEEN INTERVAL '{window_hours - 1}:59:59.999999' HOUR TO SECOND PRECEDING AND CURRENT ROW"
    out = []
    for c in cols:
        for n in lags:
            at = f"RANGE BETWEEN INTERVAL '{n}' HOUR PRECEDING AND INTERVAL '{n}' HOUR PRECEDING"
            out.append(f"first_value(`{c}`) OVER ({over} {at}) AS `lag_{c}_exact_{n}h`")
        out.append(f"avg(`{c}`) OVER ({over} {span}) AS `rolling_avg_{c}_range_{window_hours}h`")
    return out


def _halo(cut: DataFrame, columns: list[str], groups: list[str], ts_col: str, reach: int) -> DataFrame:
    """Copies of the rows at most ``reach`` hours before the first row of a later slice, labelled with that slice.

    Time is cut into buckets of the reach. Such a row lies in the bucket of the slice's
    first row or in the one before it, so an equi-join on group and bucket finds all of them.
    """
    width = reach * 3_600_000_000
    micros = F.unix_micros(F.col(ts_col))
    starts = cut.groupBy(*groups, SLICE).agg(F.min(micros).alias(_FIRST)).select(
        *[F.col(g).alias(f"__s_{g}") for g in groups], F.col(SLICE).alias("__target"), _FIRST,
        F.floor(F.col(_FIRST) / width).alias("__at"),
    )
    own = cut.withColumn(_BUCKET, F.floor(micros / width))
    near = own.withColumn(_BUCKET, F.explode(F.array(_BUCKET, F.col(_BUCKET) + 1)))
    match = F.col(_BUCKET) == F.col("__at")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"__s_{g}"))
    inside = (F.col("__target") > F.col(SLICE)) & (micros < F.col(_FIRST)) & (micros >= F.col(_FIRST) - width)
    return near.join(broadcast_if_small(starts, SMALL_STARTS), match & inside, "inner").select(
        *columns, F.col("__target").alias(SLICE), F.lit(True).alias(_HALO)
    )
