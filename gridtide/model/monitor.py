"""Predictions against actuals: mergeable sums of errors, a daily report and a sequential test on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gridtide.operators import latest_per_key
from gridtide.plans.gold import VINTAGE
from gridtide.functions import forecast_offset
from gridtide.schemas import TARGET


def match_actuals(
    predictions: DataFrame, historic: DataFrame, target: str = TARGET, group: str = "zone"
) -> DataFrame:
    """Latest prediction of each (zone, vintage, hour, model) with the actual value, where there is one."""
    once = latest_per_key(
        predictions, [group, VINTAGE, "datetime", "model_version"], ["prediction_ingested_at"]
    )
    actual = historic.select(group, "datetime", F.col(target).cast("double").alias("actual")).filter("actual IS NOT NULL")
    return once.join(actual, [group, "datetime"], "inner")


def error_sums(predictions: DataFrame, historic: DataFrame, target: str = TARGET, group: str = "zone") -> DataFrame:
    """(group, model_version, day, forecast_offset_h, n, sum_error, sum_abs, sum_square) of the matched predictions.

    Sums of parts add up to the sums of the whole, so they can be kept per day and brought up to date day by day.
    A prediction that is NULL has no error and does not count.
    """
    matched = match_actuals(predictions, historic, target, group).withColumn("error", F.col("prediction") - F.col("actual"))
    return matched.filter("error IS NOT NULL").groupBy(
        F.col(group), "model_version", F.to_date("datetime").alias("day"),
        forecast_offset("datetime", VINTAGE).alias("forecast_offset_h"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("error").alias("sum_error"),
        F.sum(F.abs("error")).alias("sum_abs"),
        F.sum(F.col("error") * F.col("error")).alias("sum_square"),
    )


def _daily(sums: DataFrame, series: list[str]) -> DataFrame:
    """n, rmse, mae and bias per series and day, from sums of any finer grouping."""
    n = F.sum("n")
    return sums.groupBy(series[0], "day", *series[1:]).agg(
        n.alias("n"),
        F.sqrt(F.sum("sum_square") / n).alias("rmse"),
        (F.sum("sum_abs") / n).alias("mae"),
        (F.sum("sum_error") / n).alias("bias"),
    )


def quality_report(sums: DataFrame, by_offset: bool = False, trailing_days: int = 7, tolerance: float = 1.2) -> DataFrame:
    """n, rmse, mae and bias per model and day (and offset) from ``error_sums``, with a drift flag.

    ``drift`` is true when the RMSE is above ``tolerance`` times its mean over
    the up to ``trailing_days`` rows before it. The window runs over one row per
    day, after aggregation.
    """
    series = ["model_version", "forecast_offset_h"] if by_offset else ["model_version"]
    before = Window.partitionBy(*series).orderBy("day").rowsBetween(-trailing_days, -1)
    with_mean = _daily(sums, series).withColumn("rmse_trailing", F.avg("rmse").over(before))
    drift = F.coalesce(F.col("rmse") > F.col("rmse_trailing") * tolerance, F.lit(False))
    return with_mean.withColumn("drift", drift)


def monitor(
    predictions: DataFrame,
    historic: DataFrame,
    target: str = TARGET,
    group: str = "zone",
    by_offset: bool = False,
    trailing_days: int = 7,
    tolerance: float = 1.2,
) -> DataFrame:
    """The ``quality_report`` of all predictions that have an actual value."""
    return quality_report(error_sums(predictions, historic, target, group), by_offset, trailing_days, tolerance)


def change_alarms(
    sums: DataFrame,
    series: tuple[str, ...] = ("model_version", "forecast_offset_h"),
    baseline_days: int = 7,
    slack: float = 0.5,
    limit: float = 5.0,
) -> DataFrame:
    """(series, day, n, rmse, z, cusum, alarm): a sequential test for a lasting rise of the RMSE, from ``error_sums``.

    The first ``baseline_days`` days of a series give mean and standard deviation; ``z`` is a later day's distance from
    the mean in deviations. ``cusum`` adds up ``z - slack`` and never falls below 0; ``alarm`` says that it is above
    ``limit``. So many small rises count as much as one large one, which the drift flag would need. Without a
    deviation (a baseline of one day, or of equal days) ``z`` is NULL and counts as 0. Days without predictions are skipped.

    The recursion max(0, s + z - slack) equals the running sum less its lowest point so far (at most 0), so it is two
    windows over one row a day.
    """
    by = Window.partitionBy(*series)
    so_far = by.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    base = F.col("_day_no") <= baseline_days
    numbered = _daily(sums, list(series)).withColumn("_day_no", F.row_number().over(by.orderBy("day")))
    mean, deviation = (f(F.when(base, F.col("rmse"))).over(by) for f in (F.avg, F.stddev_samp))
    z = F.when(~base & (F.col("_deviation") > 0), (F.col("rmse") - F.col("_mean")) / F.col("_deviation"))
    step = F.when(base, 0.0).otherwise(F.coalesce("z", F.lit(0.0)) - slack)
    return (
        numbered.withColumn("_mean", mean).withColumn("_deviation", deviation).withColumn("z", z)
        .withColumn("_sum", F.sum(step).over(so_far))
        .withColumn("cusum", F.col("_sum") - F.least(F.lit(0.0), F.min("_sum").over(so_far)))
        .select(*series, "day", "n", "rmse", "z", "cusum", (F.col("cusum") > limit).alias("alarm"))
    )
