"""From changes of the feature tables to the training rows they concern.

A training row of ingestion hour *v* rests on the history row at *v*, on the targets of the 24 hours
after it, on the forecasts of vintage *v*, and on whether any history row has vintage *v*. Read the other
way round, a changed history hour *t* of a zone concerns that zone's ingestion hours from *t* - 24 to *t*,
and a change of vintages or forecasts concerns these vintages in all zones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gridtide.operators import broadcast_if_small
from gridtide.plans.gold import SMALL_HOURS, VINTAGE
from gridtide.schemas import DAY

# (zone, hour) pairs that are broadcast at most (some 40 bytes each).
SMALL_PAIRS = 500_000
CHANGES = ["source", "zone", "datetime", f"old_{VINTAGE}", f"new_{VINTAGE}"]


def _hours(n: int):
    return F.make_dt_interval(F.lit(0), F.lit(n))


@dataclass(frozen=True)
class Scope:
    """Ingestion hours to build again: ``whole`` in all zones, ``single`` in one; both distinct and written out."""

    whole: DataFrame
    single: DataFrame
    horizon_hours: int = 24

    def hours(self) -> DataFrame:
        return self.whole.union(self.single.select(VINTAGE)).distinct()

    def days(self) -> DataFrame:
        """The days of the hours themselves and of the hours ahead of them."""
        last = F.col(VINTAGE) + _hours(self.horizon_hours)
        return self.hours().select(F.explode(F.sequence(F.to_date(VINTAGE), F.to_date(last))).alias(DAY)).distinct()

    def near(self, df: DataFrame) -> DataFrame:
        """The rows of a table on the days of the scope; with the partition column no other day is read.

        The days, some 365 a year at most, become a list in the filter, which prunes partitions for certain.
        """
        if DAY not in df.columns:
            return df
        return df.filter(F.col(DAY).isin([r[0] for r in self.days().collect()]))

    def marked(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with a boolean column: whether the row's zone and ingestion hour are in the scope."""
        whole = broadcast_if_small(self.whole.withColumn("__whole", F.lit(True)), SMALL_HOURS)
        single = broadcast_if_small(self.single.withColumn("__single", F.lit(True)), SMALL_PAIRS)
        joined = df.join(whole, VINTAGE, "left").join(single, ["zone", VINTAGE], "left")
        return joined.select(*df.columns, (F.col("__whole").isNotNull() | F.col("__single").isNotNull()).alias(column))

    def pick(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that are in the scope."""
        return self.marked(df, "__in").filter("__in").drop("__in")


def concerned(changes: DataFrame, horizon_hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """(vintages concerned in all zones, zones and vintages concerned), each distinct.

    ``changes`` has ``CHANGES``. A change without a zone (of forecasts) only concerns its vintages. A history
    row that keeps its vintage does not make or end one. NULL times concern nothing.
    """
    old, new = f"old_{VINTAGE}", f"new_{VINTAGE}"
    moved = changes.filter(F.col("zone").isNull() | ~F.col(old).eqNullSafe(F.col(new)))
    whole = moved.select(F.explode(F.array(old, new)).alias(VINTAGE)).dropna().distinct()
    at = F.date_trunc("hour", "datetime")
    back = F.sequence(at - _hours(horizon_hours), at, F.expr("INTERVAL 1 HOUR"))
    single = changes.filter("zone IS NOT NULL AND datetime IS NOT NULL").select("zone", F.explode(back).alias(VINTAGE))
    return whole, single.distinct()
