"""Moving per-key rows on by one day instead of computing them from the whole history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.operators.stats import driver_day_counts

TOTALS = ("zero_days", "total_cnt")


def driver_deltas(rows: DataFrame) -> DataFrame:
    """What history rows (``dt``, ``driver_id``, ``zero_cnt``, ``total_cnt``) give each driver: ``zero_days``, ``total_cnt``.

    Rows without a driver are left out: nobody's history is looked up by them.
    """
    days = rows.where(F.col("driver_id").isNotNull()).groupBy("driver_id", "dt").agg(F.max(F.when(F.col("zero_cnt") > 0, 1).otherwise(0)).alias("zero_days"), F.sum("total_cnt").alias("total_cnt"))
    return days.groupBy("driver_id").agg(F.sum("zero_days").alias("zero_days"), F.sum("total_cnt").alias("total_cnt"))


def move_totals(state: DataFrame | None, add: DataFrame | None, take: DataFrame | None) -> DataFrame:
    """``driver_id`` and ``TOTALS`` after adding one share and taking another back; drivers left with nothing go.

    The shares are summed per driver and joined to the state on ``driver_id``,
    which is never NULL.
    """
    signed = [df.select("driver_id", *[(sign * F.col(c)).alias(c) for c in TOTALS]) for df, sign in ((add, 1), (take, -1)) if df is not None]
    share = signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])
    share = share.groupBy("driver_id").agg(*[F.sum(c).alias(c) for c in TOTALS])
    if state is None:
        return share.where(" OR ".join(f"{c} <> 0" for c in TOTALS))
    named = share.select(F.col("driver_id").alias("_driver"), *[F.col(c).alias(f"_{c}") for c in TOTALS])
    joined = state.join(named, F.col("driver_id") == F.col("_driver"), "full")
    sums = [(F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in TOTALS]
    moved = joined.select(F.coalesce("driver_id", "_driver").alias("driver_id"), *sums)
    return moved.where(" OR ".join(f"{c} <> 0" for c in TOTALS))


def driver_stats_from(base: DataFrame, before: DataFrame, use_rc: bool = False) -> DataFrame:
    """:func:`~tripaudit.operators.stats.driver_stats` from the driver state before the day instead of the history."""
    today = driver_day_counts(base, use_rc)
    joined = today.join(before.select("driver_id", "zero_days", F.col("total_cnt").alias("_total")), "driver_id", "left")
    return joined.select(
        "driver_id",
        "today_zero_cnt",
        "today_cnt",
        F.coalesce("zero_days", F.lit(0)).cast("bigint").alias("acc_zero_days"),
        (F.coalesce("_total", F.lit(0)) + F.col("today_cnt")).alias("total_cnt"),
    )


def merge_latest(snapshot: DataFrame, rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row per key of a snapshot and of newer rows, both with one row per key.

    A tie keeps the snapshot's row. NULLs in ``order`` are the oldest.
    """
    names = snapshot.columns
    mine = snapshot.select(F.col(key).alias("_key"), F.struct(*names).alias("_mine"))
    theirs = rows.select(F.col(key).alias("_other"), F.struct(*names).alias("_theirs"))
    joined = mine.join(theirs, F.col("_key") == F.col("_other"), "full")

    def rank(side: str):
        return F.struct(*[F.col(f"{side}.{c}") for c in order])

    newer = F.col("_mine").isNull() | (rank("_theirs") > rank("_mine"))
    pick = F.when(F.col("_theirs").isNotNull() & newer, F.col("_theirs")).otherwise(F.col("_mine"))
    return joined.select(pick.alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in names])
