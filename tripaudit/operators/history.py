"""First-seen marking, risk-list and driver-history upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.times import shift_day
from tripaudit.operators.filters import risk_rows
from tripaudit.operators.joins import flag_members, not_in
from tripaudit.operators.rows import ID, append_rows
from tripaudit.operators.stats import driver_day_counts


def earlier_history(hist: DataFrame, day: int, keep_days: int = 10) -> DataFrame:
    """History rows of the ``keep_days`` before ``day``.

    Deviation from the source system: rows of later days are left out too, so
    a rerun of an old day gives what the first run gave.
    """
    return hist.where((F.col("execute_date") >= shift_day(day, -keep_days)) & (F.col("execute_date") < int(day)))


def mark_new(df: DataFrame, hist: DataFrame, day: int, keep_days: int = 10) -> DataFrame:
    """Add ``execute_date`` and ``is_new`` (1: order id not in the history).

    ``df`` holds suspects, one row per order.
    """
    seen = earlier_history(hist, day, keep_days).select(F.col(ID).cast("string").alias(ID))
    keyed = df.withColumn(ID, F.col(ID).cast("string"))
    return (
        flag_members(keyed, seen, ID, "_seen", salts=1)
        .withColumns(
            {"execute_date": F.lit(int(day)), "is_new": F.when(F.col("_seen"), 0).otherwise(1)}
        )
        .drop("_seen")
    )


def susp_history(marked: DataFrame, hist: DataFrame, day: int, keep_days: int = 10) -> DataFrame:
    """The history table after ``day``: kept rows as old, plus the new ones."""
    kept = earlier_history(hist, day, keep_days).withColumn("is_new", F.lit(0))
    typed = kept.withColumn(ID, F.col(ID).cast("string"))
    return append_rows(typed, marked.where(F.col("is_new") == 1))


def risk_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Risk list after a load: confirmed new rows replace old ones by order id."""
    confirmed = risk_rows(new)
    return append_rows(not_in(risk_rows(old), confirmed, ID, spread=("dt",)), confirmed)


def driver_hist_rows(base: DataFrame, day: int, use_rc: bool = False) -> DataFrame:
    """Today's history rows: drivers with a zero trip only."""
    counts = driver_day_counts(base, use_rc)
    return counts.select(
        F.lit(int(day)).alias("dt"),
        "driver_id",
        F.col("today_zero_cnt").alias("zero_cnt"),
        F.col("today_cnt").alias("total_cnt"),
    )


def driver_hist_append(hist: DataFrame, base: DataFrame, day: int, use_rc: bool = False) -> DataFrame:
    """Driver history with the rows of ``day`` replaced."""
    return append_rows(hist.where(F.col("dt") != int(day)), driver_hist_rows(base, day, use_rc))
