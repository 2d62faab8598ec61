"""Row filters of the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions import times
from tripaudit.functions.text import day_prefix, is_test_passenger

FINISHED = 7


def finished_orders(orders: DataFrame) -> DataFrame:
    """The order-side half of :func:`valid_trips`, for use before a join."""
    return orders.where((F.col("status") == FINISHED) & ~is_test_passenger(F.col("passenger_name")))


def versioned(ext: DataFrame) -> DataFrame:
    """The extension-side half of :func:`valid_trips`."""
    return ext.where(F.col("driver_version") != "")


def valid_trips(df: DataFrame) -> DataFrame:
    """Finished, with an app version, not placed by a tester; NULLs are dropped."""
    return versioned(finished_orders(df))


def in_days(df: DataFrame, first: int | str, last: int | str | None = None, col: str = "start_time") -> DataFrame:
    """Epoch seconds within whole Shanghai days, both ends included."""
    low, high = times.day_bounds(first, last)
    return df.where(F.col(col).between(low, high))


def prefix_day(df: DataFrame, col: str, day: int | str) -> DataFrame:
    return df.where(day_prefix(F.col(col), day))


def on_days(df: DataFrame, days: Sequence[int], col: str = "dt") -> DataFrame:
    """Rows of the listed days; prunes when ``col`` is a partition column."""
    return df.where(F.col(col).isin([int(d) for d in days]))


def pure_zero(df: DataFrame, use_rc: bool = False) -> DataFrame:
    """Trips with both distances 0; ``use_rc`` leaves out risk orders (``is_rc``)."""
    out = df.where((F.col("system_distance") == 0) & (F.col("dependable_distance") == 0))
    return out.where(~F.col("is_rc")) if use_rc else out


def risk_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_rc") == "T")


def recent_risk(df: DataFrame, day: int | str, days: int = 10) -> DataFrame:
    """Confirmed risk orders listed after ``day - days``."""
    return risk_rows(df).where(F.col("dt") > times.shift_day(day, -days))


def driver_devices(df: DataFrame) -> DataFrame:
    """Active devices of drivers."""
    return active_devices(df).where(F.col("user_type") == "DR")


def active_devices(df: DataFrame) -> DataFrame:
    return df.where((F.col("status") == 1) & (F.col("user_id") > 0))
