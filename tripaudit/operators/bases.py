"""The two order bases of the zero-distance report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.times import epoch_day
from tripaudit.operators.filters import finished_orders, in_days, on_days, valid_trips, versioned
from tripaudit.operators.joins import attach_versions, flag_members
from tripaudit.operators.rows import ID, latest_per_key

BASE_COLUMNS = [
    ID, "city", "status", "system_distance", "dependable_distance", "driver_version", "driver_id",
    "start_longitude", "start_latitude", "expect_start_longitude", "expect_start_latitude",
    "expect_end_longitude", "start_time", "end_time",
]


def summary_base(
    orders: DataFrame,
    ext: DataFrame,
    days: Sequence[int],
    order: Sequence[str] = ("update_time",),
) -> DataFrame:
    """Newest matching version per order over ``days``, re-dated by its start.

    The version list only decides whether an order counts at all, so it is a
    semi join, and it comes after the reduction to one row per order: both
    inputs are already partitioned by order id and free of hot keys.
    """
    matching = in_days(on_days(finished_orders(orders), days), days[0], days[-1])
    newest = latest_per_key(matching, [ID], order)
    with_version = versioned(on_days(ext, days)).select(ID).distinct()
    dated = newest.join(with_version, ID, "left_semi").select(
        epoch_day(F.col("start_time")).alias("dt"), ID, "system_distance", "dependable_distance", "start_time"
    )
    return on_days(dated, days)


def day_base(
    orders: DataFrame,
    ext: DataFrame,
    day: int,
    risk: DataFrame | None = None,
    dedupe: bool = False,
    order: Sequence[str] = ("update_time",),
) -> DataFrame:
    """All matching trips of one day, once per app version of the order.

    ``ext`` rows of the same day count. ``dedupe`` keeps the newest version of each order only. ``risk`` sets
    ``is_rc``; without it no row is flagged.
    """
    today = F.col("dt") == int(day)
    joined = attach_versions(orders.where(today), ext.where(today))
    matching = in_days(valid_trips(joined), day)
    if dedupe:
        matching = latest_per_key(matching, [ID], [*order, "driver_version"])
    base = matching.select(*BASE_COLUMNS)
    if risk is None:
        return base.withColumn("is_rc", F.lit(False))
    return flag_members(base, risk, ID, "is_rc", spread=("start_time", "end_time"))
