"""Zero-distance report: ten-day summary and distributions of one day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.times import dash_date, last_days
from tripaudit.operators import stats
from tripaudit.operators.bases import day_base, summary_base
from tripaudit.operators.filters import pure_zero, recent_risk
from tripaudit.operators.history import driver_hist_rows
from tripaudit.operators.joins import flag_members
from tripaudit.operators.rolling import driver_stats_from
from tripaudit.operators.rows import rename_cols
from tripaudit.sources.states import KeyedState, advance_drivers, drivers_before
from tripaudit.sources.writers import overwrite_partition, upsert_by_date, write_bundle

# Column names of the stored summary.
SUMMARY_NAMES = {
    "sys_zero": "zero_cnt",
    "no_rc_zero": "zero_cnt_no_rc",
    "adjust_zero": "dual_zero_cnt",
    "ext_zero": "non_dual_zero",
    "sys_zero_rate": "zero_rate",
    "no_rc_rate": "zero_no_rc_rate",
    "adjust_zero_rate": "dual_zero_rate",
    "ext_zero_rate": "non_dual_zero_rate",
}

SUMMARY_DAYS = 10


class EmptyReport(ValueError):
    """A report input has no rows."""


def require_rows(name: str, df: DataFrame) -> DataFrame:
    """Stop a report early when one of its inputs has no rows; runs a job."""
    if df.isEmpty():
        raise EmptyReport(f"{name} has no rows")
    return df


@dataclass
class ZeroInputs:
    """``risk``: confirmed risk orders, if known; ``use_rc`` leaves them out.

    ``driver_state``: the rolling driver state, if one is kept; the history is
    then not read. The summary leaves out every listed order, the tables of the day only
    those listed in the last ten days.
    """

    orders: DataFrame
    ext: DataFrame
    labels: DataFrame
    driver_hist: DataFrame
    risk: DataFrame | None = None
    use_rc: bool = False
    order: Sequence[str] = ("update_time",)
    driver_state: KeyedState | None = None

    def __post_init__(self) -> None:
        if self.use_rc and self.risk is None:
            raise ValueError("use_rc needs a risk list")


def report_summary(inputs: ZeroInputs, day: int, days: int = SUMMARY_DAYS) -> DataFrame:
    """Daily summary over the last ``days`` days, in the stored column names."""
    base = summary_base(inputs.orders, inputs.ext, last_days(day, days), inputs.order)
    if inputs.use_rc:
        # One row per order, already partitioned by order id.
        base = flag_members(base, inputs.risk, salts=1)
    return rename_cols(stats.daily_summary(base, inputs.use_rc), SUMMARY_NAMES)


def report_base(inputs: ZeroInputs, day: int) -> DataFrame:
    """Trips of the day, with ``is_rc`` set from the recent risk orders."""
    risk = None if inputs.risk is None else recent_risk(inputs.risk, day)
    return day_base(inputs.orders, inputs.ext, day, risk, order=inputs.order)


def _driver_stats(inputs: ZeroInputs, base: DataFrame, day: int) -> DataFrame:
    if inputs.driver_state is not None and inputs.driver_state.exists():
        return driver_stats_from(base, drivers_before(inputs.driver_state, day), inputs.use_rc)
    return stats.driver_stats(base, inputs.driver_hist, day, inputs.use_rc)


def zero_distance_report(inputs: ZeroInputs, day: int, base: DataFrame | None = None) -> dict[str, DataFrame]:
    """Report tables by name, each with its ``dt``; nothing runs here.

    All tables but the summary read ``base``; pass a persisted one to compute
    it once (see :func:`save_zero_report`).
    """
    base = report_base(inputs, day) if base is None else base
    zero = pure_zero(base, inputs.use_rc)
    parts = {
        "zero_detail": zero,
        "zero_version": stats.version_stats(zero),
        "zero_city": stats.city_stats(zero, inputs.labels),
        "zero_driver": _driver_stats(inputs, base, day),
        "zero_pos_diff": stats.distance_hist(zero).drop("bin"),
        "zero_hour_distribute": stats.hour_hist(zero),
        "zero_order_duration": stats.duration_hist(zero).drop("bin"),
    }
    dated = {name: df.withColumn("dt", F.lit(int(day))) for name, df in parts.items()}
    return {"zero_summary": report_summary(inputs, day), **dated}


def summary_sheet(summary: DataFrame) -> DataFrame:
    """The stored summary with ``yyyy-MM-dd`` dates, as shown to readers."""
    return summary.withColumn("dt", dash_date(F.col("dt")))


def save_zero_report(inputs: ZeroInputs, day: int, folder: str, hist_target: str | None = None) -> dict[str, str]:
    """Write the report tables under ``folder``, replacing their days also where no rows are left.

    The day base is computed once and kept in memory and on disk; a lost
    executor only costs recomputing its share. ``hist_target`` receives
    today's driver history rows.

    A day whose base has turned out empty has no report: its tables and its
    history are cleared of what an earlier run left there, the summary of the
    days before is left as it is, and :class:`EmptyReport` is raised.
    """
    base = report_base(inputs, day).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        frames = zero_distance_report(inputs, day, base)
        paths = {name: f"{folder.rstrip('/')}/{name}" for name in frames}
        history = driver_hist_rows(base, day, inputs.use_rc)
        if base.isEmpty():
            for name, df in frames.items():
                overwrite_partition(df.limit(0), paths[name], days=[day])
            if hist_target:
                overwrite_partition(history.limit(0), hist_target, days=[day])
            if inputs.driver_state is not None:
                advance_drivers(inputs.driver_state, history.limit(0), day)
        require_rows("day base", base)
        for name, df in frames.items():
            upsert_by_date(df, paths[name], days=last_days(day, SUMMARY_DAYS) if name == "zero_summary" else [day])
        if hist_target:
            overwrite_partition(history, hist_target, days=[day])
        if inputs.driver_state is not None:
            advance_drivers(inputs.driver_state, history, day)
        return paths
    finally:
        base.unpersist()


def bundle_zero_report(inputs: ZeroInputs, day: int, folder: str) -> dict[str, str]:
    """The report as one folder of tables, with the summary in reader's form."""
    base = report_base(inputs, day).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        frames = zero_distance_report(inputs, day, base)
        frames["zero_summary"] = summary_sheet(frames["zero_summary"])
        return write_bundle(frames, folder)
    finally:
        base.unpersist()
