"""Suspicious-order report: adjusted trips, explained and marked new or seen."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.times import epoch_text, last_days
from tripaudit.operators import suspects as S
from tripaudit.operators.filters import in_days, on_days
from tripaudit.operators.history import earlier_history
from tripaudit.operators.joins import DEVICE_COLUMNS, LOG_COLUMNS, attach_device, attach_distance_log, latest_ext
from tripaudit.operators.rows import ID
from tripaudit.operators.tracks import classify_trips
from tripaudit.plans.zero_report import require_rows
from tripaudit.sources.tables import expire_partitions
from tripaudit.sources.writers import overwrite_partition, write_bundle

KEEP_DAYS = 10


@dataclass
class SuspInputs:
    """``ext`` is partitioned by ``dt``. ``devices``: newest row per user. ``log``: parsed, with ``log_day``.

    ``distance_hist`` and ``operation_hist`` are the first-seen tables
    (``service_order_id``, ``execute_date``). ``point_day`` names the column
    the points are partitioned by, if they are, and ``point_index`` is their
    kept :func:`~tripaudit.operators.tracks.slice_index`.
    """

    orders: DataFrame
    ext: DataFrame
    devices: DataFrame
    points: DataFrame
    log: DataFrame
    distance_hist: DataFrame
    operation_hist: DataFrame
    order: Sequence[str] = ("update_time",)
    ext_tiebreak: Sequence[str] = field(default_factory=tuple)
    point_day: str | None = None
    point_index: DataFrame | None = None


def report_suspects(inputs: SuspInputs, day: int, days: int = 10) -> DataFrame:
    """Suspects of both kinds over the last ``days`` days."""
    window = last_days(day, days)
    ext = on_days(inputs.ext, window)
    orders = in_days(on_days(inputs.orders, window), window[0], window[-1])
    found = S.all_suspects(orders, latest_ext(ext, inputs.ext_tiebreak), inputs.order)
    return found.select(*S.SUSPECT_COLUMNS)


def _seen_before(inputs: SuspInputs, day: int) -> DataFrame:
    """Orders in the history of their category, as (order id as text, category)."""
    parts = [
        earlier_history(hist, day, KEEP_DAYS).select(F.col(ID).cast("string").alias(ID), F.lit(category).alias("category"))
        for category, hist in (("distance", inputs.distance_hist), ("operation", inputs.operation_hist))
    ]
    return parts[0].unionByName(parts[1]).distinct().withColumn("_seen", F.lit(True))


def marked_suspects(inputs: SuspInputs, day: int, suspects: DataFrame) -> DataFrame:
    """Suspects of both kinds with type, new-or-seen mark, distance-service and device columns.

    One pass for both kinds: ``category`` stays a column and is split off last.
    What is keyed by the order comes first, the devices last.
    """
    typed = classify_trips(S.with_deviation(suspects), inputs.points, [ID, "category"], day_col=inputs.point_day, index=inputs.point_index, whole=True)
    typed = S.cast_keys(typed).join(_seen_before(inputs, day), [ID, "category"], "left")
    dated = typed.withColumns({"execute_date": F.lit(int(day)), "is_new": F.when(F.col("_seen"), 0).otherwise(1)})
    return attach_device(attach_distance_log(dated.drop("_seen"), inputs.log), inputs.devices)


ADDED = [*DEVICE_COLUMNS, "device_update", "susp_type", *LOG_COLUMNS, "execute_date", "is_new"]


def split_categories(marked: DataFrame) -> dict[str, DataFrame]:
    """Report columns of the marked suspects by category."""
    distance = marked.where(F.col("category") == "distance").withColumn("pct_for_sort", F.col("distance_pct"))
    operation = marked.where(F.col("category") == "operation").withColumn("pct_for_sort", F.col("time_pct"))
    return {
        "distance": distance.select(*S.DISTANCE_COLUMNS, *ADDED),
        "operation": operation.select(*S.OPERATION_COLUMNS, *ADDED),
    }


def suspect_summary(suspects: DataFrame) -> DataFrame:
    """Suspects per day and kind, NULL where there are none: one conditional aggregate.

    Counted before the enrichment, which neither adds nor drops rows.
    """
    wide = S.with_deviation(suspects).withColumn("date", F.substring(epoch_text(F.col("start_time")), 1, 10))
    operation = F.col("category") == "operation"
    kinds = {
        "distance": F.col("category") == "distance",
        "no_start": operation & (F.col("isDeviationPositive") == 1),
        "no_end": operation & (F.col("isDeviationPositive") == 0),
    }
    counts = [F.nullif(F.count_if(cond), F.lit(0).cast("bigint")).alias(name) for name, cond in kinds.items()]
    return wide.groupBy("date").agg(*counts).orderBy("date")


def report_sheets(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Sorted and formatted sheets of the marked suspects."""
    no_start, no_end = S.split_by_sign(parts["operation"])
    return {
        "distance_sheet": S.format_detail(S.most_deviating_first(parts["distance"])),
        "no_start_sheet": S.format_detail(S.most_deviating_first(no_start)),
        "no_end_sheet": S.format_detail(S.least_deviating_first(no_end)),
    }


def suspicious_report(inputs: SuspInputs, day: int, suspects: DataFrame | None = None) -> dict[str, DataFrame]:
    """All frames of the report; nothing runs here.

    Suspects are used twice, as trips to be explained and as what is explained:
    pass kept ones to compute them once. To write the frames, use
    :func:`save_suspicious_report`, which computes all shared parts once.
    """
    suspects = report_suspects(inputs, day) if suspects is None else suspects
    parts = split_categories(marked_suspects(inputs, day, suspects))
    return {"summary": suspect_summary(suspects), **parts, **report_sheets(parts)}


def save_suspicious_report(
    inputs: SuspInputs, day: int, folder: str, distance_target: str, operation_target: str
) -> dict[str, str]:
    """Write the sheets and append the new suspects to the first-seen tables.

    The tables are partitioned by ``execute_date``: a rerun of a day replaces
    its own rows, and since only earlier days are compared with, a target may
    be the very table the history was read from. Catalog tables also lose the
    days that are past the comparison window.

    Suspects and their enriched form are kept while the tables are written; a
    lost executor only costs recomputing its share.

    A day without suspects has no report: the sheets and the day's rows in both
    tables are cleared of what an earlier run left there, and
    :class:`~tripaudit.plans.zero_report.EmptyReport` is raised.
    """
    kept = [report_suspects(inputs, day).persist(StorageLevel.MEMORY_AND_DISK)]
    suspects = kept[0]
    try:
        kept.append(marked_suspects(inputs, day, suspects).persist(StorageLevel.MEMORY_AND_DISK))
        parts = split_categories(kept[1])
        if suspects.isEmpty():
            write_bundle({name: df.limit(0) for name, df in {"summary": suspect_summary(suspects), **report_sheets(parts)}.items()}, folder)
            for name, target in (("distance", distance_target), ("operation", operation_target)):
                overwrite_partition(parts[name].limit(0), target, "execute_date", days=[day])
        require_rows("suspects", suspects)
        paths = write_bundle({"summary": suspect_summary(suspects), **report_sheets(parts)}, folder)
        for name, target in (("distance", distance_target), ("operation", operation_target)):
            fresh = parts[name].where(F.col("is_new") == 1)
            overwrite_partition(fresh, target, "execute_date", days=[day])
            if "/" not in target:
                expire_partitions(fresh.sparkSession, target, day, KEEP_DAYS + 1, "execute_date")
        return paths
    finally:
        for df in kept:
            df.unpersist()
