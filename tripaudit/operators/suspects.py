"""Orders whose billed distance or time was adjusted after the trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.numbers import km, percent_of, percent_text
from tripaudit.functions.times import epoch_text
from tripaudit.operators.filters import finished_orders, versioned
from tripaudit.operators.rows import ID, latest_per_key

ORDER = ("update_time",)
TIME_COLUMNS = ("arrival_time", "start_time", "end_time", "update_time")


def _billed_more() -> Column:
    return km(F.col("dependable_distance")) > km(F.col("system_distance"))


def adjusted_orders(orders: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Finished orders with a changed distance, newest per (order, billed time, direction).

    Whether an order version counts as a suspect depends, next to its own
    distances, only on its billed time and on one recorded time per order. So
    the newest row of each of these groups is all that the suspect queries can
    ever return, and an order with very many versions is reduced before it
    reaches a join.
    """
    changed = finished_orders(orders).where(
        km(F.col("dependable_distance")) != km(F.col("system_distance"))
    )
    grouped = changed.withColumn("billed_more", _billed_more())
    return latest_per_key(grouped, [ID, "actual_time_length", "billed_more"], order)


def distance_suspects(orders: DataFrame, latest: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Billed distance above the recorded one while the time was left alone.

    The newest version among those that match, per order. There is one
    recorded time per order, so joining on (order, time) leaves one row.
    """
    up = finished_orders(orders).where(_billed_more())
    newest = latest_per_key(up, [ID, "actual_time_length"], order)
    ext = versioned(latest).withColumn("actual_time_length", F.col("runtime"))
    return newest.join(ext, [ID, "actual_time_length"])


def operation_suspects(orders: DataFrame, latest: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Both distance and time were changed; newest matching version per order."""
    joined = adjusted_orders(orders, order).join(versioned(latest), ID)
    return latest_per_key(joined.where(F.col("runtime") != F.col("actual_time_length")), [ID], order)


def all_suspects(orders: DataFrame, latest: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Both kinds in one pass over the orders, told apart by ``category``.

    One row per (order, category), ``distance`` or ``operation``.
    """
    joined = adjusted_orders(orders, order).join(versioned(latest), ID)
    same_time = F.col("runtime") == F.col("actual_time_length")
    category = F.when(same_time & F.col("billed_more"), "distance").when(~same_time, "operation")
    marked = joined.withColumn("category", category).where(F.col("category").isNotNull())
    return latest_per_key(marked, [ID, "category"], order)


def with_deviation(df: DataFrame) -> DataFrame:
    """Distances in km, their deviation, and the same for the billed time.

    A zero divisor gives NULL.
    """
    system, billed = F.col("system_distance"), F.col("dependable_distance")
    recorded, paid = F.col("runtime"), F.col("actual_time_length")
    distance_pct = percent_of(billed - system, billed)
    time_pct = percent_of(paid - recorded, paid)
    return df.withColumns(
        {
            "system_distance": km(system),
            "dependable_distance": km(billed),
            "deviation_distance": km(billed) - km(system),
            "distance_pct": distance_pct,
            "percent_deviation_distance": percent_text(distance_pct),
            "system_time": recorded,
            "dependable_time": paid,
            "time_pct": time_pct,
            "percent_time": percent_text(time_pct),
            "isDeviationPositive": F.when(km(billed) - km(system) > 0, 1).otherwise(0),
        }
    )


def cast_keys(df: DataFrame) -> DataFrame:
    """Ids as text, epoch columns as int."""
    texts = {c: F.col(c).cast("string") for c in (ID, "driver_id")}
    return df.withColumns({**texts, **{c: F.col(c).try_cast("int") for c in TIME_COLUMNS}})


# All that the report reads of a suspect.
SUSPECT_COLUMNS = [
    ID, "category", "driver_id", *TIME_COLUMNS, "driver_version", "predict_distance", "runtime",
    "actual_time_length", "system_distance", "dependable_distance",
]
COMMON = [ID, "driver_id", *TIME_COLUMNS, "driver_version", "predict_distance"]
DISTANCE_COLUMNS = [
    *COMMON, "system_distance", "dependable_distance", "deviation_distance",
    "pct_for_sort", "percent_deviation_distance",
]
OPERATION_COLUMNS = [
    *COMMON, "system_time", "dependable_time", "pct_for_sort", "percent_time",
    "system_distance", "dependable_distance", "deviation_distance", "isDeviationPositive",
]


def distance_detail(suspects: DataFrame) -> DataFrame:
    """Report columns of distance suspects, unsorted."""
    wide = cast_keys(with_deviation(suspects)).withColumn("pct_for_sort", F.col("distance_pct"))
    return wide.select(*DISTANCE_COLUMNS)


def operation_detail(suspects: DataFrame) -> DataFrame:
    """Report columns of operation suspects, unsorted."""
    wide = cast_keys(with_deviation(suspects)).withColumn("pct_for_sort", F.col("time_pct"))
    return wide.select(*OPERATION_COLUMNS)


def most_deviating_first(df: DataFrame) -> DataFrame:
    """Largest percentage first, then largest deviation.

    Both take few different values. The order id as the last key lets the sort
    cut a value shared by very many rows into several ranges.
    """
    return df.orderBy(F.desc("pct_for_sort"), F.desc("deviation_distance"), F.asc(ID))


def least_deviating_first(df: DataFrame) -> DataFrame:
    """The reverse report order; see :func:`most_deviating_first`."""
    return df.orderBy(F.asc("pct_for_sort"), F.asc("deviation_distance"), F.asc(ID))


def split_by_sign(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(billed more: start pressed late, billed less: detour or end pressed late)."""
    sign = F.col("isDeviationPositive")
    return df.where(sign == 1), df.where(sign == 0)


HELPER_COLUMNS = ("execute_date", "isDeviationPositive", "pct_for_sort", "device_type")


def format_detail(df: DataFrame) -> DataFrame:
    """Epoch columns to text, ``date`` from the start, helper columns dropped."""
    stamps = [c for c in (*TIME_COLUMNS, "device_update") if c in df.columns]
    out = df.withColumns({c: epoch_text(F.col(c)) for c in stamps})
    return out.withColumn("date", F.substring("start_time", 1, 10)).drop(*HELPER_COLUMNS)


def align_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per ``date`` and frame, one column per frame; NULL where none."""
    tagged = [df.select("date", F.lit(name).alias("category")) for name, df in frames.items()]
    merged = tagged[0]
    for df in tagged[1:]:
        merged = merged.unionByName(df)
    counts = [
        F.nullif(F.count_if(F.col("category") == name), F.lit(0).cast("bigint")).alias(name)
        for name in frames
    ]
    return merged.groupBy("date").agg(*counts).orderBy("date")
