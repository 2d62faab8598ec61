"""Day summary, group counts, driver statistics and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.numbers import haversine_m, per_mille, right_closed_bin
from tripaudit.functions.text import version_label
from tripaudit.functions.times import epoch_hour, minutes_between
from tripaudit.operators.joins import map_label

# Bin edges and labels of the two histograms. A bin is named
# after its upper edge.
DISTANCE_EDGES = [0, 0.2, 0.5, 0.8, 1, 1.5, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10000000]
DISTANCE_LABELS = ["0.2", "0.5", "0.8", "1", "1.5", "2", "3", "4", "5", "6", "7", "8", "9", "10", "10+"]
DURATION_EDGES = [*range(21), 100000]
DURATION_LABELS = [*[str(i) for i in range(1, 21)], "20+"]

RATES = {
    "sys_zero_rate": "sys_zero",
    "no_rc_rate": "no_rc_zero",
    "adjust_zero_rate": "adjust_zero",
    "ext_zero_rate": "ext_zero",
}


def _hits(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")


def daily_summary(base: DataFrame, use_rc: bool = False) -> DataFrame:
    """Zero-distance counts and per-mille rates per day.

    With ``use_rc`` the frame carries ``is_rc`` and risk orders are left out
    of the zero counts; without it ``no_rc_zero`` is 0. Days without a match
    count 0.
    """
    zero = F.col("system_distance") == 0
    both = zero & (F.col("dependable_distance") == 0)
    clean = ~F.col("is_rc") if use_rc else F.lit(True)
    counts = base.groupBy("dt").agg(
        F.count("service_order_id").alias("total"),
        _hits(zero).alias("sys_zero"),
        (_hits(zero & clean) if use_rc else F.lit(0).cast("bigint")).alias("no_rc_zero"),
        _hits(both & clean).alias("adjust_zero"),
    )
    rest = F.col("no_rc_zero" if use_rc else "sys_zero") - F.col("adjust_zero")
    full = counts.withColumn("ext_zero", rest)
    rated = full.withColumns({rate: per_mille(F.col(n), F.col("total")) for rate, n in RATES.items()})
    return rated.orderBy("dt")


def zero_totals(base: DataFrame) -> DataFrame:
    """One row: risk orders, recorded zero, both zero, both zero without risk."""
    zero = F.col("system_distance") == 0
    both = zero & (F.col("dependable_distance") == 0)
    return base.agg(
        _hits(F.col("is_rc")).alias("risk"),
        _hits(zero).alias("sys_zero"),
        _hits(both).alias("both_zero"),
        _hits(both & ~F.col("is_rc")).alias("pure_zero"),
    )


def version_stats(zero: DataFrame) -> DataFrame:
    """Trips per app version label, by label."""
    labelled = zero.select(version_label(F.col("driver_version")).alias("driver_version"))
    return labelled.groupBy("driver_version").agg(F.count("*").alias("cnt")).orderBy("driver_version")


def city_stats(zero: DataFrame, labels: DataFrame) -> DataFrame:
    """Trips per city label, largest first.

    Counted per code before the label join: a dominating city is a handful of
    partial counts by then. Codes sharing a label are added up.
    """
    by_code = zero.groupBy("city").agg(F.count("*").alias("n"))
    named = map_label(by_code, labels, "city", "_city").groupBy(F.col("_city").alias("city"))
    return named.agg(F.sum("n").alias("cnt")).orderBy(F.desc("cnt"), "city")


def driver_totals(hist: DataFrame) -> DataFrame:
    """Trips per driver over the kept history."""
    return hist.groupBy("driver_id").agg(F.sum("total_cnt").alias("hist_total"))


def driver_bad_days(hist: DataFrame) -> DataFrame:
    """Days with a zero trip per driver."""
    bad = hist.where(F.col("zero_cnt") > 0)
    return bad.groupBy("driver_id").agg(F.count_distinct("dt").alias("acc_zero_days"))


def driver_day_counts(base: DataFrame, use_rc: bool = False) -> DataFrame:
    """Zero and all trips per driver, for drivers with a zero trip."""
    pure = (F.col("system_distance") == 0) & (F.col("dependable_distance") == 0)
    if use_rc:
        pure = pure & ~F.col("is_rc")
    counts = base.groupBy("driver_id").agg(
        _hits(pure).alias("today_zero_cnt"), F.count("service_order_id").alias("today_cnt")
    )
    return counts.where(F.col("today_zero_cnt") > 0)


def driver_stats(base: DataFrame, hist: DataFrame, day: int, use_rc: bool = False) -> DataFrame:
    """Per driver with a zero trip today: today's counts and the history.

    ``acc_zero_days`` leaves out today; ``total_cnt`` includes it. A driver
    without history has 0 earlier days and today's trips as the total. Where a
    driver state is kept, :func:`~tripaudit.operators.rolling.driver_stats_from`
    gives the same without reading the history.

    Deviation from the source system: later days do not count, so a rerun of
    an old day gives what the first run gave.
    """
    today = driver_day_counts(base, use_rc)
    past = (
        hist.where(F.col("dt") < int(day))
        .groupBy("driver_id")
        .agg(
            F.count_distinct(F.when(F.col("zero_cnt") > 0, F.col("dt"))).alias("acc_zero_days"),
            F.sum("total_cnt").alias("hist_total"),
        )
    )
    joined = today.join(past, "driver_id", "left")
    return joined.select(
        "driver_id",
        "today_zero_cnt",
        "today_cnt",
        F.coalesce("acc_zero_days", F.lit(0)).cast("bigint").alias("acc_zero_days"),
        (F.coalesce("hist_total", F.lit(0)) + F.col("today_cnt")).alias("total_cnt"),
    )


def bin_counts(df: DataFrame, ordinal: Column, labels: Sequence[str], name: str) -> DataFrame:
    """Rows per bin ordinal, every bin present, in bin order.

    At most one count per bin is broadcast.
    """
    n = len(labels)
    counts = (
        df.groupBy(ordinal.cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n"))
        .where(F.col("bin").between(0, n - 1))
    )
    bins = df.sparkSession.range(0, n, 1, 1).withColumnRenamed("id", "bin")
    names = F.array(*[F.lit(x) for x in labels])
    return (
        bins.join(F.broadcast(counts), "bin", "left")
        .select(
            F.col("bin").cast("int").alias("bin"),
            F.element_at(names, F.col("bin").cast("int") + 1).alias(name),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("cnt"),
        )
        .orderBy("bin")
    )


PICKUP_PAIR = ("start_longitude", "start_latitude", "expect_start_longitude", "expect_start_latitude")
PICKUP_PAIR_AS_FOUND = ("start_longitude", "start_latitude", "expect_end_longitude", "expect_start_latitude")


def pickup_km(cols: Sequence[str] = PICKUP_PAIR) -> Column:
    """Distance between actual and expected pickup in km, one decimal, half even."""
    return F.bround(haversine_m(*[F.col(c) for c in cols]) / 1000, 1)


def distance_hist(zero: DataFrame, cols: Sequence[str] = PICKUP_PAIR) -> DataFrame:
    """Pickup distance in 15 bins; a distance of 0 is in none of them.

    ``PICKUP_PAIR_AS_FOUND`` gives the numbers of the source system, which
    mixes the expected end longitude into the expected start.
    """
    ordinal = right_closed_bin(pickup_km(cols), DISTANCE_EDGES)
    return bin_counts(zero, ordinal, DISTANCE_LABELS, "start_pos_diff")


def hour_hist(zero: DataFrame) -> DataFrame:
    """Trips per Shanghai hour of start; always 24 rows."""
    counts = bin_counts(zero, epoch_hour(F.col("start_time")), [str(h) for h in range(24)], "hour")
    return counts.select(F.col("bin").alias("hour"), "cnt").orderBy("hour")


def duration_hist(zero: DataFrame) -> DataFrame:
    """Trip minutes in 21 bins; a duration of 0 is in none of them."""
    minutes = minutes_between(F.col("start_time"), F.col("end_time"))
    return bin_counts(zero, right_closed_bin(minutes, DURATION_EDGES), DURATION_LABELS, "duration")
