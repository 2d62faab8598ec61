"""GPS tracks: points of a trip, gaps between fixes, rules that explain a trip.

``trips`` carry ``service_order_id``, ``start_time``, ``end_time`` (and, for
the rules, ``arrival_time``, ``system_distance`` in km and
``predict_distance`` in metres). ``points`` carry ``service_order_id``, ``t``
(epoch seconds), ``latitude`` and ``longitude``.

How a huge track is kept from landing in one task. Trips and points meet on
(order, time slice) instead of on the order alone, and everything that looks
at neighbouring fixes works within one slice first; the per-slice results (a
few numbers each) are then combined per order, where only the step from one
slice to the next non-empty one is left to add. Copies of a fix are counted
before the window sees them.

A trip of up to ``FEW`` slices meets all of them. For a longer one, also one
whose end is in milliseconds, it is looked up in the index of slices that hold
fixes which of them its track has; where no index is kept, it is built from the
points of such orders only, and without such a trip the points are not read for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripaudit.functions.times import epoch_day
from tripaudit.operators.joins import sieve
from tripaudit.operators.rows import ID

SLICE = 3600
FEW = 48
BEFORE = 300
AFTER = 300
LONG_GAP = 300

# Texts of the classification.
NO_TRACK = "无轨迹数据"
LOST_MIDDLE_OK_ENDS = "开始和结束正常，中途丢点"
FORGOT_START = "轨迹正常，司机忘记点击出发"
LOST_EN_ROUTE = "行驶途中丢点"
DRIVER_DISPUTE = "轨迹、里程无误，但司机异议"
UNKNOWN = "unknow"


def _slice(t: Column) -> Column:
    return F.floor(t / SLICE)


def slice_index(points: DataFrame, day_col: str | None = None) -> DataFrame:
    """Slices that hold fixes, one row per (order, slice): as many as a track has hours.

    Keep it as a table beside the points (with ``day_col`` partitioned like
    them, so that a day is replaced in both) and hand it to what takes an
    ``index``; points are then not read to build it.
    """
    days = [day_col] if day_col else []
    found = points.where(F.col("t").isNotNull()).groupBy(ID, _slice(F.col("t")).alias("slice"), *days)
    return found.agg(F.count("*").alias("fixes"))


def _sliced_points(
    trips: DataFrame,
    points: DataFrame,
    before: int,
    after: int,
    point_cols: Sequence[str],
    day_col: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    low, high = F.col("start_time") - before, F.col("end_time") + after
    first, last = _slice(low), _slice(high)
    long = trips.where(last - first >= FEW)
    held = slice_index(sieve(points, long)) if index is None else index
    looked_up = long.join(held.select(ID, "slice"), ID).where(F.col("slice").between(first, last))
    short = trips.where((last >= first) & (last - first < FEW))
    spread = short.withColumn("slice", F.explode(F.sequence(first, last))).unionByName(looked_up)
    on = [ID, "slice"]
    if day_col:
        spread = spread.withColumn(day_col, epoch_day(F.col("slice") * SLICE))
        on.append(day_col)
    cut = points.withColumn("slice", _slice(F.col("t"))).select(*on, *point_cols)
    return spread.join(cut, on).where(F.col("t").between(low, high))


def trip_points(
    trips: DataFrame,
    points: DataFrame,
    before: int = BEFORE,
    after: int = AFTER,
    day_col: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Points of each trip from ``before`` s ahead of it to ``after`` s past it.

    An equi join on (order, time slice) with the exact range as residual; the
    slices of a trip come from ``index`` (:func:`slice_index`, built from the
    points unless given). A trip with an unknown time, or one that ends more
    than ``before + after`` ahead of its start, has no points. If the points
    are partitioned by the Shanghai day of ``t`` (``yyyymmdd``), name that
    column in ``day_col``: it becomes a join key (a slice never spans two
    days), so that Spark can prune the days no trip touches.
    """
    cols = [c for c in points.columns if c not in (ID, day_col)]
    found = _sliced_points(trips, points, before, after, cols, day_col, index)
    return found.drop("slice", *([day_col] if day_col else []))


def _fix_runs(points: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(keys, slice, t, fixes, gap): ``gap`` to the next second in the slice."""
    runs = points.groupBy(*keys, "slice", *extra, "t").agg(F.count("*").alias("fixes"))
    order = Window.partitionBy(*keys, "slice").orderBy("t")
    return runs.withColumn("gap", F.lead("t").over(order) - F.col("t"))


def _bridges(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the step from the last fix of a slice to the first of the next."""
    order = Window.partitionBy(*keys).orderBy("slice")
    return slices.withColumn("bridge", F.lead("first_t").over(order) - F.col("last_t"))


def with_gap(points: DataFrame, keys: Sequence[str] = (ID,), order: Sequence[str] = ()) -> DataFrame:
    """Every fix but the last of its track, with all columns and the seconds to the next one (``gap``).

    ``order`` tells fixes of one second apart; all but the last of them have a
    gap of 0. Neighbours are looked up within a slice, and only a slice's last
    fix looks for the first one of the next slice.
    """
    cut = points.withColumn("slice", _slice(F.col("t")))
    ends = cut.groupBy(*keys, "slice").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))
    bridges = _bridges(ends, keys).select(*keys, "slice", "bridge")
    within = Window.partitionBy(*keys, "slice").orderBy("t", *order)
    stepped = cut.withColumn("gap", F.lead("t").over(within) - F.col("t")).join(bridges, [*keys, "slice"], "left")
    gap = F.coalesce("gap", "bridge")
    return stepped.withColumn("gap", gap).where(F.col("gap").isNotNull()).drop("slice", "bridge")


def mean_interval(first: Column, last: Column, n: Column) -> Column:
    """``floor((last - first) / n)``, 0 without fixes.

    The divisor is the number of fixes, not of gaps, and the result is cut to
    whole seconds, as the rules' thresholds expect.
    """
    return F.coalesce(F.floor(F.try_divide(last - first, n)), F.lit(0)).cast("bigint")


def avg_interval(points: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Mean fix interval per track."""
    return points.groupBy(*keys).agg(
        mean_interval(F.min("t"), F.max("t"), F.count("*")).alias("avg_interval")
    )


def distinct_positions(points: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Number of different (latitude, longitude) pairs per track."""
    pairs = points.select(*keys, "latitude", "longitude").distinct()
    return pairs.groupBy(*keys).agg(F.count("*").alias("n_positions"))


def _gap_summary(runs: DataFrame, keys: Sequence[str], long_gap: int) -> DataFrame:
    """Shortest, longest and distinct long gaps per track, from fix runs.

    A track of ``s`` seconds has at most ``s / long_gap`` distinct long gaps
    and one bridge per slice, so the arrays stay small.
    """
    repeated = F.when(F.col("fixes") > 1, F.lit(0).cast("bigint"))
    per_slice = runs.groupBy(*keys, "slice").agg(
        F.min(F.least("gap", repeated)).alias("min_gap"),
        F.max(F.greatest("gap", repeated)).alias("max_gap"),
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
        F.collect_set(F.when(F.col("gap") > long_gap, F.col("gap"))).alias("long"),
    )
    bridged = _bridges(per_slice, keys)
    long_bridge = F.when(F.col("bridge") > long_gap, F.array("bridge")).otherwise(
        F.array().cast("array<bigint>")
    )
    return bridged.groupBy(*keys).agg(
        F.min(F.least("min_gap", "bridge")).alias("min_gap"),
        F.max(F.greatest("max_gap", "bridge")).alias("max_gap"),
        F.sort_array(
            F.array_distinct(F.flatten(F.collect_list(F.concat("long", long_bridge)))), asc=False
        ).alias("long_gaps"),
    )


def gap_stats(points: DataFrame, keys: Sequence[str] = (ID,), long_gap: int = LONG_GAP) -> DataFrame:
    """``min_gap``, ``max_gap`` and ``long_gaps`` per track with points.

    A single fix has no gap: NULL bounds and no long gaps. With ``long_gap``
    <= 0 the list is empty.
    """
    runs = _fix_runs(points.withColumn("slice", _slice(F.col("t"))), keys)
    out = _gap_summary(runs, keys, max(long_gap, 0))
    if long_gap <= 0:
        out = out.withColumn("long_gaps", F.array().cast("array<bigint>"))
    return out


def gap_bounds(trips: DataFrame, points: DataFrame, keys: Sequence[str] = (ID,)) -> DataFrame:
    """Shortest and longest gap per trip; (-1, -1) for a trip without points."""
    known = gap_stats(points, keys).withColumn("_has", F.lit(True))
    joined = trips.select(*keys).join(known, list(keys), "left")

    def bound(c: str) -> Column:
        return F.when(F.col("_has"), F.col(c)).otherwise(F.lit(-1).cast("bigint")).alias(c)

    return joined.select(*keys, bound("min_gap"), bound("max_gap"))


def long_gaps(
    trips: DataFrame, points: DataFrame, gap: int = LONG_GAP, keys: Sequence[str] = (ID,)
) -> DataFrame:
    """Distinct gaps longer than ``gap`` per trip, longest first; ``[]`` if none."""
    known = gap_stats(points, keys, gap).select(*keys, "long_gaps")
    none = F.array().cast("array<bigint>")
    return (
        trips.select(*keys)
        .join(known, list(keys), "left")
        .select(*keys, F.coalesce("long_gaps", none).alias("long_gaps"))
    )


def track_stats(
    trips: DataFrame,
    points: DataFrame,
    keys: Sequence[str] = (ID,),
    before: int = BEFORE,
    after: int = AFTER,
    long_gap: int = LONG_GAP,
    day_col: str | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """All numbers the rules need, one row per trip that has points.

    ``keys`` identify a trip. ``avg_before`` covers the fixes up to the start, ``avg_after`` those from
    the end on, the rest those in between; a fix right on an end is in both.
    The fixes a trip has are used twice, for gaps and for positions. Both uses
    begin with the same grouping of all columns, and positions are counted with
    a condition instead of a filter, so that they share one exchange of the
    joined fixes, and trips and points are joined once. Both results meet in a
    grouping: a join would pass a condition of the caller down to both uses in
    two forms, and nothing would be shared.
    """
    window = [*keys, "start_time", "end_time"]
    slim = trips.select(*dict.fromkeys([ID, *window]))
    columns = ["t", "latitude", "longitude"]
    near = _sliced_points(slim, points, before, after, columns, day_col, index)
    in_trip = F.col("t").between(F.col("start_time"), F.col("end_time"))

    # Copies of a fix first, then all fixes of a second.
    fix = [*window, "slice", "t", "latitude", "longitude"]
    # With a fixed number AQE leaves the parts small: grouped fixes are many times their shuffled size.
    partitions = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = near.groupBy(*fix).agg(F.count("*").alias("n")).repartition(partitions, *window, "slice")
    fixes = counted.groupBy(*fix).agg(F.sum("n").alias("n"))
    runs = fixes.groupBy(*window, "slice", "t").agg(F.sum("n").alias("fixes"))
    phases = {
        "before": F.col("t") <= F.col("start_time"),
        "in": in_trip,
        "after": F.col("t") >= F.col("end_time"),
    }
    parts = [
        part
        for name, cond in phases.items()
        for part in (
            F.min(F.when(cond, F.col("t"))).alias(f"first_{name}"),
            F.max(F.when(cond, F.col("t"))).alias(f"last_{name}"),
            F.sum(F.when(cond, F.col("fixes"))).alias(f"n_{name}"),
        )
    ]
    order = Window.partitionBy(*window, "slice").orderBy("t")
    following = F.lead("t").over(order)
    inside = runs.withColumn("next_t", following).withColumns(
        {
            "gap": F.when(in_trip & (F.col("next_t") <= F.col("end_time")), F.col("next_t") - F.col("t")),
            "repeated": F.when(in_trip & (F.col("fixes") > 1), F.lit(0).cast("bigint")),
        }
    )
    per_slice = inside.groupBy(*window, "slice").agg(
        *parts,
        F.min(F.least("gap", "repeated")).alias("min_gap"),
        F.max(F.greatest("gap", "repeated")).alias("max_gap"),
        F.collect_set(F.when(F.col("gap") > long_gap, F.col("gap"))).alias("long"),
    )
    later = Window.partitionBy(*keys).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    next_first = F.last("first_in", ignorenulls=True).over(later)
    bridged = per_slice.withColumn("bridge", next_first - F.col("last_in"))
    long_bridge = F.when(F.col("bridge") > long_gap, F.array("bridge")).otherwise(
        F.array().cast("array<bigint>")
    )
    whole = bridged.groupBy(*keys).agg(
        *[F.min(f"first_{p}").alias(f"first_{p}") for p in phases],
        *[F.max(f"last_{p}").alias(f"last_{p}") for p in phases],
        *[F.sum(f"n_{p}").alias(f"n_{p}") for p in phases],
        F.min(F.least("min_gap", "bridge")).alias("min_gap"),
        F.max(F.greatest("max_gap", "bridge")).alias("max_gap"),
        F.array_distinct(F.flatten(F.collect_list(F.concat("long", long_bridge)))).alias("long"),
    )
    stats = whole.select(
        *keys,
        *[
            mean_interval(F.col(f"first_{p}"), F.col(f"last_{p}"), F.col(f"n_{p}")).alias(f"avg_{p}")
            for p in phases
        ],
        F.when(F.col("n_in") > 0, F.col("min_gap")).otherwise(-1).alias("min_gap"),
        F.when(F.col("n_in") > 0, F.col("max_gap")).otherwise(-1).alias("max_gap"),
        F.size("long").cast("bigint").alias("n_long_gaps"),
    )
    places = fixes.groupBy(*keys, "latitude", "longitude").agg(F.sum(F.when(in_trip, F.col("n"))).alias("n"))
    positions = places.where(F.col("n") > 0).groupBy(*keys).agg(F.count("*").alias("n_positions"))
    both = stats.unionByName(positions, allowMissingColumns=True)
    numbers = [F.max(c).alias(c) for c in stats.columns if c not in keys]
    return both.groupBy(*keys).agg(*numbers, F.coalesce(F.max("n_positions"), F.lit(0).cast("bigint")).alias("n_positions"))


def _ratio() -> Column:
    """Recorded over predicted distance; NULL if the prediction is 0 or unknown."""
    return F.try_divide(F.col("system_distance").cast("double"), F.col("predict_distance") / 1000)


def _duration() -> Column:
    return F.col("end_time") - F.col("start_time")


def rule_lost_middle_ok_ends(max_long_gaps: int = 2) -> Column:
    """Dense fixes at both ends, one dominating gap in between.

    Deviation from the source system, whose last condition can never hold: it
    is taken as "fewer than ``max_long_gaps`` distinct long gaps".
    """
    share = F.try_divide(F.col("max_gap"), _duration())
    return (
        (F.col("avg_before") < 15)
        & (F.col("avg_after") < 15)
        & (share > 0.5)
        & (_duration() > 300)
        & (F.col("n_long_gaps") < max_long_gaps)
    )


def rule_forgot_start() -> Column:
    """Good track, started late, recorded distance too short."""
    waited = F.col("start_time") - F.col("arrival_time")
    return (waited > 600) & (_ratio() < 0.8) & (F.col("avg_in") <= 10)


def rule_lost_enroute() -> Column:
    """Recorded distance too short although the car moved."""
    return _ratio().between(0.2, 0.8) & (F.col("n_positions") > 2)


def rule_driver_dispute() -> Column:
    """Track and distance fit, yet the driver had the bill changed."""
    return _ratio().between(0.8, 1.1) & (F.col("avg_in") <= 10)


def classify_trips(
    trips: DataFrame,
    points: DataFrame,
    keys: Sequence[str] = (ID,),
    max_long_gaps: int = 2,
    day_col: str | None = None,
    index: DataFrame | None = None,
    whole: bool = False,
) -> DataFrame:
    """``susp_type`` per trip: the first rule that holds, in fixed order.

    A rule whose inputs are unknown does not hold. Every trip has a label,
    also one with a broken time. With ``whole`` the trips keep all columns.
    """
    stats = track_stats(trips, points, keys, day_col=day_col, index=index)
    stats = stats.withColumn("_has", F.lit(True))
    label = (
        F.when(F.col("_has").isNull(), NO_TRACK)
        .when(rule_lost_middle_ok_ends(max_long_gaps), LOST_MIDDLE_OK_ENDS)
        .when(rule_forgot_start(), FORGOT_START)
        .when(rule_lost_enroute(), LOST_EN_ROUTE)
        .when(rule_driver_dispute(), DRIVER_DISPUTE)
        .otherwise(UNKNOWN)
    )
    kept = trips.columns if whole else keys
    return trips.join(stats, list(keys), "left").select(*kept, label.alias("susp_type"))
