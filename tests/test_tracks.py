"""Track numbers and rules, against a plain Python model of their meaning."""

import random

import pytest
from pyspark.sql import functions as F

from tripaudit.operators import tracks

TRIP = "service_order_id long, arrival_time long, start_time long, end_time long, system_distance double, predict_distance long"
POINT = "service_order_id long, t long, latitude double, longitude double"


def mean(ts):
    return (max(ts) - min(ts)) // len(ts) if ts else 0


def model(trip, points):
    _, _, start, end, _, _ = trip
    near = [p for p in points if p[0] == trip[0] and start - 300 <= p[1] <= end + 300]
    if not near:
        return None
    inside = sorted(p[1] for p in near if start <= p[1] <= end)
    gaps = [b - a for a, b in zip(inside, inside[1:])]
    bounds = (-1, -1) if not inside else (min(gaps), max(gaps)) if gaps else (None, None)
    return {
        "avg_before": mean([p[1] for p in near if p[1] <= start]),
        "avg_in": mean(inside),
        "avg_after": mean([p[1] for p in near if p[1] >= end]),
        "min_gap": bounds[0],
        "max_gap": bounds[1],
        "n_long_gaps": len({g for g in gaps if g > 300}),
        "n_positions": len({p[2:] for p in near if start <= p[1] <= end}),
    }


def random_tracks(seed, trips=40):
    rng = random.Random(seed)
    trip_rows, point_rows = [], []
    for i in range(trips):
        start = 1490000000 + rng.randrange(0, 90000)
        end = start + rng.choice([0, 60, 1800, 7200, 20000])
        trip_rows.append((i, start - rng.randrange(0, 1200), start, end, rng.random() * 5, rng.randrange(0, 5000)))
        for _ in range(rng.choice([0, 1, 2, 30, 200])):
            t = rng.randrange(start - 700, end + 701)
            fix = (i, t, rng.randrange(3) / 10, rng.randrange(3) / 10)
            point_rows += [fix] * rng.choice([1, 1, 1, 4])
    # One track holds a third of all fixes, most of them copies of one another.
    hot = trip_rows[0]
    point_rows += [(0, hot[2], 1.0, 1.0)] * (len(point_rows) // 2)
    return trip_rows, point_rows


@pytest.fixture(params=[1, 2], scope="module")
def sample(request, spark):
    trips, points = random_tracks(request.param)
    return trips, points, spark.createDataFrame(trips, TRIP), spark.createDataFrame(points, POINT)


def test_track_stats_match_model(sample):
    trips, points, trip_df, point_df = sample
    stats = tracks.track_stats(trip_df, point_df)
    got = {r["service_order_id"]: r.asDict() for r in stats.collect()}
    for trip in trips:
        want = model(trip, points)
        row = got.pop(trip[0], None)
        assert (row is None) == (want is None)
        if want:
            assert {k: row[k] for k in want} == want
    assert not got


def test_broken_times_end_no_job_and_lose_no_fix(sample, spark):
    """An end in milliseconds, one of 0 and an unknown one beside sound trips: the first keeps its fixes, all have a label."""
    trips, points, trip_df, point_df = sample
    sound = {r[0]: r[1] for r in tracks.classify_trips(trip_df, point_df).collect()}
    first = trips[0]
    broken = [(9001 + k, *first[1:3], end, *first[4:]) for k, end in enumerate((first[3] * 1000, 0, None))]
    both = trip_df.unionAll(spark.createDataFrame(broken, trip_df.schema))
    far = [(9001, first[2] + 40 * 86400 * k, 1.0, 1.0) for k in range(5)]
    fixes = point_df.unionAll(spark.createDataFrame([*far, (9002, first[2], 1.0, 1.0), (9003, first[2], 1.0, 1.0)], point_df.schema))
    got = {r[0]: r[1] for r in tracks.classify_trips(both, fixes).collect()}
    assert got.pop(9001) != tracks.NO_TRACK and got == sound | {i: tracks.NO_TRACK for i in (9002, 9003)}
    stats = {r["service_order_id"]: r for r in tracks.track_stats(both, fixes).collect()}
    assert set(stats) == {r["service_order_id"] for r in tracks.track_stats(trip_df, point_df).collect()} | {9001}
    assert (stats[9001]["max_gap"], stats[9001]["n_long_gaps"]) == (40 * 86400, 1)
    assert sorted(r["t"] for r in tracks.trip_points(both, fixes).where("service_order_id = 9001").collect()) == [f[1] for f in far]


def test_fix_with_a_broken_time_costs_no_slices(sample, spark):
    """A fix in milliseconds: the slices between it and the rest hold no fixes and are not there."""
    trips, points, trip_df, point_df = sample
    odd = point_df.unionAll(spark.createDataFrame([(trips[0][0], trips[0][2] * 1000, 1.0, 1.0), (trips[0][0], None, 1.0, 1.0)], point_df.schema))
    index = tracks.slice_index(odd)
    n_slices = len({(p[0], p[1] // 3600) for p in points}) + 1
    assert index.count() == n_slices and index.agg(F.sum("fixes")).first()[0] == len(points) + 1
    long_trip = spark.createDataFrame([(*trips[0][:3], trips[0][3] * 2000, *trips[0][4:])], trip_df.schema)
    want = sorted([p[1] for p in points if p[0] == trips[0][0] and p[1] >= trips[0][2] - 300] + [trips[0][2] * 1000])
    assert sorted(r["t"] for r in tracks.trip_points(long_trip, odd).collect()) == want
    assert sorted(r["t"] for r in tracks.trip_points(long_trip, odd, index=index).collect()) == want


def test_trip_points_and_day_pruning_agree(sample):
    trips, points, trip_df, point_df = sample
    want = sum(1 for p in points for t in trips if p[0] == t[0] and t[2] - 300 <= p[1] <= t[3] + 300)
    assert tracks.trip_points(trip_df, point_df).count() == want
    daily = point_df.withColumn("day", tracks.epoch_day(F.col("t")))
    got = tracks.trip_points(trip_df, daily, day_col="day")
    assert got.count() == want
    assert "day" not in got.columns and "slice" not in got.columns
    index = tracks.slice_index(daily, "day")
    assert index.columns == ["service_order_id", "slice", "day", "fixes"]
    assert tracks.trip_points(trip_df, daily, day_col="day", index=index).count() == want


def test_gap_operators_match_model(sample):
    trips, points, trip_df, point_df = sample
    bounds = {r[0]: (r[1], r[2]) for r in tracks.gap_bounds(trip_df, point_df).collect()}
    longs = {r[0]: r[1] for r in tracks.long_gaps(trip_df, point_df, 100).collect()}
    runs = tracks.with_gap(point_df).collect()
    for trip in trips:
        ts = sorted(p[1] for p in points if p[0] == trip[0])
        gaps = [b - a for a, b in zip(ts, ts[1:])]
        want = (-1, -1) if not ts else (min(gaps), max(gaps)) if gaps else (None, None)
        assert bounds[trip[0]] == want
        assert longs[trip[0]] == sorted({g for g in gaps if g > 100}, reverse=True)
        own = sorted((r["t"], r["gap"]) for r in runs if r["service_order_id"] == trip[0])
        assert own == sorted((a, b - a) for a, b in zip(ts, ts[1:]))
        assert runs and "latitude" in runs[0]


def test_long_gaps_without_threshold(spark):
    trips = spark.createDataFrame([(1,)], "service_order_id long")
    points = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 5000, 0.0, 0.0)], POINT)
    assert tracks.long_gaps(trips, points, 0).first()["long_gaps"] == []
    assert tracks.long_gaps(trips, points, 10).first()["long_gaps"] == [5000]


def classify(spark, trip, points):
    rows = [(1, t, float(i % 7), 2.0) for i, t in enumerate(points)]
    trip_df = spark.createDataFrame([(1, *trip)], TRIP)
    return tracks.classify_trips(trip_df, spark.createDataFrame(rows, POINT)).first()["susp_type"]


DENSE = list(range(700, 2301, 5))  # around a trip from 1000 to 2000
SPARSE = list(range(700, 2301, 50))
LOST = [*range(700, 1101, 5), *range(1900, 2301, 5)]


@pytest.mark.parametrize(
    "trip, points, label",
    [
        ((1000, 1000, 2000, 1.0, 1000), [], tracks.NO_TRACK),
        ((1000, 1000, 2000, 1.0, 1000), [100, 5000], tracks.NO_TRACK),
        ((1000, 1000, 2000, 1.0, 1000), LOST, tracks.LOST_MIDDLE_OK_ENDS),
        ((399, 1000, 2000, 0.79, 1000), DENSE, tracks.FORGOT_START),
        ((400, 1000, 2000, 0.79, 1000), DENSE, tracks.LOST_EN_ROUTE),
        ((1000, 1000, 2000, 0.2, 1000), DENSE, tracks.LOST_EN_ROUTE),
        ((1000, 1000, 2000, 0.8, 1000), DENSE, tracks.LOST_EN_ROUTE),
        ((1000, 1000, 2000, 0.81, 1000), DENSE, tracks.DRIVER_DISPUTE),
        ((1000, 1000, 2000, 1.1, 1000), DENSE, tracks.DRIVER_DISPUTE),
        ((1000, 1000, 2000, 1.11, 1000), DENSE, tracks.UNKNOWN),
        ((1000, 1000, 2000, 1.0, 1000), SPARSE, tracks.UNKNOWN),
        ((1000, 1000, 2000, 1.0, 0), DENSE, tracks.UNKNOWN),
        ((1000, 1000, 2000, 1.0, None), DENSE, tracks.UNKNOWN),
        # No fix during the trip: its mean interval is 0 and passes "<= 10".
        ((1000, 1000, 2000, 1.0, 1000), [800, 2200], tracks.DRIVER_DISPUTE),
        # One fix has no gap, so the first rule cannot hold.
        ((1000, 1000, 2000, 1.2, 1000), [1500], tracks.UNKNOWN),
        # 300 s are not enough for the first rule, and neither is a duration of 0.
        ((1000, 1000, 1300, 1.2, 1000), [*range(700, 1001, 5), *range(1300, 1601, 5)], tracks.UNKNOWN),
        ((1000, 1000, 1000, 1.2, 1000), [*range(700, 1301, 5)], tracks.UNKNOWN),
        # A trip that ends before it starts has no window.
        ((1000, 5000, 1000, 1.0, 1000), DENSE, tracks.NO_TRACK),
    ],
)
def test_rules(spark, trip, points, label):
    assert classify(spark, trip, points) == label


def test_two_long_gaps_need_a_higher_limit(spark):
    fixes = [*range(700, 1001, 5), 1350, *range(2000, 2301, 5)]
    trips = spark.createDataFrame([(1, 1000, 1000, 2000, 1.2, 1000)], TRIP)
    points = spark.createDataFrame([(1, t, 1.0, 2.0) for t in fixes], POINT)
    assert tracks.classify_trips(trips, points).first()[1] == tracks.UNKNOWN
    assert tracks.classify_trips(trips, points, max_long_gaps=3).first()[1] == tracks.LOST_MIDDLE_OK_ENDS


def test_mean_is_cut_and_divides_by_fixes(spark):
    points = spark.createDataFrame([(1, t, 0.0, 0.0) for t in (0, 10, 32)], POINT)
    assert tracks.avg_interval(points).first()["avg_interval"] == 10


def test_trips_of_few_and_many_slices(spark):
    """Trips around the number of slices from which on the index is asked, one of them without fixes."""
    hours = (0, 1, tracks.FEW - 2, tracks.FEW - 1, tracks.FEW, tracks.FEW + 1, 500)
    trips = [(k, 1490000000, 1490000100, 1490000100 + h * 3600, 1.0, 1000) for k, h in enumerate(hours)]
    points = [(k, 1490000100 + s, s % 7 / 10, 1.0) for k, h in enumerate(hours[:-1]) for s in range(-400, h * 3600 + 400, 1700)]
    stats = tracks.track_stats(spark.createDataFrame(trips, TRIP), spark.createDataFrame(points, POINT))
    got = {r["service_order_id"]: r.asDict() for r in stats.collect()}
    for trip in trips:
        want = model(trip, points)
        assert (trip[0] in got) == (want is not None)
        assert want is None or {k: got[trip[0]][k] for k in want} == want
