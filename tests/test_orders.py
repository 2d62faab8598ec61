"""Bases, suspects, joins, statistics and history on hand-made orders."""

import random

import pytest
from pyspark.sql import functions as F

from tripaudit.catalog import inputs as I
from tripaudit.operators import bases, filters, history, joins, rows, stats, suspects
from tripaudit.plans.zero_report import EmptyReport, require_rows

DAY = 20170329
T0 = 1490716800  # 2017-03-29 00:00 Asia/Shanghai

DEFAULTS = {
    "service_order_id": 1, "city": "bj", "status": 7, "passenger_name": "p", "driver_id": 9,
    "arrival_time": T0 + 10, "start_time": T0 + 60, "end_time": T0 + 600, "start_longitude": 116.0,
    "start_latitude": 39.9, "expect_start_longitude": 116.0, "expect_start_latitude": 39.9,
    "expect_end_longitude": 116.0, "actual_time_length": 10, "dependable_distance": 0,
    "system_distance": 0, "update_time": 100, "dt": DAY,
}
ORDER_TYPES = (
    "service_order_id long, city string, status int, passenger_name string, driver_id long, arrival_time long, "
    "start_time long, end_time long, start_longitude double, start_latitude double, "
    "expect_start_longitude double, expect_start_latitude double, expect_end_longitude double, "
    "actual_time_length int, dependable_distance int, system_distance int, update_time long, dt int"
)
EXT_TYPES = "service_order_id long, driver_version string, runtime int, estimate_snap string, update_time long, dt int"


def orders_of(spark, *changes):
    return spark.createDataFrame([tuple({**DEFAULTS, **c}.values()) for c in changes], ORDER_TYPES)


def ext_of(spark, *rows_):
    full = [(i, v, r, '{"distance":"3000"}', u, DAY) for i, v, r, u in rows_]
    return spark.createDataFrame(full, EXT_TYPES)


def test_valid_trips_drops_nulls_and_testers(spark):
    orders = orders_of(
        spark,
        {"service_order_id": 1},
        {"service_order_id": 2, "passenger_name": None},
        {"service_order_id": 3, "passenger_name": "x测试y"},
        {"service_order_id": 4, "status": 8},
        {"service_order_id": 5},
        {"service_order_id": 6},
    )
    ext = ext_of(spark, *[(i, "5_1", 10, 1) for i in (1, 2, 3, 4)], (5, "", 10, 1))
    kept = filters.valid_trips(joins.attach_versions(orders, ext))
    assert [r[0] for r in kept.select("service_order_id").collect()] == [1]


def test_day_base_counts_each_version_and_can_dedupe(spark):
    orders = orders_of(spark, {}, {"update_time": 200})
    ext = ext_of(spark, (1, "5_1", 10, 1), (1, "5_1", 10, 2), (1, "6_1", 10, 3))
    assert bases.day_base(orders, ext, DAY).count() == 4
    assert bases.day_base(orders, ext, DAY, dedupe=True).count() == 1


def test_summary_base_takes_newest_matching_version(spark):
    orders = orders_of(
        spark,
        {"system_distance": 500, "update_time": 100},
        {"system_distance": 900, "update_time": 200, "status": 8},
        {"service_order_id": 2, "system_distance": 1, "update_time": 300},
    )
    ext = ext_of(spark, (1, "5_1", 10, 1), (1, "5_2", 10, 2), (2, "", 10, 1))
    got = bases.summary_base(orders, ext, [DAY - 1, DAY]).collect()
    assert [(r["service_order_id"], r["system_distance"], r["dt"]) for r in got] == [(1, 500, DAY)]


def test_summary_is_dated_by_start_not_by_partition(spark):
    orders = orders_of(spark, {"dt": DAY, "start_time": T0 - 1}, {"service_order_id": 2, "start_time": T0})
    ext = ext_of(spark, (1, "5_1", 10, 1), (2, "5_1", 10, 1))
    got = {r["dt"]: r["total"] for r in stats.daily_summary(bases.summary_base(orders, ext, [DAY - 1, DAY])).collect()}
    assert got == {DAY - 1: 1, DAY: 1}


def test_daily_summary_without_and_with_risk(spark):
    base = spark.createDataFrame(
        [(DAY, 1, 0, 0, True), (DAY, 2, 0, 5, False), (DAY, 3, 0, 0, False), (DAY, 4, 7, 0, False), (DAY - 1, 5, 1, 1, True)],
        "dt int, service_order_id long, system_distance int, dependable_distance int, is_rc boolean",
    )
    plain = {r["dt"]: r for r in stats.daily_summary(base).collect()}
    assert plain[DAY].asDict() == {
        "dt": DAY, "total": 4, "sys_zero": 3, "no_rc_zero": 0, "adjust_zero": 2, "ext_zero": 1,
        "sys_zero_rate": 750.0, "no_rc_rate": 0.0, "adjust_zero_rate": 500.0, "ext_zero_rate": 250.0,
    }
    assert plain[DAY - 1]["sys_zero"] == 0
    risk = {r["dt"]: r for r in stats.daily_summary(base, use_rc=True).collect()}
    assert [risk[DAY][c] for c in ("sys_zero", "no_rc_zero", "adjust_zero", "ext_zero")] == [3, 2, 1, 1]
    for r in plain.values():
        assert r["sys_zero"] == r["adjust_zero"] + r["ext_zero"]


def test_driver_stats_first_day_and_rerun(spark):
    base = spark.createDataFrame(
        [(1, 7, 0, 0), (2, 7, 5, 0), (3, 8, 0, 0), (4, 9, 3, 3)],
        "service_order_id long, driver_id long, system_distance int, dependable_distance int",
    )
    hist = spark.createDataFrame(
        [(DAY - 2, 7, 1, 5), (DAY - 1, 7, 2, 4), (DAY, 7, 9, 99), (DAY - 1, 9, 1, 1)],
        "dt int, driver_id long, zero_cnt long, total_cnt long",
    )
    got = {r["driver_id"]: tuple(r)[1:] for r in stats.driver_stats(base, hist, DAY).collect()}
    assert got == {7: (1, 2, 2, 11), 8: (1, 1, 0, 1)}
    once = history.driver_hist_append(hist, base, DAY)
    twice = history.driver_hist_append(once, base, DAY)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(tuple(r) for r in once.where(F.col("dt") == DAY).collect()) == [(DAY, 7, 1, 2), (DAY, 8, 1, 1)]


def test_histograms_keep_empty_bins_and_drop_zero(spark):
    zero = orders_of(
        spark,
        {},
        {"expect_start_latitude": 39.91},
        {"end_time": T0 + 60},
        {"end_time": T0 + 61},
        {"end_time": T0 + 60 + 1200},
        {"start_time": T0 + 60, "end_time": T0 + 90000},
    )
    distance = stats.distance_hist(zero).collect()
    assert len(distance) == 15 and sum(r["cnt"] for r in distance) == 1
    assert [r["start_pos_diff"] for r in distance if r["cnt"]] == ["1.5"]
    duration = {r["duration"]: r["cnt"] for r in stats.duration_hist(zero).collect()}
    assert len(duration) == 21
    assert {k: v for k, v in duration.items() if v} == {"9": 2, "1": 1, "20": 1, "20+": 1}
    hours = stats.hour_hist(zero).collect()
    assert [r["hour"] for r in hours] == list(range(24)) and sum(r["cnt"] for r in hours) == 6


def test_city_stats_falls_back_to_code_and_merges_labels(spark):
    zero = spark.createDataFrame([("bj",), ("bj",), ("pk",), ("zz",)], "city string")
    labels = spark.createDataFrame([("bj", "Peking"), ("pk", "Peking")], "code string, label string")
    assert [tuple(r) for r in stats.city_stats(zero, labels).collect()] == [("Peking", 3), ("zz", 1)]


def test_membership_survives_hot_keys_nulls_and_copies(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 7, if(id % 50 = 1, null, id)) as service_order_id", "id as x")
    ids = spark.createDataFrame([(7,), (7,), (None,), (10,), (11,)], "service_order_id long")
    plain = {r["x"]: r["service_order_id"] for r in df.collect()}
    flagged = joins.flag_members(df, ids, spread=("x",)).collect()
    assert len(flagged) == 3000
    assert all(r["is_rc"] == (plain[r["x"]] in (7, 10, 11)) for r in flagged)
    inside = {r["x"] for r in joins.only_in(df, ids, spread=("x",)).collect()}
    outside = [r["x"] for r in joins.not_in(df, ids, spread=("x",)).collect()]
    assert inside == {x for x, i in plain.items() if i in (7, 10, 11)}
    assert sorted(outside) == sorted(set(plain) - inside)
    assert sorted(map(tuple, joins.flag_members(df, ids, salts=1).collect()), key=str) == sorted(
        map(tuple, flagged), key=str
    )


def random_orders(spark, seed):
    rng = random.Random(seed)
    changes = [
        {
            "service_order_id": 1 if rng.random() < 0.33 else rng.randrange(2, 60),
            "status": rng.choice([7, 7, 7, 8]),
            "passenger_name": rng.choice(["p", "p", "测试", None]),
            "actual_time_length": rng.randrange(0, 4),
            "dependable_distance": rng.randrange(0, 5) * 30,
            "system_distance": rng.randrange(0, 5) * 30,
            "update_time": i // 2,
            "city": str(i),
        }
        for i in range(600)
    ]
    ext = [(i, rng.choice(["5_1", "5_1", ""]), rng.randrange(0, 4), rng.randrange(3)) for i in range(1, 60) for _ in "ab"]
    return orders_of(spark, *changes), ext_of(spark, *ext)


@pytest.mark.parametrize("seed", [3, 4])
def test_suspects_equal_rank_after_join(spark, seed):
    """The reduced plans return what ranking the whole join returns."""
    orders, ext = random_orders(spark, seed)
    order = ("update_time", "city")
    latest = joins.latest_ext(ext, ["driver_version", "runtime"])
    joined = joins.valid_with_latest_ext(orders, latest)
    km = "round({} / 1000, 1)"
    up = f"{km.format('dependable_distance')} > {km.format('system_distance')}"
    differs = f"{km.format('dependable_distance')} <> {km.format('system_distance')}"
    conditions = {
        "distance": f"{up} and runtime = actual_time_length",
        "operation": f"{differs} and runtime <> actual_time_length",
    }
    cols = ["service_order_id", "city", "runtime", "actual_time_length"]
    both = suspects.all_suspects(orders, latest, order)
    single = {
        "distance": suspects.distance_suspects(orders, latest, order),
        "operation": suspects.operation_suspects(orders, latest, order),
    }
    for name, condition in conditions.items():
        want = sorted(map(tuple, rows.latest_per_key(joined.where(condition), order=order).select(*cols).collect()))
        assert want
        assert sorted(map(tuple, single[name].select(*cols).collect())) == want
        assert sorted(map(tuple, both.where(F.col("category") == name).select(*cols).collect())) == want


def test_deviation_with_zero_divisor(spark):
    df = orders_of(spark, {"actual_time_length": 0, "system_distance": 1250}).withColumn("runtime", F.lit(3))
    row = suspects.with_deviation(df).first()
    assert (row["percent_time"], row["time_pct"], row["percent_deviation_distance"]) == (None, None, None)
    assert (row["system_distance"], row["deviation_distance"], row["isDeviationPositive"]) == (1.3, -1.3, 0)


def test_format_detail(spark):
    df = orders_of(spark, {"arrival_time": 0}).withColumns(
        {"device_update": F.lit(None).cast("long"), "pct_for_sort": F.lit(1), "device_type": F.lit("d")}
    )
    row = suspects.format_detail(df).first().asDict()
    assert row["arrival_time"] == "" and row["device_update"] == ""
    assert row["start_time"] == "2017-03-29 00:01:00" and row["date"] == "2017-03-29"
    assert not {"pct_for_sort", "device_type"} & set(row)


def test_align_counts_leaves_missing_categories_null(spark):
    a = spark.createDataFrame([("2017-03-28",), ("2017-03-28",)], "date string")
    b = spark.createDataFrame([("2017-03-29",)], "date string")
    got = suspects.align_counts({"x": a, "y": b, "z": b.limit(0)}).collect()
    assert [tuple(r) for r in got] == [("2017-03-28", 2, None, None), ("2017-03-29", None, 1, None)]


def test_mark_new_is_rerun_safe(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "service_order_id long")
    hist = spark.createDataFrame(
        [("1", DAY - 1, 1), ("2", DAY, 1), ("3", 20170301, 1), ("9", DAY + 1, 1)],
        "service_order_id string, execute_date int, is_new int",
    )
    marked = history.mark_new(df, hist, DAY)
    assert sorted((r["service_order_id"], r["is_new"]) for r in marked.collect()) == [("1", 0), ("2", 1), ("3", 1)]
    once = history.susp_history(marked, hist, DAY)
    assert sorted(map(tuple, once.collect())) == [("1", DAY - 1, 0), ("2", DAY, 1), ("3", DAY, 1)]
    again = history.susp_history(history.mark_new(df, once, DAY), once, DAY)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_risk_upsert_replaces_and_is_rerun_safe(spark):
    kind = "service_order_id long, is_rc string, dt int"
    old = spark.createDataFrame([(1, "T", 1), (2, "T", 1)], kind)
    new = spark.createDataFrame([(2, "T", 2), (3, "F", 2), (4, "T", 2)], kind)
    once = history.risk_upsert(old, new)
    assert sorted(map(tuple, once.collect())) == [(1, "T", 1), (2, "T", 2), (4, "T", 2)]
    assert sorted(map(tuple, history.risk_upsert(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_distance_log_is_deduplicated(spark):
    df = orders_of(spark, {})
    log = spark.createDataFrame(
        [(DAY, "1", 1.0, 2.0, 3.0, 4.0, 1), (DAY, "1", 1.0, 2.0, 3.0, 4.0, 1), (DAY - 1, "1", 9.0, 9.0, 9.0, 9.0, 0)],
        "log_day int, service_order_id string, r_yy_dis double, r_sys_dis double, driver_dis double, "
        "response_dis double, is_enable long",
    )
    for salts in (1, 4):
        got = joins.attach_distance_log(df, log, salts).collect()
        assert [(r["r_sys_dis"], r["is_enable"]) for r in got] == [(2.0, 1)]


def test_attach_device_only_drivers(spark):
    devices = spark.createDataFrame(
        [(9, 1, "DR", 5, "a"), (8, 1, "PA", 5, "b"), (7, 0, "DR", 5, "c")],
        "user_id long, status int, user_type string, update_time long, os_type string",
    ).withColumns({c: F.lit(None).cast("string") for c in joins.DEVICE_COLUMNS if c != "os_type"})
    df = orders_of(spark, {}, {"driver_id": 8}, {"driver_id": 7})
    got = {r["driver_id"]: r["os_type"] for r in joins.attach_device(df, devices).collect()}
    assert got == {"9": "a", "8": None, "7": None}


def test_dedupe_is_order_independent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c")], "service_order_id long, update_time long, v string")
    for frame in (df, df.orderBy(F.desc("v"))):
        assert sorted(r["v"] for r in rows.dedupe(frame).collect()) == ["b", "c"]


def test_require_rows(spark):
    df = spark.range(1)
    assert require_rows("x", df) is df
    with pytest.raises(EmptyReport):
        require_rows("x", df.limit(0))


def test_totals_add_up(spark):
    """Histogram totals equal the rows inside the outer edges."""
    zero = I.fx_zero(spark, "/root/testdata/sf0.001")
    hours = stats.hour_hist(zero).agg(F.sum("cnt")).first()[0]
    assert hours == zero.count()
    minutes = stats.duration_hist(zero).agg(F.sum("cnt")).first()[0]
    assert minutes == zero.where(F.col("end_time") > F.col("start_time")).count()
