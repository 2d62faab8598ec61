"""States that are moved on day by day against the same computed from everything."""

import random

import pytest
from pyspark.sql import functions as F

from tripaudit.catalog import inputs as I
from tripaudit.catalog import queries as Q
from tripaudit.operators import joins, rolling, stats
from tripaudit.plans import zero_report
from tripaudit.sources import states
from tripaudit.sources.files import Files

SF = "/root/testdata/sf0.001"
HIST = "dt int, driver_id long, zero_cnt long, total_cnt long"


def steps_below_the_join(df):
    """Operators between the bucketed scan and the join it feeds."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above, out = depth[at], []
    for i in range(at - 1, -1, -1):
        if depth[i] < above:
            above = depth[i]
            if "Join" in lines[i]:
                return out
            out.append(lines[i])
    raise AssertionError("no join")


@pytest.fixture
def state(spark, tmp_path):
    name = "state_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return states.KeyedState(spark, f"{name}.drivers", "driver_id", str(tmp_path / "states"), 16)


def totals(df):
    return {r["driver_id"]: (r["zero_days"], r["total_cnt"]) for r in df.collect()}


def whole(days):
    out = {}
    for rows in days.values():
        for _, driver, zero, total in rows:
            if driver is None:
                continue
            z, t = out.get(driver, (0, 0))
            out[driver] = (z + (zero > 0), t + total)
    return {d: v for d, v in out.items() if v != (0, 0)}


def test_thirty_days_with_reruns(spark, state):
    rng = random.Random(3)
    days = {}
    order = [20170301 + i for i in range(12)]
    order[5:5] = [20170303]  # a correction of an older day
    order += [20170312, 20170312]  # the last day twice more
    for n, day in enumerate(order):
        drivers = rng.sample(range(30), rng.randint(0, 20)) if n != 7 else []
        days[day] = [(day, d if d else None, rng.randint(0, 2), rng.randint(1, 9)) for d in drivers]
        states.advance_drivers(state, spark.createDataFrame(days[day], HIST), day)
        assert totals(state.read()) == whole(days), day
    for day in (20170301, 20170305, 20170313):
        assert totals(states.drivers_before(state, day)) == whole({d: r for d, r in days.items() if d < day})
    files = Files(spark, state.folder)
    assert len(files.match(f"{state.folder}/state-*")) == 1 and len(files.match(f"{state.folder}/day-*")) == len(days)
    assert state.note()["days"].keys() == {str(d) for d in days}


def test_repeated_history_rows_of_a_day_are_one_zero_day(spark):
    rows = spark.createDataFrame([(1, 5, 1, 2), (1, 5, 3, 4), (2, 5, 0, 1)], HIST)
    assert totals(rolling.driver_deltas(rows)) == {5: (1, 7)}


def test_state_side_has_no_exchange_and_history_is_not_read(spark, state):
    hist = spark.createDataFrame([(20170301, d, d % 2, 3) for d in range(50)], HIST)
    states.advance_drivers(state, hist, 20170301)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = I.fx_valid(spark, SF).where(F.col("dt") == I.LAST_DAY)
        for df in (
            rolling.move_totals(state.read(), rolling.driver_deltas(hist), None),
            rolling.driver_stats_from(base, states.drivers_before(state, I.LAST_DAY)),
        ):
            assert not any("Exchange" in step for step in steps_below_the_join(df))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_driver_stats_from_the_state_equal_those_from_history(spark, state):
    hist = I.fx_driver_hist(spark, SF).persist()
    today = I.fx_valid(spark, SF).where(F.col("dt") == I.LAST_DAY)
    for day in I.DAYS[:-1]:
        states.advance_drivers(state, hist.where(F.col("dt") == day), day)
    for day in (I.LAST_DAY, I.LAST_DAY - 2):
        want = sorted(map(tuple, stats.driver_stats(today, hist, day).collect()))
        got = rolling.driver_stats_from(today, states.drivers_before(state, day))
        assert sorted(map(tuple, got.collect())) == want and want
    hist.unpersist()


def test_lost_writer_leaves_the_old_state(spark, state, monkeypatch):
    first = spark.createDataFrame([(20170301, 1, 1, 3)], HIST)
    states.advance_drivers(state, first, 20170301)
    with monkeypatch.context() as patch:
        patch.setattr(Files, "write_text", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            states.advance_drivers(state, spark.createDataFrame([(20170302, 1, 1, 5)], HIST), 20170302)
    assert totals(state.read()) == {1: (1, 3)} and list(state.note()["days"]) == ["20170301"]
    states.advance_drivers(state, spark.createDataFrame([(20170302, 1, 1, 5)], HIST), 20170302)
    assert totals(state.read()) == {1: (2, 8)}


def test_zero_report_keeps_the_state(spark, state, tmp_path):
    """Two days saved with a state and with the history table give the same sheets, reruns too."""
    plain = Q.zero_inputs(spark, SF)
    nothing = plain.driver_hist.limit(0)
    kept = zero_report.ZeroInputs(**{**plain.__dict__, "driver_hist": nothing, "driver_state": state})
    hist = str(tmp_path / "hist")
    for day in (I.LAST_DAY - 1, I.LAST_DAY - 1, I.LAST_DAY, I.LAST_DAY - 1):
        a = zero_report.save_zero_report(kept, day, str(tmp_path / "a"))
        source = spark.read.parquet(hist) if Files(spark, hist).exists(hist) else nothing
        told = zero_report.ZeroInputs(**{**plain.__dict__, "driver_hist": source})
        b = zero_report.save_zero_report(told, day, str(tmp_path / "b"), hist)
        rows = [sorted(map(str, spark.read.parquet(x["zero_driver"]).collect())) for x in (a, b)]
        assert rows[0] == rows[1] and rows[0]


def test_snapshot_of_newest_extension_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE state_ext LOCATION '{tmp_path}/db'")
    snapshot = states.KeyedState(spark, "state_ext.newest", "service_order_id", str(tmp_path / "states"), 16)
    ext = I.fx_ext(spark, SF).persist()
    days = sorted(r[0] for r in ext.select("dt").distinct().collect())
    for day in [*days[:4], days[2], *days[4:], days[-1]]:
        states.advance_latest_ext(snapshot, ext.where(F.col("dt") == day), day)
    got = snapshot.read().select(*joins.EXT_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, joins.latest_ext(ext).collect()))
    assert snapshot.note()["days"] == days
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = joins.latest_ext_rows(ext)
        merged = rolling.merge_latest(snapshot.read(), new, "service_order_id", ["update_time"])
        assert not any("Exchange" in step for step in steps_below_the_join(merged))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ext.unpersist()


def test_merge_latest_ties_nulls_and_new_keys(spark):
    schema = "service_order_id long, update_time long, v string"
    old = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c"), (4, 7, "d")], schema)
    new = spark.createDataFrame([(1, 5, "x"), (2, 6, "y"), (3, 1, "z"), (5, None, "n"), (4, None, "m")], schema)
    got = {r[0]: r[2] for r in rolling.merge_latest(old, new, "service_order_id", ["update_time"]).collect()}
    assert got == {1: "a", 2: "y", 3: "z", 4: "d", 5: "n"}
