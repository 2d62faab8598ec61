"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry_module
from tripaudit.catalog import inputs as I
from tripaudit.catalog.queries import REGISTRY
from tripaudit.operators import rows

SF = "/root/testdata/sf0.001"
WRITES = {
    "risk_list", "tsv_roundtrip", "partition_overwrite", "expire_partitions", "partition_ready", "backfill_range",
    "read_days", "upsert_by_date", "replace_dim", "report_bundle", "rerun_empty_day", "load_day", "swap_day", "day_complete",
    "expire_files", "added_column", "backfill_resumed", "checked_extract", "checked_logs", "checked_tracks", "driver_state", "driver_stats_state", "ext_snapshot",
}
LAZY = sorted(set(REGISTRY) - WRITES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(no_broadcast, name):
    plan = plan_of(entry_module.queries()[name](no_broadcast, SF))
    for operator in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_latest_row_is_limited_before_the_exchange(no_broadcast):
    plan = plan_of(rows.latest_per_key(I.fx_order(no_broadcast, SF), order=I.ORDER))
    window, exchange, partial = plan.index("Window "), plan.index("Exchange"), plan.rindex("WindowGroupLimit")
    assert window < exchange < partial and plan.count("WindowGroupLimit") == 2


def test_summary_semi_join_is_co_located(no_broadcast):
    """Orders and versions each move once; the semi join adds no exchange."""
    plan = plan_of(entry_module.queries()["summary_base"](no_broadcast, SF))
    semi = plan[plan.index("LeftSemi") :]
    assert semi.index("Window ") < semi.index("Exchange")
    assert plan[: plan.index("LeftSemi")].count("Exchange") == 0


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(entry_module.queries()["version_stats"](spark, SF))
    for column in ("l_returnflag", "l_quantity", "o_totalprice", "o_orderdate"):
        assert column not in plan


@pytest.mark.parametrize("name", ["track_stats", "daily_summary_rc", "susp_detail", "op_suspects", "risk_flag"])
def test_same_rows_without_broadcast(spark, name):
    query = entry_module.queries()[name]
    usual = sorted(map(str, query(spark, SF).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, query(spark, SF).collect())) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_track_is_split(spark):
    """A third of all fixes on one order: AQE splits the join, results stay whole."""
    from tripaudit.operators import tracks

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    trips = spark.range(500).selectExpr(
        "id as service_order_id", "1000000 + id % 3 as start_time", "1003000 + id % 3 as end_time"
    )
    hot, copy = "id % 3 = 0", "id % 6 = 0"
    points = spark.range(0, 900000, 1, 16).selectExpr(
        f"if({hot}, 7, id % 500) as service_order_id",
        f"if({copy}, 1001000, 1000810 + abs(xxhash64(id)) % 2100) as t",
        f"if({copy}, 1D, abs(xxhash64(id, 1)) % 1000 / 10D) as latitude",
        "2D as longitude",
    )
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        stats = tracks.track_stats(trips, points)
        found = {r["service_order_id"]: r for r in stats.collect()}
        assert "skew=true" in plan_of(stats)
    finally:
        for key in small:
            spark.conf.unset(key)
    assert len(found) == 500 and found[7]["min_gap"] == 0


def test_points_are_read_once(no_broadcast):
    """Both uses of the fixes share one exchange."""
    from tripaudit.operators import tracks

    stats = tracks.track_stats(I.fx_trip(no_broadcast, SF), I.fx_point(no_broadcast, SF))
    stats.collect()
    final = plan_of(stats).split("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line and "value#" in line]
    assert len(scans) == 1 and "ReusedExchange" in final


@pytest.mark.parametrize("name", ["risk_semi", "risk_flag", "join_latest_ext", "valid_trips"])
def test_salted_joins_read_only_what_they_use(no_broadcast, name):
    """The salt comes from the key and narrow columns, not from whole rows."""
    plan = plan_of(REGISTRY[name](no_broadcast, SF))
    for column in ("l_tax", "l_discount", "l_comment", "l_shipmode"):
        assert column not in plan
    assert "SPARK_PARTITION_ID" not in plan


def test_summary_has_one_window_chain(no_broadcast):
    """The kinds of suspects are counted in one aggregate over one pass."""
    plan = plan_of(REGISTRY["susp_summary"](no_broadcast, SF))
    assert plan.count("FileScan parquet") == plan_of(REGISTRY["op_suspects"](no_broadcast, SF)).count("FileScan parquet")
    assert "Union" not in plan


def test_extension_days_are_filtered_at_the_scan(spark, tmp_path):
    from tripaudit.operators import bases
    from tripaudit.sources.writers import overwrite_partition

    path = str(tmp_path / "ext")
    overwrite_partition(I.fx_ext(spark, SF), path)
    plan = plan_of(bases.day_base(I.fx_order(spark, SF), spark.read.parquet(path), I.LAST_DAY))
    assert "PartitionFilters: [isnotnull(dt" in plan and str(I.LAST_DAY) in plan


def test_salted_list_is_not_broadcast(spark):
    """F6, F8: a list repeated over the salts became a relation eight times as large as Spark took it for."""
    from tripaudit.operators import joins

    orders = spark.range(1000).selectExpr("id % 10 as service_order_id", "id as update_time")
    found = joins.flag_members(orders, spark.range(5).withColumnRenamed("id", "service_order_id"))
    assert found.where("is_rc").count() == 500
    assert "BroadcastHashJoin" not in plan_of(found)


def test_trips_and_points_are_joined_once(no_broadcast):
    """F3-F5: gaps and positions share one exchange of the joined fixes, also below a condition on a key; short trips need no index."""
    from tripaudit.operators import tracks

    trips = I.fx_trip(no_broadcast, SF).selectExpr("*", "if(service_order_id % 2 = 0, 'a', 'b') as category")
    found = tracks.classify_trips(trips, I.fx_point(no_broadcast, SF), [rows.ID, "category"], whole=True).where("category = 'a'")
    assert found.collect()
    final = plan_of(found).split("== Initial Plan ==")[0]
    joins_ = [line for line in final.splitlines() if "Join [service_order_id" in line and "slice#" in line]
    scans = [line for line in final.splitlines() if "FileScan" in line and "ts#" in line]
    assert len(joins_) == 1 and len(scans) == 1


def test_sieve_keeps_all_listed_keys(no_broadcast):
    from tripaudit.operators import joins

    rows_, ids = no_broadcast.range(100000).withColumnRenamed("id", rows.ID), no_broadcast.range(0, 100000, 100).withColumnRenamed("id", rows.ID)
    kept = joins.sieve(rows_, ids)
    assert 1000 == kept.join(ids, rows.ID).count() <= kept.count() < 2000
    assert joins.sieve(rows_, ids.limit(0)).count() == 0
    assert joins.sieve(rows_, ids.selectExpr("cast(service_order_id as string) as service_order_id")).count() == 100000
