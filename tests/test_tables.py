"""Readers, writers and reports on disk."""

import os

import pytest
from pyspark.sql import functions as F

from tripaudit.catalog import inputs as I
from tripaudit.catalog import queries as Q
from tripaudit.plans import susp_report, zero_report
from tripaudit.schemas import schema_from_ddl
from tripaudit.session import scratch_dir
from tripaudit.sources import loads, readers, tables, writers

SF = "/root/testdata/sf0.001"
SCHEMA = """
    service_order_id bigint
    name string
    update_time int
    dt int
"""


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_tsv_values(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('1\t"q"\t5\t20170329\nx\t\\N\t1.5\t20170329\n3\t\n\n', encoding="utf-8")
    got = readers.read_tsv(spark, str(tmp_path / "x.tsv"), schema_from_ddl(SCHEMA)).collect()
    assert [tuple(r) for r in got] == [
        (1, '"q"', 5, 20170329), (None, None, None, 20170329), (3, "", None, None), (None, None, None, None),
    ]


def test_backfill_keeps_own_day_only_and_reruns(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    os.mkdir(folder)
    for day, lines in {
        20170328: ["1\ta\t5\t20170328", "1\ta\t5\t20170328", "2\tb\t5\t20170329"],
        20170329: ["1\ta\t5\t20170329", "3\tc\t6\t20170329"],
    }.items():
        (tmp_path / "in" / f"t_{day}.tsv").write_text("\n".join(lines) + "\n")
    schema = schema_from_ddl(SCHEMA)
    for _ in range(2):
        loads.backfill(spark, folder, "t", 20170328, 20170329, schema, target)
        got = rows_of(spark.read.parquet(target).select("service_order_id", "dt"))
        assert got == [(1, 20170328), (1, 20170329), (3, 20170329)]
    plain = readers.load_extracts(spark, folder, "t", [20170328], schema, keys=None)
    assert plain.count() == 2


def test_table_overwrite_expire_and_ready(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS audit LOCATION '{tmp_path}/db'")
    schema = schema_from_ddl(SCHEMA)
    tables.declare_table(spark, "audit.t", schema)
    tables.declare_table(spark, "audit.t", schema)
    days = spark.createDataFrame([(i, "a", 1, d) for i, d in enumerate((20170225, 20170228, 20170301, 20170329))], schema)
    writers.overwrite_partition(days.select("dt", "name", "update_time", "service_order_id"), "audit.t")
    writers.overwrite_partition(spark.createDataFrame([(9, "z", 1, 20170301)], schema), "audit.t")
    assert rows_of(spark.table("audit.t").select("service_order_id", "dt")) == [
        (0, 20170225), (1, 20170228), (3, 20170329), (9, 20170301),
    ]
    assert tables.partition_ready(spark, "audit.t", 20170329)
    assert not tables.partition_ready(spark, "audit.t", 20170330)
    assert not tables.partition_ready(spark, "audit.missing", 20170330)
    assert tables.expire_partitions(spark, "audit.t", 20170330) == [20170225, 20170228]
    assert tables.expire_partitions(spark, "audit.t", 20170330) == []
    assert rows_of(tables.table_partitions(spark, "audit.t")) == [(20170301,), (20170329,)]
    assert not os.path.exists(tmp_path / "db" / "t" / "dt=20170225")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def parquet_files(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_expired_days_leave_no_files_on_external_tables_and_paths(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS audit2")
    schema = schema_from_ddl(SCHEMA)
    tables.declare_table(spark, "audit2.e", schema, location=f"{tmp_path}/ext")
    rows = spark.createDataFrame([(9, "z", 1, 20170101), (8, "y", 1, 20170329), (7, "x", 1, 20170228)], schema)
    for target, folder in (("audit2.e", tmp_path / "ext"), (str(tmp_path / "path"), tmp_path / "path")):
        writers.overwrite_partition(rows, target)
        assert len(parquet_files(folder)) == 3
        assert tables.expire_partitions(spark, target, 20170330) == [20170101, 20170228]
        assert rows_of(readers.read_table(spark, target).select("service_order_id", "dt")) == [(8, 20170329)]
        left = parquet_files(folder)
        assert len(left) == 1 and "dt=20170329" in left[0]
        assert tables.expire_partitions(spark, target, 20170330) == []


def test_path_partitions_and_pruning(spark, tmp_path):
    target = str(tmp_path / "p")
    df = spark.range(20).selectExpr("id", "cast(20170320 + id % 4 as int) as dt")
    writers.upsert_by_date(df, target)
    fresh = spark.createDataFrame([(99, 20170321)], "id long, dt int")
    for _ in range(2):
        writers.upsert_by_date(fresh, target)
    got = spark.read.parquet(target)
    assert got.count() == 16 and got.where("dt = 20170321").first()["id"] == 99
    some = readers.read_days(spark, target, [20170320, 20170322])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan or "PartitionFilters: [dt" in plan
    assert some.count() == 10
    assert tables.partition_ready(spark, target, 20170322)
    assert not tables.partition_ready(spark, target, 20170330)


def test_side_table_filter_is_pushed(spark):
    df = readers.read_side(spark, f"{SF}/orders.parquet", F.col("o_orderstatus") == "F")
    assert "EqualTo(o_orderstatus,F)" in df._jdf.queryExecution().executedPlan().toString()
    same = readers.read_side(spark, "", "o_orderstatus = 'F'", format="parquet", path=f"{SF}/orders.parquet")
    assert same.count() == df.count() > 0


def test_parse_distance_log_lines(spark):
    lines = spark.createDataFrame(
        [
            ("OK",),
            ("\tstarts with a tab",),
            ("a\tb\t17\tc\t1.5\td\tNULL\te\t\t4\tf\tg\th\t1",),
            ("a\tb\t18\tc\tx",),
        ],
        "value string",
    )
    got = readers.parse_distance_log(lines).collect()
    assert [tuple(r) for r in got] == [("17", 1.5, 0.0, 0.0, 4.0, 1), ("18", 0.0, 0.0, 0.0, 0.0, 0)]


def test_parse_track_replies(spark):
    fix = '{"timestamp":1489939217999,"provider":"gps","accuracy":3.5,"latitude":1.0,"longitude":2.0,"more":1}'
    raw = spark.createDataFrame(
        [(1, f'{{"results":[{fix},{fix}]}}'), (2, '{"results":[]}'), (3, "oops"), (4, None), (5, '{"error":1}')],
        "service_order_id long, body string",
    )
    assert [tuple(r) for r in readers.parse_tracks(raw).collect()] == [(1, 1489939217, "gps", 3.5, 1.0, 2.0)] * 2


def test_replace_table_in_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS audit3")
    for n in (3, 2):
        writers.replace_table(spark.range(n), "audit3.dim", 20170329 - n)
    assert rows_of(readers.read_table(spark, "audit3.dim")) == [(0, 20170327), (1, 20170327)]


def test_scratch_dir_uses_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second and first.startswith(base)


def test_zero_report_saves_and_reruns(spark, tmp_path):
    inputs = Q.zero_inputs(spark, SF)
    folder, hist = str(tmp_path / "report"), str(tmp_path / "hist")
    for _ in range(2):
        paths = zero_report.save_zero_report(inputs, I.LAST_DAY, folder, hist)
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert (counts["zero_pos_diff"], counts["zero_hour_distribute"], counts["zero_order_duration"]) == (15, 24, 21)
    assert counts["zero_summary"] == 10
    drivers = spark.read.parquet(paths["zero_driver"])
    assert drivers.columns == [
        "driver_id", "today_zero_cnt", "today_cnt", "acc_zero_days", "total_cnt", "dt",
    ]
    assert spark.read.parquet(hist).count() == drivers.count()
    assert spark.read.parquet(paths["zero_summary"]).columns == [
        "total", "zero_cnt", "zero_cnt_no_rc", "dual_zero_cnt", "non_dual_zero", "zero_rate",
        "zero_no_rc_rate", "dual_zero_rate", "non_dual_zero_rate", "dt",
    ]
    detail = spark.read.parquet(paths["zero_detail"])
    versions = spark.read.parquet(paths["zero_version"])
    assert versions.agg(F.sum("cnt")).first()[0] == detail.count()
    sheet = zero_report.summary_sheet(zero_report.report_summary(inputs, I.LAST_DAY))
    assert sheet.first()["dt"] == "2017-03-20"


def test_zero_report_needs_rows(spark, tmp_path):
    inputs = Q.zero_inputs(spark, SF)
    with pytest.raises(zero_report.EmptyReport):
        zero_report.save_zero_report(inputs, 20200101, str(tmp_path / "none"))


def test_suspicious_report_saves_and_reruns(spark, tmp_path):
    """The history is read from the tables the new suspects go to."""
    base = Q.susp_inputs(spark, SF)
    targets = [str(tmp_path / "dist_hist"), str(tmp_path / "op_hist")]
    for target in targets:
        writers.overwrite_partition(base.distance_hist, target, "execute_date")
    kept = spark.read.parquet(targets[0]).count()

    def history(target):
        return readers.read_table(spark, target).select("service_order_id", "execute_date")

    def inputs():
        return susp_report.SuspInputs(
            **{**base.__dict__, "distance_hist": history(targets[0]), "operation_hist": history(targets[1])}
        )

    for _ in range(2):
        paths = susp_report.save_suspicious_report(inputs(), I.LAST_DAY, str(tmp_path / "susp"), *targets)
        sheets = {name: spark.read.parquet(path) for name, path in paths.items()}
        total = sheets["summary"].agg(*[F.sum(c).alias(c) for c in ("distance", "no_start", "no_end")]).first()
        for name in ("distance", "no_start", "no_end"):
            assert sheets[f"{name}_sheet"].count() == total[name] > 0
        fresh = sheets["distance_sheet"].where("is_new = 1").count()
        assert fresh > 0
        table = spark.read.parquet(targets[0])
        assert table.where(F.col("execute_date") == I.LAST_DAY).count() == fresh
        assert table.count() == kept + fresh
    later = susp_report.suspicious_report(inputs(), I.LAST_DAY + 1)["distance"]
    assert later.where("is_new = 1").count() == 0


def test_suspicious_report_expires_catalog_history(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS audit4")
    base = Q.susp_inputs(spark, SF)
    rows_ = susp_report.suspicious_report(base, I.LAST_DAY)
    for name, kind in (("d", "distance"), ("o", "operation")):
        tables.declare_table(spark, f"audit4.{name}", rows_[kind].schema, "execute_date")
        old = spark.createDataFrame([("1", 20170318), ("2", 20170319)], "service_order_id string, execute_date int")
        wide = old.select(*[
            F.col(c) if c in old.columns else F.lit(None).cast(t).alias(c) for c, t in rows_[kind].dtypes
        ])
        writers.overwrite_partition(wide, f"audit4.{name}", "execute_date")
    susp_report.save_suspicious_report(base, I.LAST_DAY, str(tmp_path / "susp"), "audit4.d", "audit4.o")
    assert rows_of(tables.table_partitions(spark, "audit4.d", "execute_date")) == [(20170319,), (I.LAST_DAY,)]


def test_zero_report_without_leaving_out_risk(spark):
    inputs = Q.zero_inputs(spark, "/root/testdata/sf0.01")
    plain = zero_report.ZeroInputs(**{**inputs.__dict__, "use_rc": False})
    strict = zero_report.zero_distance_report(inputs, I.LAST_DAY)["zero_detail"]
    loose = zero_report.zero_distance_report(plain, I.LAST_DAY)["zero_detail"]
    assert loose.where(~F.col("is_rc")).count() == strict.count()
    assert loose.where("is_rc").count() > 0 == strict.where("is_rc").count()
    with pytest.raises(ValueError):
        zero_report.ZeroInputs(**{**inputs.__dict__, "risk": None})


def test_device_and_risk_extracts(spark, tmp_path):
    device = ["5", "9", "1", "DR", "100", "5.1", "a", "b", "mac", "d", "s", "0", "n", "1", "20170328"]
    (tmp_path / "device.tsv").write_text("\t".join(device) + "\n")
    loads.load_devices(spark, str(tmp_path / "device.tsv"), str(tmp_path / "device"), 20170329)
    got = spark.read.parquet(str(tmp_path / "device")).first()
    assert (got["device_id"], got["user_type"], got["update_time"], got["dt"]) == (5, "DR", 100, 20170329)

    def risk_line(i, flag):
        cells = [str(i), "bj", "9", "8", "1.5", "2017-03-29 10:00:00", "", "c", "co", "p", "1", "2", "3", "4", "5", flag]
        return "\t".join(cells) + "\n"

    (tmp_path / "r1.txt").write_text(risk_line(1, "T") + risk_line(2, "T") + risk_line(3, "F"))
    (tmp_path / "r2.txt").write_text(risk_line(2, "T") + risk_line(4, "T"))
    loads.update_risk_list(spark, str(tmp_path / "r1.txt"), 20170328, None, str(tmp_path / "v1"))
    old = spark.read.parquet(str(tmp_path / "v1"))
    loads.update_risk_list(spark, str(tmp_path / "r2.txt"), 20170329, old, str(tmp_path / "v2"))
    listed = spark.read.parquet(str(tmp_path / "v2"))
    assert rows_of(listed.select("service_order_id", "dt")) == [(1, 20170328), (2, 20170329), (4, 20170329)]
    assert str(listed.where("service_order_id = 4").first()["create_time"]) == "2017-03-29 10:00:00"
    assert listed.where("complete_time is null").count() == 3


def test_declared_schemas_parse(spark):
    from tripaudit import schemas

    declared = [schemas.ORDER, schemas.ORDER_EXT, schemas.TRACK_POINT, schemas.DRIVER_ORDER_HIST]
    for text in declared:
        assert schema_from_ddl(text).fieldNames() == [n for n, _ in schemas.declared_columns(text)]


def test_tsv_keeps_tabs_line_ends_and_backslashes(spark, tmp_path):
    values = ["a\tb", "c\nd", "e\r", "\\N", "\\t", "x\\\\ty", "", None, "\\", "end\\\t"]
    frame = spark.createDataFrame(list(enumerate(values)), "service_order_id long, name string")
    writers.export_tsv(frame, str(tmp_path / "odd"))
    back = readers.read_tsv(spark, str(tmp_path / "odd"), frame.schema)
    assert rows_of(back) == rows_of(frame)


def test_missing_path_and_table_are_not_ready(spark, tmp_path):
    assert tables.partition_ready(spark, str(tmp_path / "nothing"), 20170329) is False
    assert tables.partition_ready(spark, "no_such_table", 20170329) is False


def test_first_run_has_an_empty_history(spark, tmp_path):
    schema = spark.createDataFrame([], "service_order_id string, execute_date int").schema
    for source in (str(tmp_path / "nothing"), "no_such_history"):
        got = loads.read_history(spark, source, schema)
        assert got.schema == schema and got.isEmpty()
    inputs = Q.susp_inputs(spark, SF)
    nothing = loads.read_history(spark, str(tmp_path / "none"), schema)
    first = susp_report.SuspInputs(**{**inputs.__dict__, "distance_hist": nothing, "operation_hist": nothing})
    targets = [str(tmp_path / "d"), str(tmp_path / "o")]
    paths = susp_report.save_suspicious_report(first, I.LAST_DAY, str(tmp_path / "susp"), *targets)
    assert spark.read.parquet(targets[0]).count() == spark.read.parquet(paths["distance_sheet"]).count() > 0
    zero = Q.zero_inputs(spark, SF)
    hist = loads.read_history(spark, str(tmp_path / "zh"), zero.driver_hist.schema)
    zero_report.save_zero_report(zero_report.ZeroInputs(**{**zero.__dict__, "driver_hist": hist}), I.LAST_DAY, str(tmp_path / "z"))


def test_zero_report_rerun_without_zero_trips(spark, tmp_path):
    """A late correction leaves no zero trip: the saved tables of the day end up without rows."""
    inputs = Q.zero_inputs(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS audit5")
    tables.declare_table(spark, "audit5.hist", inputs.driver_hist.schema)
    folder = str(tmp_path / "report")
    fixed = zero_report.ZeroInputs(**{**inputs.__dict__, "orders": inputs.orders.withColumn("dependable_distance", F.lit(900))})
    for hist in (str(tmp_path / "hist"), "audit5.hist"):
        zero_report.save_zero_report(inputs, I.LAST_DAY, folder, hist)
        assert readers.read_table(spark, hist).where(F.col("dt") == I.LAST_DAY).count() > 0
        paths = zero_report.save_zero_report(fixed, I.LAST_DAY, folder, hist)
        assert readers.read_table(spark, hist).where(F.col("dt") == I.LAST_DAY).count() == 0
        for name in ("zero_detail", "zero_version", "zero_city", "zero_driver"):
            assert spark.read.parquet(paths[name]).count() == 0, name
        assert spark.read.parquet(paths["zero_hour_distribute"]).agg(F.sum("cnt")).first()[0] == 0


def test_suspicious_report_rerun_without_new_suspects(spark, tmp_path):
    base = Q.susp_inputs(spark, SF)
    spark.sql("CREATE DATABASE IF NOT EXISTS audit6")
    wide = susp_report.suspicious_report(base, I.LAST_DAY)
    every = wide["distance"].select("service_order_id").unionAll(wide["operation"].select("service_order_id"))
    known = every.withColumn("execute_date", F.lit(I.LAST_DAY - 1))
    seen = susp_report.SuspInputs(**{**base.__dict__, "distance_hist": known, "operation_hist": known})
    for name, kind in (("d", "distance"), ("o", "operation")):
        tables.declare_table(spark, f"audit6.{name}", wide[kind].schema, "execute_date")
    for targets in ([str(tmp_path / "d"), str(tmp_path / "o")], ["audit6.d", "audit6.o"]):
        for inputs, some in ((base, True), (seen, False)):
            susp_report.save_suspicious_report(inputs, I.LAST_DAY, str(tmp_path / "susp"), *targets)
            for target in targets:
                assert readers.read_table(spark, target).where(F.col("execute_date") == I.LAST_DAY).isEmpty() != some


def test_saved_suspicious_report_reads_points_once(spark, tmp_path):
    """Everything that is saved comes from one enrichment: one scan of the points."""
    base = Q.susp_inputs(spark, SF)
    path = str(tmp_path / "points")
    base.points.write.parquet(path)
    inputs = susp_report.SuspInputs(**{**base.__dict__, "points": spark.read.parquet(path)})
    suspects = susp_report.report_suspects(inputs, I.LAST_DAY)
    marked = susp_report.marked_suspects(inputs, I.LAST_DAY, suspects)
    marked.collect()
    final = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan" in line and "latitude:double" in line for line in final.splitlines()) == 1
