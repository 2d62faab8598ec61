"""All-or-nothing replacement of days."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.plans import susp_report, zero_report
from tripaudit.catalog import inputs as I
from tripaudit.catalog import queries as Q
from tripaudit.schemas import schema_from_ddl
from tripaudit.sources import loads, readers, swap, tables, writers
from tripaudit.sources.files import Files

SF = "/root/testdata/sf0.001"
SCHEMA = StructType().add("id", "long").add("name", "string").add("dt", "integer")


class Lost(Exception):
    """The writer is gone."""


@pytest.fixture
def targets(spark, tmp_path):
    name = f"swap_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    tables.declare_table(spark, f"{name}.t", SCHEMA)
    tables.declare_table(spark, f"{name}.e", SCHEMA, location=f"{tmp_path}/ext")
    return [f"{name}.t", f"{name}.e", str(tmp_path / "path")]


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, target):
    return sorted((r["id"], r["dt"]) for r in readers.read_table(spark, target).collect())


def test_days_are_swapped_and_old_files_go(spark, targets):
    for target in targets:
        assert writers.overwrite_partition(frame(spark, (1, "a", 20170328), (2, "b", 20170329), (3, "c", 20170329)), target) == {20170328: 1, 20170329: 2}
        for _ in range(2):
            done = writers.overwrite_partition(frame(spark, (4, "d", 20170329), (9, "x", 20170401)), target, days=[20170329, 20170330])
            assert done == {20170329: 1, 20170330: 0}
            assert content(spark, target) == [(1, 20170328), (4, 20170329)]
        folder = swap.table_location(spark, target) if "/" not in target else target
        files = [f for f in Files(spark, folder).match(f"{folder}/*/*.parquet") + Files(spark, folder).match(f"{folder}/*/*/*.parquet")]
        assert len(files) == 3 and not Files(spark, folder).match(f"{folder}/_*")
        assert tables.partition_ready(spark, target, 20170330) == ("/" not in target)
        assert tables.partition_ready(spark, target, 20170330, whole=True)


@pytest.mark.parametrize("where", ["stage", "check", "first rename", "second rename"])
def test_a_lost_writer_leaves_the_old_day_readable(spark, targets, monkeypatch, where):
    for target in targets:
        writers.overwrite_partition(frame(spark, (1, "a", 20170328), (2, "b", 20170329)), target)
    fresh = frame(spark, (7, "n", 20170328), (8, "n", 20170329))
    renames = []

    def lost(*_, **__):
        raise Lost

    def rename(self, old, new, plain=Files.rename):
        renames.append(new)
        if "_stage" in old and where == "second rename" or "_aside" in new and where == "first rename":
            raise Lost
        return plain(self, old, new)

    for target in targets:
        if "rename" in where and "/" not in target:
            continue
        with monkeypatch.context() as patch:
            if where == "stage":
                patch.setattr(Files, "write_text", lost)
            elif where == "check":
                patch.setattr(swap, "swap_table", lost)
                patch.setattr(swap, "swap_path", lost)
            else:
                patch.setattr(Files, "rename", rename)
            with pytest.raises(Lost):
                writers.overwrite_partition(fresh, target)
        assert content(spark, target) == [(1, 20170328), (2, 20170329)], target
        writers.overwrite_partition(fresh, target)
        assert content(spark, target) == [(7, 20170328), (8, 20170329)], target


def test_rows_that_change_on_the_way_are_refused(spark, targets, monkeypatch):
    rows = frame(spark, (1, "a", 20170328))
    for target in targets:
        writers.overwrite_partition(rows, target)
        with monkeypatch.context() as patch:
            patch.setattr(swap.Observation, "get", {"n": 5})
            with pytest.raises(swap.BrokenStage):
                writers.overwrite_partition(frame(spark, (2, "b", 20170328)), target)
        with pytest.raises(swap.BrokenStage):
            writers.overwrite_partition(frame(spark, (2, "b", 20170328), (3, "c", None)), target)
        assert content(spark, target) == [(1, 20170328)]


def test_the_frame_is_computed_once(spark, targets):
    """Rows are counted by an accumulator while they are written; no second run for the list of days."""
    for target, days in zip(targets * 2, [None] * 3 + [[20170328, 20170329]] * 3):
        seen = spark.sparkContext.accumulator(0)

        def count(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = frame(spark, (1, "a", 20170328), (2, "b", 20170329), (3, "c", 20170329)).repartition(2).mapInArrow(count, SCHEMA)
        writers.overwrite_partition(rows, target, days=days)
        assert seen.value == 3


def test_two_writers_in_one_session(spark, targets):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    target, errors = targets[0], []
    writers.overwrite_partition(frame(spark, (0, "z", 20170320)), target)

    def write(day):
        try:
            for n in range(3):
                writers.overwrite_partition(frame(spark, *[(100 * n + i, "w", day) for i in range(20)]), target, days=[day])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(day,)) for day in (20170328, 20170329)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert content(spark, target) == sorted([(0, 20170320)] + [(200 + i, d) for i in range(20) for d in (20170328, 20170329)])


def test_readiness_looks_at_the_marker_and_the_files(spark, targets, tmp_path):
    for target in targets:
        writers.overwrite_partition(frame(spark, (1, "a", 20170328), (2, "b", 20170329)), target)
        assert swap.committed_rows(spark, target, 20170328) == 1
        assert swap.committed_rows(spark, target, 20170327) is None
        folder = swap.day_folder(spark, target, 20170329).split(":", 1)[-1]
        part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
        with open(f"{folder}/{part}", "ab") as file:
            file.write(b"x")
        assert not tables.partition_ready(spark, target, 20170329, whole=True)
        os.remove(f"{folder}/{part}")
        assert not tables.partition_ready(spark, target, 20170329, whole=True)
    assert not tables.partition_ready(spark, str(tmp_path / "nothing"), 20170329, whole=True)
    assert not tables.partition_ready(spark, "no_such_table", 20170329, whole=True)
    spark.range(3).write.parquet(str(tmp_path / "plain" / "dt=20170329"))
    assert tables.partition_ready(spark, str(tmp_path / "plain"), 20170329)
    assert not tables.partition_ready(spark, str(tmp_path / "plain"), 20170329, whole=True)


def test_orphans_of_lost_writers_go_after_a_while(spark, targets):
    table = targets[0]
    writers.overwrite_partition(frame(spark, (1, "a", 20170328)), table)
    swap.stage(frame(spark, (2, "b", 20170328)), f"{swap.table_location(spark, table)}/load-dead", "dt")
    assert swap.drop_orphans(spark, table) == []
    time.sleep(0.01)
    assert [f.rsplit("/", 1)[1] for f in swap.drop_orphans(spark, table, hours=0)] == ["load-dead"]
    assert content(spark, table) == [(1, 20170328)]


def test_columns_are_added_and_types_refused(spark, targets):
    table = targets[0]
    writers.overwrite_partition(frame(spark, (1, "a", 20170328)), table)
    wide = schema_from_ddl("id bigint\n name string\n price double\n dt int\n")
    assert tables.declare_table(spark, table, wide) == ["price"]
    assert tables.declare_table(spark, table, wide) == [] == tables.declare_table(spark, table, SCHEMA)
    writers.overwrite_partition(spark.createDataFrame([(2, "b", 1.5, 20170329)], wide), table)
    assert sorted((r["id"], r["price"]) for r in spark.table(table).collect()) == [(1, None), (2, 1.5)]
    with pytest.raises(tables.SchemaConflict, match="id: bigint to int"):
        tables.declare_table(spark, table, schema_from_ddl("id int\n more string\n dt int\n"))
    assert "more" not in spark.table(table).columns


def test_both_reports_start_on_a_fresh_catalog(spark, tmp_path):
    """No history table yet: the savers create them, as declared by what they write."""
    spark.sql(f"CREATE DATABASE swap_fresh LOCATION '{tmp_path}/db'")
    zero_report.save_zero_report(Q.zero_inputs(spark, SF), I.LAST_DAY, str(tmp_path / "z"), "swap_fresh.drivers")
    assert spark.table("swap_fresh.drivers").count() > 0
    names = ["swap_fresh.distance", "swap_fresh.operation"]
    susp_report.save_suspicious_report(Q.susp_inputs(spark, SF), I.LAST_DAY, str(tmp_path / "s"), *names)
    assert all(spark.table(n).where(F.col("execute_date") == I.LAST_DAY).count() > 0 for n in names)


def test_rerun_of_a_day_that_turned_out_empty(spark, tmp_path):
    """The orders of the day are corrected away: both reports raise, and leave no row of the day behind."""
    spark.sql(f"CREATE DATABASE swap_empty LOCATION '{tmp_path}/db'")
    susp, zero = Q.susp_inputs(spark, SF), Q.zero_inputs(spark, SF)
    for names in (["swap_empty.d", "swap_empty.o", "swap_empty.h"], [str(tmp_path / x) for x in "doh"]):
        paths = susp_report.save_suspicious_report(susp, I.LAST_DAY, str(tmp_path / "s"), *names[:2])
        more = zero_report.save_zero_report(zero, I.LAST_DAY, str(tmp_path / "z"), names[2])
        other = frame(spark).sparkSession.table("swap_empty.h") if "/" not in names[2] else None
        assert other is None or not other.isEmpty()
        gone = [type(x)(**{**x.__dict__, "orders": x.orders.where("false")}) for x in (susp, zero)]
        with pytest.raises(zero_report.EmptyReport):
            susp_report.save_suspicious_report(gone[0], I.LAST_DAY, str(tmp_path / "s"), *names[:2])
        with pytest.raises(zero_report.EmptyReport):
            zero_report.save_zero_report(gone[1], I.LAST_DAY, str(tmp_path / "z"), names[2])
        for name, column in zip(names, ("execute_date", "execute_date", "dt")):
            assert readers.read_table(spark, name).where(F.col(column) == I.LAST_DAY).count() == 0
        assert all(spark.read.parquet(p).count() == 0 for p in paths.values())
        for name, path in more.items():
            rows = spark.read.parquet(path).where(F.col("dt") == I.LAST_DAY).count()
            assert rows == 0, name


@pytest.mark.parametrize("kind", ["table", "path"])
def test_backfill_takes_up_where_it_was_lost(spark, targets, tmp_path, monkeypatch, kind):
    """Killed after two of five days and resumed, then with an extract changed and one that arrives late."""
    target, clean = (targets[0], targets[1]) if kind == "table" else (targets[2], str(tmp_path / "clean"))
    folder, log = tmp_path / "in", str(tmp_path / "log")
    folder.mkdir()
    days = [20170301, 20170302, 20170303, 20170304, 20170305]

    def extract(day, *ids):
        (folder / f"t_{day}.tsv").write_text("".join(f"{i}\tn\t{day}\n" for i in ids))

    for n, day in enumerate(days[:4]):
        extract(day, n, n, 10 + n)
    args = (spark, str(folder), "t", days[0], days[-1], SCHEMA)
    logged = []

    def record(*a, plain=loads._record, **k):
        if len(logged) == 2:
            raise Lost
        logged.append(a[3])
        plain(*a, **k)

    with monkeypatch.context() as patch:
        patch.setattr(loads, "_record", record)
        with pytest.raises(Lost):
            loads.resume_backfill(*args, target, log, ["id"])
    assert logged == days[:2] and sorted(loads.job_log(spark, log, "t")) == days[:2]
    states = loads.resume_backfill(*args, target, log, ["id"])
    assert list(states.values()) == ["kept", "kept", "loaded", "loaded", "missing"]
    extract(days[0], 77)
    extract(days[4], 5)
    os.utime(folder / f"t_{days[0]}.tsv", (1, 1))
    states = loads.resume_backfill(*args, target, log, ["id"], keep_days=3)
    assert list(states.values()) == ["loaded", "kept", "kept", "kept", "loaded"]
    loads.resume_backfill(*args, clean, str(tmp_path / "log2"), ["id"], keep_days=3)
    assert content(spark, target) == content(spark, clean) == [(2, days[2]), (3, days[3]), (5, days[4]), (12, days[2]), (13, days[3])]
    entry = loads.job_log(spark, log, "t")[days[0]]
    assert (entry["rows"], entry["state"], entry["modified"]) == (1, "loaded", 1000)
    assert set(loads.resume_backfill(*args, target, log, ["id"]).values()) == {"kept"}


def test_days_that_come_together_are_not_moved(spark, tmp_path):
    """Swapping days (F7) and loading one (F2): each task writes its own rows, without an exchange."""
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "'a' as name", "20170328 as dt")
    staged = swap.stage(rows, str(tmp_path / "s"), "dt", together=True)
    assert staged.days == {20170328: 400}
    assert len(Files(spark, staged.folder).match(f"{staged.folder}/dt=20170328/*.parquet")) == 4


def test_extracts_of_all_days_by_many_tasks(spark, tmp_path):
    """no day of an extract is written or read by a single task."""
    rows = spark.range(0, 400, 1, 4).selectExpr("id", "if(id % 3 = 0, null, 'a\\tb') as name", "cast(20170328 + id % 2 as int) as dt")
    folder = str(tmp_path)
    for _ in range(2):  # the second run replaces the first
        assert writers.export_days(rows.unionAll(rows.limit(1).withColumn("dt", F.lit(None))), folder, "t") == [20170328, 20170329]
        assert len(Files(spark, folder).match(f"{folder}/t_20170328.tsv/part-*")) >= 4
        back = readers.read_extracts(spark, folder, "t", [20170328, 20170329], SCHEMA)
        assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert not Files(spark, folder).match(f"{folder}/_days-*")


def test_resumed_backfill_query_exports_by_many_tasks(spark, monkeypatch):
    """the query wrote every extract by one task."""
    folders = []
    monkeypatch.setattr(Q, "scratch_dir", lambda s, label, real=Q.scratch_dir: folders.append(real(s, label)) or folders[-1])
    monkeypatch.setattr(I, "fx_order", lambda s, sf, real=I.fx_order: real(s, sf).repartition(4))
    Q.REGISTRY["backfill_resumed"](spark, SF)
    folder = next(f for f in folders if "/extracts-" in f)
    assert len(Files(spark, folder).match(readers.extract_path(folder, "orders", 20170322) + "/part-*")) == 4
