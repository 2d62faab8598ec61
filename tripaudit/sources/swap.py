"""All-or-nothing replacement of days: rows are staged and checked, then the day is swapped.

A day is never half written: until its swap readers see the old rows, from
then on the new ones. In a catalog table the swap is one statement that names
the day's new folder. On a path it is two renames; whoever opens the path next
puts the old folder back if the writer was lost between them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from time import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripaudit.sources.files import Files

MARKER = "_COMMIT"
RENAME_TRIES = 5


class BrokenStage(RuntimeError):
    """What was staged is not what was computed; nothing was replaced."""


@dataclass
class Staged:
    """Folder of staged rows and rows per day in it."""

    folder: str
    days: dict[int, int]


def is_path(target: str) -> bool:
    return "/" in target


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def day_location(spark: SparkSession, table: str, day: int, part: str = "dt") -> str:
    """Folder of one day of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({part}={int(day)})").collect()
    names = [r["col_name"] for r in rows]
    own = rows[names.index("# Detailed Partition Information") :]
    return next(r["data_type"] for r in own if r["col_name"] == "Location").rstrip("/")


def _day_of(path: str, part: str) -> int | None:
    found = re.search(rf"/{part}=(\d+)/?$", path)
    return int(found.group(1)) if found else None


def stage(df: DataFrame, folder: str, part: str, days: Sequence[int] | None = None, together: bool = False) -> Staged:
    """Write ``df`` once to ``folder``, check it, and mark every day with its rows and files.

    Rows are rebalanced by day first: a day becomes a few files of a sound
    size, and a day holding most of the rows is split instead of being written
    by one task. Where the rows of a day lie ``together`` in a few tasks of a
    sound size as they come, they are written so, without an exchange. The rows are counted by the run that writes them, the staged
    ones from the footers of the files; the days are the folders found. Named
    days without rows are staged empty.
    """
    spark, files = df.sparkSession, Files(df.sparkSession, folder)
    seen = Observation()
    dealt = df if together else df.hint("rebalance", F.col(part))
    rows = dealt.observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.partitionBy(part).parquet(folder)
    found = {_day_of(p, part): p for p in files.match(f"{folder}/{part}=*")}
    if None in found:
        raise BrokenStage(f"rows without a day in {part}")
    counts = dict.fromkeys(found, 0)
    if found:
        counts |= {int(r[0]): r[1] for r in spark.read.parquet(folder).groupBy(part).count().collect()}
    if sum(counts.values()) != seen.get["n"]:
        raise BrokenStage(f"{seen.get['n']} rows computed, {sum(counts.values())} staged in {folder}")
    for day in sorted({int(d) for d in days or ()} - set(found)):
        spark.createDataFrame([], df.drop(part).schema).write.parquet(f"{folder}/{part}={day}")
        counts[day] = 0
    for day, n in counts.items():
        own = f"{folder}/{part}={day}"
        sizes = {name: size for name, (size, _) in files.listing(own).items() if not name.startswith(("_", "."))}
        files.write_text(f"{own}/{MARKER}", json.dumps({"rows": n, "files": sizes}))
    return Staged(folder, counts)


def swap_table(spark: SparkSession, table: str, staged: Staged, part: str = "dt", done: Callable[[int, int], None] | None = None) -> None:
    """Let every staged day of a catalog table be read from where it was staged, day by day; old folders go last."""
    have = {_day_of("/" + r[0], part) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    old = {day: day_location(spark, table, day, part) for day in staged.days if day in have}
    for day in sorted(staged.days):
        where = f"{staged.folder}/{part}={day}"
        if day in have:
            spark.sql(f"ALTER TABLE {table} PARTITION ({part}={day}) SET LOCATION '{where}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({part}={day}) LOCATION '{where}'")
        if done:
            done(day, staged.days[day])
    for folder in old.values():
        Files(spark, folder).delete(folder)


def swap_path(spark: SparkSession, target: str, staged: Staged, part: str = "dt", done: Callable[[int, int], None] | None = None) -> None:
    """Put every staged day in the place of the one on the path."""
    files = Files(spark, target)
    aside = f"{target}/_aside-{uuid.uuid4().hex}"
    for day in sorted(staged.days):
        live, new = f"{target}/{part}={day}", f"{staged.folder}/{part}={day}"
        for n in range(RENAME_TRIES):
            # A reader that opened the path in between has put the old day back: move it again.
            if files.exists(live):
                files.rename(live, f"{aside}-{n}/{part}={day}")
            if files.rename(new, live):
                break
        else:
            raise BrokenStage(f"{live} could not be replaced")
        if done:
            done(day, staged.days[day])
    for folder in [*files.match(f"{aside}-*"), staged.folder]:
        files.delete(folder)


def recover_path(spark: SparkSession, target: str) -> list[str]:
    """Put back days that a lost writer had moved aside and not yet replaced; returns their folders."""
    files, back = Files(spark, target), []
    for moved in files.match(f"{target.rstrip('/')}/_aside-*/*=*"):
        live = f"{target.rstrip('/')}/{moved.rsplit('/', 1)[1]}"
        if files.rename(moved, live):
            back.append(live)
    return back


def replace_days(
    df: DataFrame,
    target: str,
    part: str = "dt",
    days: Sequence[int] | None = None,
    done: Callable[[int, int], None] | None = None,
    together: bool = False,
) -> dict[int, int]:
    """Replace the days found in ``df``, or exactly the named ones, all or nothing for each; rows per day.

    ``done`` is called with day and rows after each swap; ``together`` is that of :func:`stage`.

    The frame is computed once. No setting of the session is changed, so
    several writers can share one. A table's columns are cast to its types.
    """
    spark = df.sparkSession
    if days is not None:
        df = df.where(F.col(part).isin(sorted({int(d) for d in days})))
    if is_path(target):
        target = target.rstrip("/")
        recover_path(spark, target)
        folder = f"{target}/_stage-{uuid.uuid4().hex}"
        rows = df
    else:
        folder = f"{table_location(spark, target)}/load-{uuid.uuid4().hex}"
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(target).schema])
    try:
        staged = stage(rows, folder, part, days, together)
    except BaseException:
        Files(spark, folder).delete(folder)
        raise
    (swap_path if is_path(target) else swap_table)(spark, target, staged, part, done)
    return staged.days


def day_folder(spark: SparkSession, source: str, day: int, part: str = "dt") -> str | None:
    """Where a day of a table or path lies, or None where it does not exist."""
    if is_path(source):
        where = f"{source.rstrip('/')}/{part}={int(day)}"
        return where if Files(spark, where).exists(where) else None
    if not spark.catalog.tableExists(source) or spark.sql(f"SHOW PARTITIONS {source} PARTITION ({part}={int(day)})").isEmpty():
        return None
    return day_location(spark, source, day, part)


def committed_rows(spark: SparkSession, source: str, day: int, part: str = "dt") -> int | None:
    """Rows of a day that lies there whole, None otherwise: its marker is compared with its files, no row is read."""
    folder = day_folder(spark, source, day, part)
    if folder is None or not Files(spark, folder).exists(f"{folder}/{MARKER}"):
        return None
    files = Files(spark, folder)
    marker = json.loads(files.read_text(f"{folder}/{MARKER}"))
    here = {name: size for name, (size, _) in files.listing(folder).items()}
    return marker["rows"] if all(here.get(name) == size for name, size in marker["files"].items()) else None


def drop_orphans(spark: SparkSession, table: str, part: str = "dt", hours: float = 24) -> list[str]:
    """Delete staged folders of a table that no day is read from and that are older than ``hours``.

    They are left by writers that were lost before their swap.
    """
    where = table_location(spark, table)
    days = [_day_of("/" + r[0], part) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    used = {day_location(spark, table, d, part).rsplit("/", 1)[0].split(":", 1)[-1] for d in days if d is not None}
    files = Files(spark, where)
    old = (time() - 3600 * hours) * 1000
    gone = [f for f in files.match(f"{where}/load-*") if f.split(":", 1)[-1] not in used and files.status(f)[1] <= old]
    for folder in gone:
        files.delete(folder)
    return gone
