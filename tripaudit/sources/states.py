"""Keyed states: one row per key, kept as a bucketed table that is moved on day by day."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripaudit.operators.joins import latest_ext_rows
from tripaudit.operators.rolling import driver_deltas, merge_latest, move_totals
from tripaudit.operators.rows import ID, latest_per_key
from tripaudit.sources.files import Files
from tripaudit.sources.swap import table_location

NOTE = "_NOTE"


@dataclass(frozen=True)
class KeyedState:
    """A table bucketed by ``key``, replaced as a whole by one catalog statement.

    Joins on the key read it without an exchange; the other side is dealt to
    its buckets. Every version lies in a folder of its own below ``folder``,
    with a note on what it contains, so that rows and note change together.
    Take as many buckets as keep a bucket's share of the rows within a task, and
    not fewer than ``spark.sql.shuffle.partitions``: Spark would then rather
    deal both sides anew than join with fewer tasks.
    """

    spark: SparkSession
    name: str
    key: str
    folder: str
    buckets: int = 64

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.read.table(self.name)

    def note(self) -> dict:
        """What the state contains; empty before the first version."""
        if not self.exists():
            return {}
        where = table_location(self.spark, self.name)
        return json.loads(Files(self.spark, where).read_text(f"{where}/{NOTE}"))

    def replace(self, rows: DataFrame, note: dict) -> None:
        """Write the next version beside the one in use, then let the table be read from there and delete the old one.

        A writer that is lost before the swap leaves the old version in use.
        """
        where = f"{self.folder.rstrip('/')}/state-{uuid.uuid4().hex}"
        first = not self.exists()
        name = self.name if first else f"{self.name}_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, self.key) if first else rows
        old = None if first else table_location(self.spark, self.name)
        files = Files(self.spark, where)
        dealt.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", where).saveAsTable(name)
        files.write_text(f"{where}/{NOTE}", json.dumps(note))
        if not first:
            self.spark.sql(f"DROP TABLE {name}")  # external: its files stay
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{where}'")
            files.delete(old)


def advance_drivers(state: KeyedState, rows: DataFrame, day: int) -> None:
    """Move the driver state on by the history rows of ``day``; a rerun takes back what the day gave before.

    ``rows`` are those of :func:`~tripaudit.operators.history.driver_hist_rows`.
    The day's share is stored beside the state and named in its note, so that
    nothing but the state, the day's old share and the new one is read.
    """
    spark, days = state.spark, dict(state.note().get("days", {}))
    fresh = f"{state.folder.rstrip('/')}/day-{int(day)}-{uuid.uuid4().hex}"
    driver_deltas(rows).write.parquet(fresh)
    add = spark.read.parquet(fresh)
    old = days.get(str(int(day)))
    take = spark.read.parquet(old) if old else None
    moved = move_totals(state.read() if state.exists() else None, add, take)
    state.replace(moved, {"days": days | {str(int(day)): fresh}})
    if old:
        Files(spark, old).delete(old)


def drivers_before(state: KeyedState, day: int) -> DataFrame:
    """The driver state as it was before ``day``: shares of that day and later ones taken back.

    On the day after the last one there are none, and the state is read as it is.
    """
    later = [path for d, path in state.note().get("days", {}).items() if int(d) >= int(day)]
    if not later:
        return state.read()
    return move_totals(state.read(), None, state.spark.read.parquet(*later))


def advance_latest_ext(state: KeyedState, ext: DataFrame, day: int) -> None:
    """Bring the snapshot of newest extension rows up to date with the rows of ``day``.

    The day is reduced to one row per order and dealt to the buckets; the
    snapshot is not moved. A day given again changes nothing. A corrected
    extract that has lost rows needs a new snapshot, as what it had overwritten is gone.
    """
    note = state.note()
    new = latest_per_key(latest_ext_rows(ext), [ID], ["update_time"])
    merged = merge_latest(state.read(), new, ID, ["update_time"]) if state.exists() else new
    state.replace(merged, {"days": sorted({*note.get("days", []), int(day)})})
