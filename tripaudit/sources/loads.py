"""Loading daily extracts into tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.functions.times import days_between
from tripaudit.operators.history import risk_upsert
from tripaudit.schemas import DEVICE, ORDER, ORDER_EXT, RISK_ORDER, schema_from_ddl
from tripaudit.sources.files import Files
from tripaudit.sources.readers import extract_path, load_extracts, read_tsv
from tripaudit.sources.swap import is_path, replace_days
from tripaudit.sources.tables import declare_table, expire_partitions
from tripaudit.sources.writers import overwrite_partition, replace_table


def backfill(
    spark: SparkSession,
    folder: str,
    table: str,
    first: int,
    last: int,
    schema: StructType,
    target: str,
    dedupe_keys: Sequence[str] | None = ("service_order_id", "update_time"),
) -> None:
    """Load the extracts of a range of days, in one job instead of one per day."""
    rows = load_extracts(spark, folder, table, days_between(first, last), schema, dedupe_keys)
    overwrite_partition(rows, target)


def _log_path(log: str, table: str, day: int) -> str:
    return f"{log.rstrip('/')}/{table}_{int(day)}.json"


def job_log(spark: SparkSession, log: str, table: str) -> dict[int, dict]:
    """What is known of each day: ``state``, the extract's ``bytes`` and time (``modified``), ``rows`` loaded."""
    files = Files(spark, log)
    return {e["day"]: e for e in (json.loads(files.read_text(p)) for p in files.match(f"{log.rstrip('/')}/{table}_*.json"))}


def _record(spark: SparkSession, log: str, table: str, day: int, **facts) -> None:
    Files(spark, log).write_text(_log_path(log, table, day), json.dumps({"day": int(day), **facts}))


def resume_backfill(
    spark: SparkSession,
    folder: str,
    table: str,
    first: int,
    last: int,
    schema: StructType,
    target: str,
    log: str,
    dedupe_keys: Sequence[str] | None = ("service_order_id", "update_time"),
    keep_days: int | None = None,
) -> dict[int, str]:
    """:func:`backfill` with a job log: only days are loaded that are not, or whose extract has changed since.

    Returns a state per day: ``loaded`` now, ``kept`` from an earlier run, or
    ``missing`` without an extract. Pending days are staged by one job and
    swapped one by one, each logged when it is in place; a run that is lost on
    the way leaves its finished days finished, and the next one takes up the
    rest. A day that was swapped but not logged is loaded once more, which
    gives the same rows. With ``keep_days`` old days are dropped, once, at the end.
    """
    files, known = Files(spark, folder), job_log(spark, log, table)
    states, sources = {}, {}
    for day in days_between(first, last):
        path = extract_path(folder, table, day)
        if not files.exists(path):
            states[day] = "missing"
            continue
        size, modified = files.status(path)
        entry = known.get(day, {})
        same = entry.get("state") == "loaded" and (entry["bytes"], entry["modified"]) == (size, modified)
        states[day] = "kept" if same else "loaded"
        if not same:
            sources[day] = {"source": path, "bytes": size, "modified": modified}
    if sources:
        rows = load_extracts(spark, folder, table, list(sources), schema, dedupe_keys)
        if not is_path(target):
            declare_table(spark, target, StructType([f for f in schema.fields if f.name != "dt"] + [schema["dt"]]))
        replace_days(rows, target, days=list(sources), done=lambda day, n: _record(spark, log, table, day, state="loaded", rows=n, **sources[day]))
    if keep_days is not None:
        expire_partitions(spark, target, last, keep_days)
    return states


def load_day(
    spark: SparkSession,
    folder: str,
    table: str,
    day: int,
    schema: StructType,
    target: str,
    dedupe_keys: Sequence[str] | None = ("service_order_id", "update_time"),
    keep_days: int = 30,
) -> list[int]:
    """The daily step: load one extract into a catalog table and drop old days; returns the dropped ones.

    The table is created on the first run. Running a day again gives the same
    table, also if its extract has become empty. ``dedupe_keys`` is None for a
    table whose extract is taken as it is. All rows are of one day, so they are
    moved for the deduplication only.
    """
    columns = StructType([f for f in schema.fields if f.name != "dt"] + [schema["dt"]])
    declare_table(spark, target, columns)
    rows = load_extracts(spark, folder, table, [day], schema, dedupe_keys)
    overwrite_partition(rows, target, days=[day], together=True)
    return expire_partitions(spark, target, day, keep_days)


# The daily tables: declared columns, keys of the deduplication (None: taken as it is), days kept.
DAILY = {
    "order": (ORDER, ("service_order_id", "update_time"), 30),
    "order_ext": (ORDER_EXT, ("service_order_id", "update_time"), 30),
}


def load_daily(spark: SparkSession, folder: str, table: str, day: int, target: str) -> list[int]:
    """:func:`load_day` for one of the ``DAILY`` tables."""
    ddl, keys, keep_days = DAILY[table]
    return load_day(spark, folder, table, day, schema_from_ddl(ddl), target, keys, keep_days)


def read_history(spark: SparkSession, source: str, schema: StructType) -> DataFrame:
    """A history table, empty on the first run, when there is none yet."""
    if "/" not in source:
        return spark.table(source) if spark.catalog.tableExists(source) else spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(source)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_devices(spark: SparkSession, path: str, target: str, day: int) -> None:
    """Replace the device table by an extract, stamped with its load day."""
    replace_table(read_tsv(spark, path, schema_from_ddl(DEVICE)), target, day)


def read_risk_list(spark: SparkSession, path: str, day: int) -> DataFrame:
    """A risk-list extract, stamped with its load day."""
    return read_tsv(spark, path, schema_from_ddl(RISK_ORDER)).withColumn("dt", F.lit(int(day)))


def update_risk_list(spark: SparkSession, path: str, day: int, old: DataFrame | None, target: str) -> None:
    """Write the risk list after an extract to ``target``.

    ``target`` must be another place than the one ``old`` is read from, for
    example one folder per load day: a job that fails then leaves the old list
    as it was.
    """
    new = read_risk_list(spark, path, day)
    risk_upsert(new.limit(0) if old is None else old, new).write.mode("overwrite").parquet(target)
