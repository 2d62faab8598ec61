"""Writing day partitions, dimension tables, TSV exports and report bundles."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.functions.text import NULL_TEXT, escape_tsv
from tripaudit.sources.files import Files
from tripaudit.sources.readers import extract_path
from tripaudit.sources.swap import is_path, replace_days
from tripaudit.sources.tables import declare_table


def overwrite_partition(
    df: DataFrame, target: str, part: str = "dt", days: Sequence[int] | None = None, together: bool = False
) -> dict[int, int]:
    """Replace the ``part`` values present in ``df``, or exactly the named ``days``; rerunnable. Rows per day.

    ``target`` is a Parquet path or a catalog table, which is created where it
    does not exist. A named day for which ``df`` has no rows ends up without
    rows, and rows of other days are not written. A day is replaced all or
    nothing, see :mod:`tripaudit.sources.swap`. Set ``together`` for rows that
    come by day, such as one day's or those read from days: they are not moved.
    """
    if not is_path(target) and not df.sparkSession.catalog.tableExists(target):
        own = [f for f in df.schema if f.name != part]
        declare_table(df.sparkSession, target, StructType([*own, df.schema[part]]), part)
    return replace_days(df, target, part, days, together=together)


def upsert_by_date(df: DataFrame, target: str, part: str = "dt", days: Sequence[int] | None = None) -> dict[int, int]:
    """Replace the result rows of the dates present in ``df``, or of the named ``days``."""
    return overwrite_partition(df, target, part, days)


def replace_table(df: DataFrame, target: str, day: int) -> None:
    """Replace a whole dimension table, stamped with its load day."""
    stamped = df.withColumn("dt", F.lit(int(day)))
    writer = stamped.write.mode("overwrite")
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def _tsv_line(names: Sequence[str]) -> Column:
    texts = [F.coalesce(escape_tsv(F.col(c).cast("string")), F.lit(NULL_TEXT)) for c in names]
    return F.concat_ws("\t", *texts).alias("value")


def export_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Write tab-separated text without header or quotes, NULL as ``\\N``.

    Backslashes, tabs and line ends inside a value are escaped by a backslash
    (so a text equal to the NULL mark is not NULL); ``read_tsv`` undoes it.
    """
    df.select(_tsv_line(columns or df.columns)).write.mode("overwrite").text(path)


def export_days(df: DataFrame, folder: str, table: str, columns: Sequence[str] | None = None, part: str = "dt") -> list[int]:
    """The daily extracts of all days in ``df`` by one job that moves no rows, in the format of :func:`export_tsv`; returns the days.

    Each extract is a folder where :func:`~tripaudit.sources.readers.extract_path`
    says, in place of one that is there. Rows without a day are in none.
    """
    spark, stage = df.sparkSession, f"{folder.rstrip('/')}/_days-{uuid.uuid4().hex}"
    files = Files(spark, stage)
    lines = df.where(F.col(part).isNotNull()).select(F.col(part).alias("_day"), _tsv_line(columns or df.columns))
    lines.write.partitionBy("_day").text(stage)
    found = {int(f.rsplit("=", 1)[1]): f for f in files.match(f"{stage}/_day=*")}
    for day, own in found.items():
        path = extract_path(folder, table, day)
        files.delete(path)
        if not files.rename(own, path):
            raise OSError(f"{own} could not be moved to {path}")
    files.delete(stage)
    return sorted(found)


def write_bundle(frames: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """One Parquet dataset per named frame under ``folder``."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in frames}
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(paths[name])
    return paths
