"""Day-partitioned catalog tables: declare, list, check, expire."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.functions.times import shift_day
from tripaudit.sources.files import Files
from tripaudit.sources.readers import read_days
from tripaudit.sources.swap import committed_rows, day_location, is_path


class SchemaConflict(ValueError):
    """A declared column has another type than the stored one."""


def declare_table(
    spark: SparkSession, name: str, schema: StructType, part: str = "dt", location: str | None = None
) -> list[str]:
    """Create a day-partitioned Parquet table, or add the columns an existing one lacks; returns those.

    Managed by default, with a ``location`` external. Rows stored before a
    column was declared have NULL in it. A column that is stored with another
    type is refused, before anything is changed; one that is stored and no longer declared stays.
    """
    if spark.catalog.tableExists(name):
        stored = {f.name.lower(): f.dataType for f in spark.table(name).schema}
        other = [f for f in schema if f.name.lower() in stored and stored[f.name.lower()] != f.dataType]
        if other:
            kinds = ", ".join(f"{f.name}: {stored[f.name.lower()].simpleString()} to {f.dataType.simpleString()}" for f in other)
            raise SchemaConflict(f"{name} is stored with other types ({kinds})")
        added = [f for f in schema if f.name.lower() not in stored]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        return [f.name for f in added]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({part}){where}")
    return []


def table_partitions(spark: SparkSession, table: str, part: str = "dt") -> DataFrame:
    """Days (``part``) of the partitions of a catalog table."""
    found = spark.sql(f"SHOW PARTITIONS {table}")
    return found.select(F.regexp_extract("partition", rf"{part}=(\d+)", 1).cast("int").alias(part))


def partition_ready(spark: SparkSession, source: str, day: int, whole: bool = False) -> bool:
    """Has the partition of ``day`` arrived? Reads metadata or one row.

    With ``whole`` it must also be marked as committed and have all the files
    of its marker, in their sizes; no row is read then. A path or a table that
    does not exist has no partitions.
    """
    if whole:
        return committed_rows(spark, source, day) is not None
    if "/" in source:
        try:
            return not read_days(spark, source, [day]).limit(1).isEmpty()
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
    if not spark.catalog.tableExists(source):
        return False
    return not spark.sql(f"SHOW PARTITIONS {source} PARTITION (dt={int(day)})").isEmpty()


def ready_days(spark: SparkSession, table: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` days (``dt``) with a boolean ``ready``."""
    have = table_partitions(spark, table).withColumn("_have", F.lit(True))
    return wanted.join(have, "dt", "left").select("dt", F.col("_have").isNotNull().alias("ready"))


def expire_partitions(
    spark: SparkSession, source: str, day: int, keep_days: int = 30, part: str = "dt"
) -> list[int]:
    """Drop partitions ``keep_days`` old or older and their files; returns the dropped days.

    ``source`` is a catalog table, managed or external, or a Parquet path. The
    catalog forgets the days first, in one statement, their folders go after.

    Deviation from the source system, which drops the one day that is exactly
    ``keep_days`` old and so keeps days it missed. The lists hold partition
    values and folders, not data.
    """
    last = shift_day(day, -keep_days)
    if is_path(source):
        found = {int(f.rsplit("=", 1)[1]): f for f in Files(spark, source).match(f"{source.rstrip('/')}/{part}=[0-9]*")}
        folders = {d: f for d, f in sorted(found.items()) if d <= last}
    else:
        old = sorted(r[part] for r in table_partitions(spark, source, part).where(F.col(part) <= last).collect())
        folders = {d: day_location(spark, source, d, part) for d in old}
        if old:
            specs = ", ".join(f"PARTITION ({part}={d})" for d in old)
            spark.sql(f"ALTER TABLE {source} DROP IF EXISTS {specs}")
    for folder in folders.values():
        Files(spark, folder).delete(folder)
    return list(folders)
