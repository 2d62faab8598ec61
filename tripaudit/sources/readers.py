"""Reading extracts, day partitions, side tables, logs and raw tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.functions.numbers import digits_or_zero, safe_double
from tripaudit.functions.text import NULL_TEXT, unescape_tsv
from tripaudit.operators.filters import on_days
from tripaudit.operators.rows import ID, dedupe
from tripaudit.sources.swap import is_path, recover_path

TAB = "\t"


def typed_columns(parts: Column, schema: StructType) -> list[Column]:
    """Cast the parts of a line by position.

    A part that does not fit its type, ``\\N`` and a missing part give NULL.
    Quotes are ordinary characters, escaped tabs, line ends and backslashes
    are restored, and an empty text stays an empty text.
    """
    out = []
    for i, field in enumerate(schema.fields):
        text = unescape_tsv(F.nullif(F.get(parts, F.lit(i)), F.lit(NULL_TEXT)))
        out.append(text.try_cast(field.dataType).alias(field.name))
    return out


def _cut(lines: DataFrame, col: str, *keep: Column | str) -> DataFrame:
    """Lines cut at tabs, once for all columns taken from them (``_parts``)."""
    return lines.select(*keep, F.split(F.col(col), TAB, -1).alias("_parts"))


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """A headerless tab-separated extract in the Hive text format."""
    paths = [path] if isinstance(path, str) else list(path)
    return _cut(spark.read.text(paths), "value").select(*typed_columns(F.col("_parts"), schema))


def extract_path(folder: str, table: str, day: int) -> str:
    return f"{folder.rstrip('/')}/{table}_{day}.tsv"


def read_extracts(
    spark: SparkSession, folder: str, table: str, days: Sequence[int], schema: StructType
) -> DataFrame:
    """The daily extracts of ``days`` in one read, ``dt`` set to the file's day.

    Rows that carry another day than their file are dropped, as in a load of
    the single day.
    """
    paths = [extract_path(folder, table, day) for day in days]
    file_day = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{8})\.tsv", 1)
    lines = _cut(spark.read.text(paths), "value", file_day.alias("_day"))
    typed = lines.select("_day", *typed_columns(F.col("_parts"), schema))
    own = typed.where(F.col("dt").cast("string").startswith(F.col("_day")))
    return own.withColumn("dt", F.col("_day").cast("int")).drop("_day")


def load_extracts(
    spark: SparkSession,
    folder: str,
    table: str,
    days: Sequence[int],
    schema: StructType,
    keys: Sequence[str] | None = (ID, "update_time"),
) -> DataFrame:
    """Typed and, unless ``keys`` is None, deduplicated rows of some days.

    Duplicates are removed within a day, which is what loading the days one
    after the other does.
    """
    rows = read_extracts(spark, folder, table, days, schema)
    return rows if keys is None else dedupe(rows, ["dt", *keys])


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table by name, or a Parquet dataset by path (days a lost writer had moved aside are put back)."""
    if not is_path(source):
        return spark.read.table(source)
    recover_path(spark, source)
    return spark.read.parquet(source)


def read_days(spark: SparkSession, source: str, days: Sequence[int]) -> DataFrame:
    """Listed ``dt`` partitions of a table; the other ones are not read."""
    return on_days(read_table(spark, source), days)


def read_side(
    spark: SparkSession, source: str, where: str | Column | None = None, format: str | None = None, **options: str
) -> DataFrame:
    """A side table with an optional filter, which is pushed into the scan.

    ``format`` (for example ``jdbc``) and ``options`` select another source
    than a table name or a Parquet path.
    """
    df = spark.read.format(format).options(**options).load() if format else read_table(spark, source)
    return df if where is None else df.where(where)


# Positions of the used columns in a distance-service row.
LOG_POSITIONS = {ID: 2, "r_yy_dis": 4, "r_sys_dis": 6, "driver_dis": 8, "response_dis": 9, "is_enable": 13}


def parse_distance_log(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Six columns of raw distance-service lines, by position.

    Lines without a tab are messages and dropped. A distance that is not a
    number is 0.0, a flag that is not all digits is 0.
    """
    def part(name: str) -> Column:
        return F.get("_parts", F.lit(LOG_POSITIONS[name]))

    distances = [n for n in LOG_POSITIONS if n.endswith("_dis")]
    rows = lines.where(F.instr(F.col(col), TAB) > 1)
    return _cut(rows, col, *keep).select(
        *keep,
        part(ID).alias(ID),
        *[safe_double(part(n), 0.0).alias(n) for n in distances],
        digits_or_zero(F.coalesce(part("is_enable"), F.lit(""))).alias("is_enable"),
    )


TRACK_REPLY = (
    "struct<results:array<struct<timestamp:bigint,provider:string,accuracy:double,"
    "latitude:double,longitude:double>>>"
)


def parse_tracks(raw: DataFrame, body: str = "body") -> DataFrame:
    """Points of raw track replies (``service_order_id``, JSON ``body``).

    Times become seconds. A reply that is missing, broken or empty has no
    points.
    """
    reply = F.from_json(F.col(body), TRACK_REPLY)
    points = raw.select(ID, F.explode(reply["results"]).alias("p"))
    return points.select(
        ID,
        F.floor(F.col("p.timestamp") / 1000).alias("t"),
        "p.provider",
        "p.accuracy",
        "p.latitude",
        "p.longitude",
    )

