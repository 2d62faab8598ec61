"""Loads that set broken rows aside: one parse, one write, good and bad rows counted on the way."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripaudit.functions.text import NULL_TEXT, unescape_tsv
from tripaudit.operators.rows import ID
from tripaudit.sources.files import Files
from tripaudit.sources.readers import LOG_POSITIONS, TAB, TRACK_REPLY, typed_columns

# What is wrong with a line: the column it was found in ('' for the line as a whole) and why.
PROBLEM = "array<struct<column:string,reason:string>>"


@dataclass
class Checked:
    """Counts of a checked load and where its rows are."""

    good: int
    bad: int
    folder: str

    @property
    def lines(self) -> int:
        return self.good + self.bad


def _problem(column: str, reason: str, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason")))


def _found(*checks: Column) -> Column:
    return F.array_compact(F.array(*checks)).cast(PROBLEM)


def check_tsv(lines: DataFrame, schema: StructType, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Lines of a tab-separated extract, typed, with ``line`` and ``problems``.

    A column has a problem if the line ends before it or its text is not NULL
    and does not fit its type; the line has one if it goes on after the last
    column. The typed columns are those of :func:`~tripaudit.sources.readers.read_tsv`.
    """
    cut = lines.select(*keep, F.col(col).alias("line"), F.split(F.col(col), TAB, -1).alias("_parts"))
    n = F.size("_parts")
    checks = [_problem("", "too many columns", n > len(schema.fields))]
    for i, field in enumerate(schema.fields):
        text = F.get("_parts", F.lit(i))
        kind = field.dataType.simpleString()
        known = (n > i) & (text != NULL_TEXT)
        checks.append(_problem(field.name, "missing", n <= i))
        if kind != "string":
            checks.append(_problem(field.name, f"not a {kind}", known & unescape_tsv(text).try_cast(field.dataType).isNull()))
    return cut.select(*keep, *typed_columns(F.col("_parts"), schema), "line", _found(*checks).alias("problems"))


def check_distance_log(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Lines of the distance service as text columns, with ``line`` and ``problems``.

    Messages (no tab past the start) are a problem of the whole line, an order
    that is missing one of that column. A distance that is no number is none:
    the service writes such for what it does not know, and it is read as 0.
    """
    parts = F.split(F.col(col), TAB, -1)
    text = {name: F.get(parts, F.lit(at)) for name, at in LOG_POSITIONS.items()}
    message = F.coalesce(F.instr(F.col(col), TAB) <= 1, F.lit(True))
    checks = _found(
        _problem("", "message", message),
        _problem(ID, "missing", ~message & (F.coalesce(text[ID], F.lit("")) == "")),
        *[_problem(name, "missing", ~message & value.isNull()) for name, value in text.items() if name != ID],
    )
    return lines.select(*keep, F.col(col).alias("line"), checks.alias("problems"))


def check_tracks(raw: DataFrame, body: str = "body") -> DataFrame:
    """Track replies with ``line`` (the body) and ``problems``: missing, no JSON, without a list of results, or without a fix."""
    reply = F.from_json(F.col(body), TRACK_REPLY)
    text = F.btrim(F.col(body))
    checks = _found(
        _problem("", "missing", F.col(body).isNull()),
        _problem("", "not a JSON object", F.col(body).isNotNull() & (~text.startswith("{") | reply.isNull())),
        _problem("results", "missing", text.startswith("{") & reply.isNotNull() & reply["results"].isNull()),
        _problem("results", "empty", F.size(reply["results"]) == 0),
    )
    return raw.select(ID, body, F.col(body).alias("line"), checks.alias("problems"))


def set_aside(checked: DataFrame, folder: str) -> Checked:
    """Write checked rows once, good and bad apart, and count both in the same run.

    ``good`` under ``folder`` has the rows without problems and without the two
    added columns, ``bad`` has line, problems and the kept columns of the others.
    Use :func:`good_rows` and :func:`bad_rows`. The folder is new with each
    run: a lost run leaves nothing that is read.
    """
    where = f"{folder.rstrip('/')}/checked-{uuid.uuid4().hex}"
    counts = Observation()
    good = F.size("problems") == 0
    rows = checked.withColumn("_good", good).observe(counts, F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"))
    rows.write.partitionBy("_good").parquet(where)
    return Checked(counts.get["good"], counts.get["bad"], where)


def _side(like: DataFrame, done: Checked, good: str) -> DataFrame:
    spark, where = like.sparkSession, f"{done.folder}/_good={good}"
    if not Files(spark, where).exists(where):
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(where)


def good_rows(checked: DataFrame, done: Checked) -> DataFrame:
    """The rows without problems, as they were parsed."""
    return _side(checked, done, "true").drop("line", "problems")


def bad_rows(checked: DataFrame, done: Checked, keep: Sequence[str] = ()) -> DataFrame:
    """One row per problem: ``line``, ``column``, ``reason`` and the columns to ``keep``."""
    rows = _side(checked, done, "false").select(*keep, "line", F.explode("problems").alias("_p"))
    return rows.select(*keep, "line", "_p.column", "_p.reason")
