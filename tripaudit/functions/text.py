"""Version labels, test-passenger check and the JSON price estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: marks orders placed by testers.
TEST_MARK = "测试"

# Fixed value: how the Hive text format writes NULL.
NULL_TEXT = "\\N"


def is_test_passenger(name: Column) -> Column:
    return name.like(f"%{TEST_MARK}%")


def version_label(version: Column) -> Column:
    """``<app>_1`` to ``And<app>``, ``<app>_2`` to ``iOS<app>``, else ``other``.

    Only the first two ``_``-separated parts count.
    """
    app = F.split_part(version, F.lit("_"), F.lit(1))
    system = F.split_part(version, F.lit("_"), F.lit(2))
    return (
        F.when(system == "1", F.concat(F.lit("And"), app))
        .when(system == "2", F.concat(F.lit("iOS"), app))
        .otherwise(F.lit("other"))
    )


def json_distance(snap: Column) -> Column:
    """``$.distance`` of a JSON text as int; malformed text gives NULL."""
    return F.get_json_object(snap, "$.distance").try_cast("double").try_cast("int")


def day_prefix(dt: Column, day: int | str) -> Column:
    """``dt like '<day>%'``. On a partition column prefer equality, which prunes."""
    return dt.cast("string").startswith(str(day))


# Characters that the Hive text format escapes by a backslash.
TSV_ESCAPES = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r"}


def escape_tsv(text: Column) -> Column:
    for plain, escaped in TSV_ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def _replacing(old: str, new: str):
    return lambda text: F.replace(text, F.lit(old), F.lit(new))


def unescape_tsv(text: Column) -> Column:
    """Undo :func:`escape_tsv`; other backslashes stay as they are."""
    parts = F.split(text, "\\\\\\\\", -1)  # at escaped backslashes
    for plain, escaped in list(TSV_ESCAPES.items())[1:]:
        parts = F.transform(parts, _replacing(escaped, plain))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)
