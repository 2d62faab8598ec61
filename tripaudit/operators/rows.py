"""Latest row per key, duplicate removal, unions and renames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ID = "service_order_id"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = (ID,),
    order: Sequence[str] = ("update_time",),
) -> DataFrame:
    """The newest row per key, by ``order`` descending.

    Pass enough ``order`` columns to break ties, so that a task that is run
    again picks the same row. Spark plans a group limit before the exchange:
    each map task sends at most one row per key, however often the key occurs.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedupe(
    df: DataFrame,
    keys: Sequence[str] = (ID, "update_time"),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key.

    Which row survives is open by definition; all other columns (or
    ``tiebreak``) are compared so that the choice is the same on every run.
    """
    rest = tiebreak or [c for c in df.columns if c not in keys] or list(keys)
    return latest_per_key(df, keys, rest)


def append_rows(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rename_cols(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
