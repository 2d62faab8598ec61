"""Joins between orders, extension rows, devices, logs, lists and labels.

Hot keys. A plain sort-merge join of two scans is split by AQE when one side
of a partition is far above the others, but AQE only looks at joins whose
inputs are bare exchanges. A side that was just deduplicated on the join key
is not one. The membership operators therefore salt: rows of the large side
are spread over ``salts`` buckets and the (deduplicated) list is repeated once
per bucket. That splits a hot key by itself and puts an exchange under both
sides, so AQE can split the remainder further.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions import times
from tripaudit.functions.text import json_distance
from tripaudit.operators.filters import active_devices, driver_devices, finished_orders, versioned
from tripaudit.operators.rows import ID, latest_per_key

SALTS = 8
SPREAD = ("update_time",)
SIEVE_BITS = 1 << 26


def salted_join(
    df: DataFrame, side: DataFrame, on: Sequence[str], how: str, salts: int = SALTS, spread: Sequence[str] = SPREAD
) -> DataFrame:
    """Join ``df`` with a smaller ``side`` that is unique on ``on``.

    ``salts=1`` is the plain join, right where ``df`` has few rows per key.
    ``spread`` names a few narrow columns of ``df`` that tell the rows of a key
    apart; only they and the keys are read for the salt, which is the same
    when a task runs again.
    """
    if salts == 1:
        return df.join(side, list(on), how)
    salt = F.pmod(F.xxhash64(*on, *spread), F.lit(salts)).cast("int")
    left = df.withColumn("_salt", salt)
    # Spark does not see that the side becomes ``salts`` times as large, and would broadcast all of it.
    right = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def _key_list(ids: DataFrame, key: str) -> DataFrame:
    return ids.select(key).where(F.col(key).isNotNull()).distinct()


def flag_members(
    df: DataFrame,
    ids: DataFrame,
    key: str = ID,
    name: str = "is_rc",
    salts: int = SALTS,
    spread: Sequence[str] = SPREAD,
) -> DataFrame:
    """Add boolean ``name``: is the key of the row in ``ids``?"""
    listed = _key_list(ids, key).withColumn("_listed", F.lit(True))
    joined = salted_join(df, listed, [key], "left", salts, spread)
    return joined.withColumn(name, F.col("_listed").isNotNull()).drop("_listed")


def only_in(
    df: DataFrame, ids: DataFrame, key: str = ID, salts: int = SALTS, spread: Sequence[str] = SPREAD
) -> DataFrame:
    return salted_join(df, _key_list(ids, key), [key], "left_semi", salts, spread)


def not_in(
    df: DataFrame, ids: DataFrame, key: str = ID, salts: int = SALTS, spread: Sequence[str] = SPREAD
) -> DataFrame:
    return salted_join(df, _key_list(ids, key), [key], "left_anti", salts, spread)


def sieve(df: DataFrame, ids: DataFrame, key: str = ID) -> DataFrame:
    """``df`` without nearly all rows whose key is not in ``ids``, ahead of any exchange.

    For a join of a large table with few keys, which has to follow: a key that
    shares its hash with a listed one stays, a listed one always does. The keys
    are broadcast as bits in at most ``SIEVE_BITS / 64`` rows, however many
    they are; with very many of them less is dropped. Keys of two types hash
    differently, so ``df`` is then returned as it is.
    """
    if df.schema[key].dataType != ids.schema[key].dataType:
        return df
    place = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    bits = ids.select(place.alias("_place")).selectExpr("_place div 64 as _word", "shiftleft(1L, int(_place % 64)) as _bit")
    words = bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    here = (place / 64).cast("bigint") == F.col("_word")
    return df.join(F.broadcast(words), here & (F.getbit("_bits", (place % 64).cast("int")) == 1), "left_semi")


def distinct_versions(ext: DataFrame) -> DataFrame:
    """Distinct ``(order, app version)`` pairs."""
    return ext.select(ID, "driver_version").distinct()


def attach_versions(orders: DataFrame, ext: DataFrame) -> DataFrame:
    """Orders with their app versions.

    An order with two versions comes out twice; orders without any get NULL,
    which :func:`~tripaudit.operators.filters.valid_trips` drops again (Spark
    then runs the join as an inner one). The distinct is on both columns and
    the join on one, so both join inputs are bare exchanges and AQE can split
    a hot order.
    """
    return orders.join(distinct_versions(ext), ID, "left")


EXT_COLUMNS = (ID, "driver_version", "runtime", "predict_distance")


def latest_ext_rows(ext: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The columns of extension rows that are used, and those that order them."""
    slim = ext.withColumn("predict_distance", json_distance(F.col("estimate_snap")))
    return slim.select(*dict.fromkeys([*EXT_COLUMNS, "update_time", *tiebreak]))


def latest_ext(ext: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest extension row per order with the predicted distance in metres.

    The distance is taken out of its JSON text first, so that a number and not
    the whole text is sorted and shuffled.
    """
    order = ["update_time", *tiebreak]
    return latest_per_key(latest_ext_rows(ext, tiebreak), [ID], order).select(*EXT_COLUMNS)


def join_latest_ext(orders: DataFrame, latest: DataFrame, salts: int = SALTS) -> DataFrame:
    """Inner join of orders with :func:`latest_ext`.

    ``latest`` has four narrow columns; repeating it costs less than a hot
    order in one task, and what is left of one is up to AQE.
    """
    return salted_join(orders, latest, [ID], "inner", salts)


def valid_with_latest_ext(orders: DataFrame, latest: DataFrame) -> DataFrame:
    return join_latest_ext(finished_orders(orders), versioned(latest))


DEVICE_COLUMNS = ("os_type", "os_version", "os_name", "device_type", "app_version")


def latest_device(devices: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest active device row per user."""
    return latest_per_key(active_devices(devices), ["user_id"], ["update_time", *tiebreak])


def attach_device(df: DataFrame, devices: DataFrame) -> DataFrame:
    """Left join device columns on the driver id, compared as text.

    ``devices`` has one row per user and all of ``DEVICE_COLUMNS``. Grouping devices by the numeric id and
    joining on its text leaves an exchange under both sides, so a driver with
    very many trips can be split by AQE; small device lists are broadcast by
    Spark itself when their size allows it.
    """
    side = driver_devices(devices).select(
        F.col("user_id").cast("string").alias("driver_id"),
        *DEVICE_COLUMNS,
        F.col("update_time").alias("device_update"),
    )
    return df.withColumn("driver_id", F.col("driver_id").cast("string")).join(side, "driver_id", "left")


LOG_COLUMNS = ("r_yy_dis", "r_sys_dis", "driver_dis", "response_dis", "is_enable")


def attach_distance_log(df: DataFrame, log: DataFrame, salts: int = 1) -> DataFrame:
    """Left join distance-service columns on (Shanghai day of end, order id).

    Deviation from the source system: log rows are deduplicated, so repeated
    log rows do not repeat orders. Ids are compared as text, the type they have
    in the log. Suspects have one row per order; for a frame with hot orders
    raise ``salts`` (see :func:`salted_join`).
    """
    keys = ["log_day", ID]
    unique = latest_per_key(log.select(*keys, *LOG_COLUMNS), keys, LOG_COLUMNS)
    keyed = df.withColumns(
        {ID: F.col(ID).cast("string"), "log_day": times.epoch_day(F.col("end_time"))}
    )
    return salted_join(keyed, unique, keys, "left", salts).drop("log_day")


def map_label(df: DataFrame, labels: DataFrame, col: str = "city", out: str = "label") -> DataFrame:
    """Label of a code, or the code itself where there is none.

    ``labels`` (``code``, ``label``) has one row per code.
    """
    side = labels.select(F.col("code").alias(col), F.col("label").alias("_label"))
    return df.join(side, col, "left").withColumn(out, F.coalesce("_label", col)).drop("_label")
