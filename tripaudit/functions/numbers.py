"""Rates, rounding, right-closed bins and great-circle distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def km(metres: Column) -> Column:
    """Metres to kilometres with one decimal, half up."""
    return F.round(metres / 1000, 1)


def per_mille(part: Column, total: Column) -> Column:
    """``round(part / total, 4) * 1000``, half even; NULL when total is 0."""
    return F.bround(F.try_divide(part, total), 4) * 1000


def percent_of(part: Column, whole: Column) -> Column:
    """Whole percent, half up; NULL when ``whole`` is 0."""
    return F.round(F.try_divide(100 * part, whole), 0)


def percent_text(percent: Column) -> Column:
    """``57.0`` to ``'57.0%'``."""
    return F.concat(percent.cast("string"), F.lit("%"))


def safe_double(text: Column, default: float | None = None) -> Column:
    value = text.try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def safe_long(text: Column, default: int | None = None) -> Column:
    value = text.try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def digits_or_zero(text: Column) -> Column:
    """Unsigned digit strings to a number, anything else to 0."""
    return F.when(text.rlike("^[0-9]+$"), safe_long(text, 0)).otherwise(F.lit(0).cast("bigint"))


def right_closed_bin(value: Column, edges: Sequence[float]) -> Column:
    """Ordinal of the interval ``(edges[i], edges[i+1]]`` holding ``value``.

    The lowest edge is outside; values outside all intervals give NULL.
    """
    out = F.when(value <= edges[0], F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        out = out.when(value <= upper, F.lit(i))
    return out


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres between points given in degrees."""
    rlat1, rlat2 = F.radians(lat1), F.radians(lat2)
    half_dlat = (rlat2 - rlat1) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.pow(F.sin(half_dlat), 2) + F.cos(rlat1) * F.cos(rlat2) * F.pow(F.sin(half_dlon), 2)
    return 2 * F.asin(F.sqrt(h)) * EARTH_RADIUS_KM * 1000
