"""Epoch seconds and Asia/Shanghai calendar days.

Shanghai has kept UTC+8 without daylight saving since 1991, so the zone is a
fixed offset here. That keeps every expression independent of the session
time zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SHANGHAI_OFFSET = 8 * 3600
DAY = 86400
EPOCH = date(1970, 1, 1)
# Local midnight of 0001-01-01 and the last local second of 9999.
EPOCH_RANGE = (-62135596800 - SHANGHAI_OFFSET, 253402300799 - SHANGHAI_OFFSET)


def parse_day(day: int | str) -> date:
    return datetime.strptime(str(day), "%Y%m%d").date()


def day_int(day: date) -> int:
    return int(day.strftime("%Y%m%d"))


def shift_day(day: int | str, days: int) -> int:
    return day_int(parse_day(day) + timedelta(days=days))


def last_days(day: int | str, n: int = 10) -> list[int]:
    """The ``n`` days ending with ``day``, oldest first."""
    return [shift_day(day, i - n + 1) for i in range(n)]


def days_between(first: int | str, last: int | str) -> list[int]:
    n = (parse_day(last) - parse_day(first)).days + 1
    return last_days(last, n) if n > 0 else []


def day_bounds(first: int | str, last: int | str | None = None) -> tuple[int, int]:
    """Epoch seconds of 00:00:00 on ``first`` and 23:59:59 on ``last``."""
    last = first if last is None else last

    def midnight(day: int | str) -> int:
        return (parse_day(day) - EPOCH).days * DAY - SHANGHAI_OFFSET

    return midnight(first), midnight(last) + DAY - 1


def local_date(epoch: Column) -> Column:
    return F.date_from_unix_date(F.floor((epoch + SHANGHAI_OFFSET) / DAY).cast("int"))


def epoch_day(epoch: Column) -> Column:
    """Shanghai day of an epoch second as a ``yyyymmdd`` int."""
    d = local_date(epoch)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def epoch_hour(epoch: Column) -> Column:
    """Shanghai hour of day, 0..23."""
    return F.pmod(F.floor((epoch + SHANGHAI_OFFSET) / 3600), F.lit(24)).cast("int")


def epoch_text(epoch: Column) -> Column:
    """Shanghai ``yyyy-MM-dd HH:mm:ss``.

    NULL, 0, unparsable values and years outside 1..9999 give ``''``.
    """
    seconds = epoch.try_cast("bigint")
    known = (seconds != 0) & seconds.between(*EPOCH_RANGE)
    stamp = F.timestamp_add(
        "SECOND", seconds + SHANGHAI_OFFSET, F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    )
    return F.when(known, stamp.cast("string")).otherwise("")


def dash_date(day: Column) -> Column:
    """``20170329`` to ``2017-03-29``."""
    text = day.cast("string")
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))


def day_window(day: Column, n: int = 10) -> Column:
    """Array of the ``n`` days (``yyyymmdd`` ints) ending with ``day``."""
    end = F.to_date(dash_date(day))
    return F.transform(
        F.sequence(F.date_sub(end, n - 1), end),
        lambda d: (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int"),
    )


def minutes_between(start: Column, end: Column) -> Column:
    return (end - start) / 60
