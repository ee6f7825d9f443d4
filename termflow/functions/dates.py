"""Day arithmetic on epoch seconds and on the job's date bounds."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Bound = date | datetime | str

EPOCH = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
DAY_SECONDS = 86_400


def epoch_seconds(text: str | Column) -> Column:
    """Whole seconds in an epoch string; NULL when it is not a number.

    A decimal fraction is cut off, which is what a lenient string-to-bigint
    cast does; under ANSI rules the cast alone would fail or give NULL.
    """
    return F.regexp_extract(text, EPOCH, 1).try_cast("bigint")


def epoch_day(text: str | Column) -> Column:
    """UTC day of an epoch string, in any session time zone.

    Whole days are counted on decimals, which hold every bigint. NULL for what
    is no bigint, and for the days past year five million that no DATE holds.
    """
    seconds = epoch_seconds(text).cast("decimal(19,0)")
    days = F.floor(seconds / F.lit(DAY_SECONDS).cast("decimal(5,0)"))
    return F.date_from_unix_date(days.try_cast("int"))


def _as_datetime(bound: Bound) -> datetime:
    if isinstance(bound, str):
        bound = datetime.fromisoformat(bound)
    if isinstance(bound, datetime):
        if bound.tzinfo is not None:
            bound = bound.astimezone(timezone.utc).replace(tzinfo=None)
        return bound
    return datetime.combine(bound, time())


def day_bounds(start: Bound, end: Bound) -> tuple[date, date]:
    """First and last day whose midnight lies in ``[start, end]``.

    A start with a time of day excludes its own day (that day's midnight is
    earlier); an end at 00:00 includes its whole day. Being plain dates, the
    bounds fold into a literal comparison that a day-partitioned scan can prune.
    """
    first, last = _as_datetime(start), _as_datetime(end)
    first_day = first.date()
    if first.time() != time():
        first_day += timedelta(days=1)
    return first_day, last.date()
