"""Dates, calendar parts and time of day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..config import TERMINATION_SENTINEL
from .text import unquote

# First and last moment of a nanosecond timestamp; anything outside is no date.
_FIRST, _LAST = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"


def ntz(value: dt.datetime | str) -> Column:
    """Literal timestamp without zone, whatever the session time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def timestamp_of(bare: Column, formats: Sequence[str] = ()) -> Column:
    """ISO date or timestamp of an unquoted text, NULL for anything else (years and times alone too).

    ``formats`` names further patterns, such as ``MM/dd/yyyy``, to try in order.
    """
    iso = F.when(F.substring(bare, 5, 1) == "-", bare.try_cast("timestamp_ntz"))
    others = [F.try_to_timestamp(bare, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(iso, *others) if others else iso


def in_range(moment: Column) -> Column:
    return F.when(moment.between(ntz(_FIRST), ntz(_LAST)), moment)


def clean_timestamp(text: Column, formats: Sequence[str] = ()) -> Column:
    return in_range(timestamp_of(unquote(text), formats))


def clean_date(text: Column, formats: Sequence[str] = ()) -> Column:
    return clean_timestamp(text, formats).cast("date")


def clean_date_with_sentinel(text: Column, sentinel: dt.date = TERMINATION_SENTINEL) -> Column:
    return F.coalesce(clean_date(text), F.lit(sentinel))


def active_at(end: Column, sentinel: dt.date = TERMINATION_SENTINEL) -> Column:
    """1 when the end is missing or is the sentinel itself, else 0."""
    never = ntz(f"{sentinel} 00:00:00")
    return (F.coalesce(end, never) == never).cast("int")


def is_active_flag(text: Column, sentinel: dt.date = TERMINATION_SENTINEL) -> Column:
    return active_at(clean_timestamp(text), sentinel)


def calendar_parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "week": F.weekofyear(date),
        "quarter": F.quarter(date),
    }


def _midnight(moment: Column) -> Column:
    return moment.cast("date").cast("timestamp_ntz")


def time_of_day(moment: Column) -> Column:
    """Time since midnight of a timestamp without zone, as an interval, exact to the microsecond."""
    return moment - _midnight(moment)


def clock_time(clock: Column) -> Column:
    """Time since midnight of a text such as ``09:00:00``."""
    return F.concat(F.lit("1970-01-01 "), clock).try_cast("timestamp_ntz") - ntz("1970-01-01 00:00:00")


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def shift_clock(time: Column, by_minutes: int) -> Column:
    """Move a time of day, wrapping at midnight."""
    moved, day, zero = time + minutes(by_minutes), F.make_dt_interval(days=F.lit(1)), minutes(0)
    return F.when(moved >= day, moved - day).when(moved < zero, moved + day).otherwise(moved)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)
