"""Dates derived from the day a job runs for.

All of these are foldable expressions: with a literal day Catalyst turns them
into constants, so a comparison with a bare column reaches the file scan.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class MonthWindow(NamedTuple):
    """The day before a data date, and the month that day lies in."""

    previous_day: Column
    first_day: Column
    last_day: Column


def as_day(data_date: str | dt.date | Column) -> Column:
    """A date column from ``yyyy-MM-dd`` text, a date or a column."""
    if isinstance(data_date, str):
        return F.to_date(F.lit(data_date), "yyyy-MM-dd")
    if isinstance(data_date, Column):
        return data_date.cast("date")
    return F.lit(data_date).cast("date")


def month_window(data_date: str | dt.date | Column) -> MonthWindow:
    previous = F.date_sub(as_day(data_date), 1)
    return MonthWindow(previous, F.trunc(previous, "month").cast("date"), F.last_day(previous))


def month_bounds(day: Column) -> list[Column]:
    """``previous_day``, ``month_start`` and ``month_end`` of each row's day."""
    window = month_window(day)
    return [
        window.previous_day.alias("previous_day"),
        window.first_day.alias("month_start"),
        window.last_day.alias("month_end"),
    ]
