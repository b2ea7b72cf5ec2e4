"""Row filters written so that they reach the file scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_day, month_window

Day = str | dt.date | Column


def between_days(df: DataFrame, column: str, first: Column, last: Column) -> DataFrame:
    """Rows of the whole days ``first`` to ``last``; the column is never wrapped.

    A bound is cast to the column's own type, because a function around the
    column would keep the filter from pruning partitions and row groups.
    """
    kind = df.schema[column].dataType
    if kind.typeName() == "date":
        return df.where(F.col(column).between(first, last))
    return df.where(
        (F.col(column) >= first.cast(kind)) & (F.col(column) < F.date_add(last, 1).cast(kind))
    )


def on_day(df: DataFrame, column: str, day: Day) -> DataFrame:
    return between_days(df, column, as_day(day), as_day(day))


def on_previous_day(df: DataFrame, column: str, data_date: Day) -> DataFrame:
    """Rows of the day before ``data_date``."""
    day = month_window(data_date).previous_day
    return between_days(df, column, day, day)


def in_month(df: DataFrame, column: str, data_date: Day) -> DataFrame:
    """Rows of the month that the day before ``data_date`` lies in."""
    window = month_window(data_date)
    return between_days(df, column, window.first_day, window.last_day)


def above_average(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is strictly above the average over the whole table.

    The average is a scalar subquery: one plan, no driver round trip.
    """
    total = F.sum(column).cast("double")
    mean = df.agg((total / F.count(column)).alias("mean")).scalar()
    return df.where(F.col(column).cast("double") > mean)
