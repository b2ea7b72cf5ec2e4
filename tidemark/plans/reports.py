"""The reports as jobs: configured inputs, one report, configured output."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from .monthly import monthly_customer_report
from .orders import (
    customers_in_cities,
    customers_with_orders,
    orders_in_value_range,
    products_above_average,
)
from .runner import Frames, run

# Each takes the frames by name and the data date.
REPORTS: dict[str, Callable[[Frames, Any], DataFrame]] = {
    "customers_with_orders": lambda frames, day: customers_with_orders(frames),
    "orders_in_value_range": lambda frames, day: orders_in_value_range(frames),
    "customers_in_cities": lambda frames, day: customers_in_cities(frames),
    "products_above_average": lambda frames, day: products_above_average(frames),
    "monthly_customer_report": monthly_customer_report,
}


def run_report(
    spark: SparkSession,
    name: str,
    config: Mapping[str, Any] | str | Path,
    data_date: str | dt.date,
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """Run one report on the inputs its configuration names, and write it where
    the configuration has an output."""
    if name not in REPORTS:
        raise ValueError(f"Unknown report {name!r}; known: {sorted(REPORTS)}")
    report = REPORTS[name]
    return run(spark, config, data_date, lambda frames: report(frames, data_date), as_of)
