"""Checks before a job starts: upstream runs and inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import on_day
from ..sources.inputs import input_name
from ..tables import files
from ..tables.formats import location

RUN_KEY = ("job_name", "data_date")


def expected_runs(jobs: DataFrame, first: Column, last: Column) -> DataFrame:
    """``(job_name, data_date)`` of each job on every day from ``first`` to ``last``,
    both dates; none if the order is reversed or a date is null. ``jobs`` has
    distinct ``job_name``s."""
    days = F.when(first <= last, F.sequence(first, last))
    return jobs.select("job_name", F.explode(days).alias("data_date"))


def logged_span(run_log: DataFrame) -> tuple[Column, Column]:
    """First and last date of a run log, as scalars of the plan that uses them."""
    day = F.col("data_date").cast("date")
    return run_log.agg(F.min(day)).scalar(), run_log.agg(F.max(day)).scalar()


def blocked_dependencies(expected: DataFrame, run_log: DataFrame) -> DataFrame:
    """Expected ``(job_name, data_date)`` runs without a logged success.

    A run that is missing from the log blocks like one that failed.
    """
    done = run_log.where(F.lower("job_state") == "success").select(*RUN_KEY).distinct()
    return expected.select(*RUN_KEY).distinct().join(done, list(RUN_KEY), "left_anti")


def input_readiness(
    inputs: Mapping[str, tuple[DataFrame, str]], data_date: str | dt.date
) -> DataFrame:
    """Rows each input has for a date, and whether that makes it ``ready``.

    ``inputs`` maps a name to a frame and its date or timestamp column.
    """

    def check(name: str, df: DataFrame, column: str) -> DataFrame:
        counted = on_day(df, column, data_date).agg(F.count("*").alias("row_count"))
        return counted.select(
            F.lit(name).alias("input_name"), "row_count", (F.col("row_count") > 0).alias("ready")
        )

    return reduce(DataFrame.unionByName, [check(n, df, c) for n, (df, c) in inputs.items()])


def missing_inputs(spark: SparkSession, entries: Sequence[Mapping[str, Any]]) -> list[str]:
    """Names of configured inputs whose table or path does not exist."""

    def there(entry: Mapping[str, Any]) -> bool:
        kind, where = location(spark, entry)
        return kind == "table" or files.exists(spark, where)

    return [input_name(e) for e in entries if not there(e)]


def require_ready(
    spark: SparkSession,
    config: Mapping[str, Any],
    run_log: DataFrame | None,
    data_date: str,
    skip: bool | str = False,
) -> None:
    """Raise unless every job in ``depend_jobs`` succeeded for the date and every
    configured input exists. ``skip``, also as text, turns the check off."""
    if str(skip).lower() == "true":
        return
    jobs = config.get("depend_jobs") or []
    if jobs:
        if run_log is None:
            raise ValueError("A run log is needed to check depend_jobs")
        kind = run_log.schema["data_date"].dataType
        expected = spark.createDataFrame([(j,) for j in jobs], "job_name string").withColumn(
            "data_date", F.lit(data_date).cast(kind)
        )
        # At most one row per configured job.
        late = [r["job_name"] for r in blocked_dependencies(expected, run_log).collect()]
        if late:
            raise ValueError(f"Jobs not completed successfully for {data_date}: {sorted(late)}")
    missing = missing_inputs(spark, config.get("input") or [])
    if missing:
        raise ValueError(f"Inputs missing: {missing}")
