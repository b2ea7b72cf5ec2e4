"""Outputs described by configuration.

::

    {"dataframe": "totals", "format": "parquet", "path": "out/totals",
     "mode": "overwrite", "partition_by": ["data_date"], "options": {}}

Whatever ``mode`` replaces stays readable until all of the new data is written, by
path or by ``table``. ``overwrite_partitions`` replaces only the partitions that the
data has rows in, so that one date can run again beside the others.

With an ``scd`` section the output is a slowly changing dimension, see
:mod:`tidemark.sinks.scd_store`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession

from ..functions.dates import as_day
from ..operators.joins import named
from ..tables import files
from ..tables.formats import file_format
from .scd_store import write_scd

Entry = Mapping[str, Any]

_LOAD = "tidemark-load-"


def stamp(df: DataFrame, data_date: str | dt.date | None, columns: Sequence[str]) -> DataFrame:
    """Add the date columns the data lacks."""
    if data_date is None:
        return df
    known = {c.lower() for c in df.columns}
    return df.withColumns({c: as_day(data_date) for c in columns if c.lower() not in known})


def _stamped_csv(df: DataFrame, output: Entry, data_date) -> DataFrame:
    return stamp(df, data_date, ["data_date"])


def _stamped_columnar(df: DataFrame, output: Entry, data_date) -> DataFrame:
    scd = output.get("scd") or {}
    columns = scd.get("partition_by") or output.get("partition_by") or []
    return stamp(df, scd.get("data_date", data_date), columns)


# What a format adds to the data before it is written.
WRITERS: dict[str, Callable[..., DataFrame]] = {
    "csv": _stamped_csv,
    "delta": _stamped_columnar,
    "parquet": _stamped_columnar,
}


def write_output(
    spark: SparkSession,
    df: DataFrame,
    output: Entry,
    data_date: str | dt.date | None = None,
    as_of: dt.datetime | Column | None = None,
) -> None:
    prepare = WRITERS.get(output.get("format"))
    if prepare is None:
        raise ValueError(f"Unsupported output format: {output.get('format')}")
    df = prepare(df, output, data_date)
    if output.get("scd"):
        write_scd(spark, df, output["scd"], as_of)
        return
    mode = output.get("mode", "overwrite")
    if mode == "overwrite_partitions":
        _replace_partitions(spark, df, output)
    elif mode == "overwrite" and output.get("table"):
        _replace_table(spark, df, output)
    elif mode == "overwrite":
        _replace(spark, _writer(spark, df, output, mode), output["path"])
    elif output.get("table"):
        _writer(spark, df, output, mode).saveAsTable(output["table"])
    else:
        _writer(spark, df, output, mode).save(output["path"])


def _replace(spark: SparkSession, writer: DataFrameWriter, path: str) -> None:
    """Write beside the old files and swap when all is written, so that a write
    that dies leaves the old ones. A swap that was cut short is made good first."""
    staged = files.beside(path, uuid.uuid4().hex)
    try:
        writer.mode("errorifexists").save(staged)
        files.put_in_place(spark, staged, path)
    finally:
        files.remove(spark, staged)
    spark.catalog.refreshByPath(path)


def _beside(name: str, mark: str) -> str:
    """Name of a table of the same schema as ``name``."""
    return f"{name.removesuffix('`')}__{mark}" + ("`" if name.endswith("`") else "")


def recover_table(spark: SparkSession, name: str) -> None:
    """Finish or take back a swap of ``name`` that was cut short: without a table of
    that name the old one comes back, otherwise it goes."""
    old = _beside(name, "before")
    if not spark.catalog.tableExists(old):
        return
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")


def _replace_table(spark: SparkSession, df: DataFrame, output: Entry) -> None:
    """Write a table beside the old one and let it take the name when it is complete.

    Renaming is all that happens to the old table before that, so a query that fails
    changes nothing, and the new table may have other columns. For the moment
    between two renames there is no table of the name; a driver that dies there
    leaves the old one, which the next write or :func:`recover_table` brings back.
    One writer at a time. An ``options.path`` is a folder of loads: each writes into
    a folder of its own below it, and the folder it replaces goes.
    """
    name, mark = output["table"], uuid.uuid4().hex
    recover_table(spark, name)
    staged, old = _beside(name, mark), _beside(name, "before")
    options = dict(output.get("options") or {})
    base = next((options.pop(k) for k in list(options) if k.lower() == "path"), None)
    if base:
        options["path"] = f"{base.rstrip('/')}/{_LOAD}{mark}"
    try:
        _writer(spark, df, {**output, "options": options}, "errorifexists").saveAsTable(staged)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        if base:
            files.remove(spark, options["path"])
        raise
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except BaseException:
        recover_table(spark, name)
        raise
    recover_table(spark, name)
    if base:
        for load in files.names(spark, base):
            if load.startswith(_LOAD) and load != f"{_LOAD}{mark}":
                files.remove(spark, f"{base.rstrip('/')}/{load}")
    spark.catalog.refreshTable(name)


def _replace_partitions(spark: SparkSession, df: DataFrame, output: Entry) -> None:
    """Replace the partitions that ``df`` has rows in. Spark writes them aside and
    moves them in when the job is complete."""
    if not output.get("partition_by"):
        raise ValueError("overwrite_partitions needs partition_by")
    dynamic = "spark.sql.sources.partitionOverwriteMode"
    name = output.get("table")
    if not name:
        writer = _writer(spark, df, output, "overwrite").option("partitionOverwriteMode", "dynamic")
        writer.save(output["path"])
        spark.catalog.refreshByPath(output["path"])
        return
    recover_table(spark, name)
    if not spark.catalog.tableExists(name):
        _writer(spark, df, output, "errorifexists").saveAsTable(name)
        return
    # Tables take the mode from the session, and columns by place.
    before = spark.conf.get(dynamic)
    spark.conf.set(dynamic, "dynamic")
    try:
        columns = named(spark.table(name).columns)
        df.hint("rebalance", *named(output["partition_by"])).select(*columns).write.mode(
            "overwrite"
        ).insertInto(name)
    finally:
        spark.conf.set(dynamic, before)


def _writer(spark: SparkSession, df: DataFrame, output: Entry, mode: str) -> DataFrameWriter:
    fmt = file_format(spark, output["format"])
    options = dict(output.get("options") or {})
    if fmt == "csv":
        options.setdefault("header", True)
    columns = output.get("partition_by") or []
    if columns:
        # Without this each task would write a small file into each partition.
        df = df.hint("rebalance", *named(columns))
    writer = df.write.format(fmt).options(**options).mode(mode)
    return writer.partitionBy(*columns) if columns else writer
