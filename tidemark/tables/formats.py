"""Where an input or output lies, and in which file format."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession


def location(spark: SparkSession, entry: Mapping[str, Any]) -> tuple[str, str]:
    """``("table", name)`` or ``("path", path)`` of a configured input.

    A ``table`` with a slash in it is a path; any other one is looked up in the
    catalog first.
    """
    if entry.get("path"):
        return "path", entry["path"]
    name = entry.get("table")
    if not name:
        raise ValueError(f"Neither 'path' nor 'table' given: {dict(entry)}")
    if "/" not in name and spark.catalog.tableExists(name):
        return "table", name
    return "path", name


def file_format(spark: SparkSession, fmt: str) -> str:
    """Delta where Spark was started with it, Parquet in its place otherwise."""
    extensions = spark.conf.get("spark.sql.extensions", None) or ""
    return "parquet" if fmt == "delta" and "delta" not in extensions.lower() else fmt
