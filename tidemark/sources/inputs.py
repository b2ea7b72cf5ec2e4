"""Named inputs described by configuration.

One entry describes one input::

    {"name": "orders", "format": "csv", "path": "in/orders.csv",
     "options": {"header": true, "inferSchema": true},
     "schema": "id BIGINT, placed DATE",
     "isCache": true, "persistentLevel": "MEMORY_AND_DISK"}

``name`` may be written ``df_name``, ``options`` may be written ``option`` and
``path`` may be written ``table``. A ``table`` that holds a slash is a path, any
other one is looked up in the catalog first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from ..tables.formats import file_format, location
from ..tables.versions import VersionedTable

Entry = Mapping[str, Any]


def input_name(entry: Entry) -> str:
    name = entry.get("name") or entry.get("df_name")
    if not name:
        raise ValueError(f"Input without a name: {dict(entry)}")
    return name


def _reader(spark: SparkSession, entry: Entry) -> DataFrameReader:
    reader = spark.read.options(**(entry.get("options") or entry.get("option") or {}))
    return reader.schema(entry["schema"]) if entry.get("schema") else reader


def _table(spark: SparkSession, entry: Entry, name: str) -> DataFrame:
    """A table by name. Its options reach the source, for instance those of a
    change feed; the schema is the table's own."""
    return spark.read.options(**(entry.get("options") or entry.get("option") or {})).table(name)


def _read_csv(spark: SparkSession, entry: Entry) -> DataFrame:
    kind, where = location(spark, entry)
    return _table(spark, entry, where) if kind == "table" else _reader(spark, entry).csv(where)


def _read_columnar(spark: SparkSession, entry: Entry) -> DataFrame:
    """A catalog table, a table this package keeps, or a directory of files."""
    kind, where = location(spark, entry)
    if kind == "table":
        return _table(spark, entry, where)
    kept = VersionedTable.at(spark, where)
    if kept is not None:
        return kept.read()
    return _reader(spark, entry).format(file_format(spark, entry["format"])).load(where)


READERS: dict[str, Callable[[SparkSession, Entry], DataFrame]] = {
    "csv": _read_csv,
    "delta": _read_columnar,
    "parquet": _read_columnar,
}


def read_input(spark: SparkSession, entry: Entry) -> DataFrame:
    """One input as a DataFrame, persisted if the entry asks for it.

    An unknown storage level means ``MEMORY_ONLY``.
    """
    reader = READERS.get(entry.get("format"))
    if reader is None:
        raise ValueError(f"Unsupported format: {entry.get('format')}")
    df = reader(spark, entry)
    if entry.get("isCache", False):
        df = df.persist(storage_level(entry.get("persistentLevel", "MEMORY_ONLY")))
    return df


def storage_level(name: str) -> StorageLevel:
    level = getattr(StorageLevel, name, None)
    return level if isinstance(level, StorageLevel) else StorageLevel.MEMORY_ONLY


def load_inputs(spark: SparkSession, entries: Sequence[Entry]) -> dict[str, DataFrame]:
    return {input_name(entry): read_input(spark, entry) for entry in entries}
