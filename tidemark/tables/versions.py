"""Tables that are replaced or extended one whole load at a time.

Load ``n`` writes its files to a directory of its own, ``<root>/tidemark_load=<n>-<mark>/``,
and then a commit file ``<root>/_commits/<n>.json`` that names the directory and
the schema. Readers see committed loads only, so a load that dies half-way
changes nothing and can simply run again, and two loads that run at the same
time do not touch each other's files: the second one to commit fails. Files are
never overwritten. That holds where renaming a file is one step that fails if the
target exists, as on HDFS and local disks; on an object store that copies instead,
loads of one table have to take turns.

A text column that partitions the table is written into the files as well, because
directory names do not keep all text: an empty one reads as NULL, and SQL takes
``007`` for a number.

How loads make up the table:

* ``replace`` - the newest load is the table;
* ``append``  - all loads together are the table;
* ``ledger``  - rows are marked ``is_current``; current rows of the newest load
  and closed rows of all loads are the table. A load therefore writes the open
  rows and what it closed, never the closed rows of earlier loads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import CURRENT
from ..operators.joins import named
from . import files

REPLACE, APPEND, LEDGER = "replace", "append", "ledger"

# Names the table whose commit files count, where that is another one.
_POINTER = "_log"

# Reserved: the directory level of loads, and copies of text partition columns.
LOAD, COPY = "tidemark_load", "tidemark_value_"


class VersionedTable:
    """A table kept in ``root``.

    ``log`` is the table whose commit files count; tables that must change
    together share one. ``part`` is the table's name in them.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        mode: str = REPLACE,
        fmt: str = "parquet",
        log: str | None = None,
        part: str = "table",
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.mode = mode
        self.fmt = fmt
        self.log_root = (log or self.root).rstrip("/")
        self.log = f"{self.log_root}/_commits"
        self.part = part
        self._base: int | None = None

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> VersionedTable | None:
        """The table kept in a directory, if one is."""
        pointer = f"{root.rstrip('/')}/{_POINTER}"
        log = files.read(spark, pointer) if files.exists(spark, pointer) else root
        newest = cls(spark, root, log=log)
        n = newest.version()
        commit = json.loads(files.read(spark, f"{newest.log}/{n}.json")) if n else {}
        for part, info in commit.items():
            if info["root"] == files.absolute(spark, root):
                return cls(spark, root, info["mode"], info["format"], log, part)
        return None

    # -- state --------------------------------------------------------------

    def version(self) -> int:
        """Number of the newest committed load, 0 if there is none."""
        loads = [n.removesuffix(".json") for n in files.names(self.spark, self.log)]
        return max((int(n) for n in loads if n.isdigit()), default=0)

    def begin(self, base: int | None = None) -> int:
        """Start a load: from here on this object sees one state, and its commit
        fails if another load has been committed on top of that."""
        self._base = self.version() if base is None else base
        return self._base

    def _state(self) -> int:
        return self.version() if self._base is None else self._base

    def read(self, load: int | None = None) -> DataFrame | None:
        """The table as of a committed load, the newest unless given."""
        n = load or self._state()
        if load is not None and not self._committed(load):
            raise ValueError(f"{self.root} has no load {load}")
        info = self._info(n)
        if info is None:
            return None
        if self.mode == REPLACE:
            return self._newest(info).drop(LOAD)
        df = self._files(info).where(F.col(LOAD).isin(info["loads"]))
        if self.mode == LEDGER:
            df = df.where((F.col(LOAD) == info["files"]) | ~F.col(CURRENT))
        return df.drop(LOAD)

    def read_open(self) -> DataFrame | None:
        """Current rows of a ledger. Looks into the newest load's directory only,
        however many loads came before."""
        info = self._info(self._state())
        return info and self._newest(info).where(F.col(CURRENT)).drop(LOAD)

    def notes(self) -> dict[str, Any]:
        """Commit entry of the state this object sees."""
        return self._info(self._state()) or {}

    def trim(self, keep: int = 1) -> None:
        """Delete rows that only earlier states of the table show, except the
        ``keep`` newest states. Those earlier states can then no longer be read.

        Run it on each table of a shared log, when no query reads old states.
        """
        if keep < 1:
            raise ValueError("At least the newest state must be kept")
        below = {REPLACE: "", LEDGER: f"/{CURRENT}=true"}.get(self.mode)
        if below is None:
            return
        for n in range(1, self.version() - keep + 1):
            info = self._info(n) if self._committed(n) else None
            if info is None:
                continue
            # First the state, then its rows: an interrupted run leaves no state
            # that can be read in part.
            files.remove(self.spark, f"{self.log}/{n}.json")
            files.remove(self.spark, f"{self.root}/{LOAD}={info['files']}{below}")

    def _committed(self, n: int) -> bool:
        return files.exists(self.spark, f"{self.log}/{n}.json")

    def _info(self, n: int) -> dict[str, Any] | None:
        commit = json.loads(files.read(self.spark, f"{self.log}/{n}.json")) if n else {}
        return commit.get(self.part)

    def _files(self, info: dict, below: str = "") -> DataFrame:
        """Rows with their load. The schema is known, so no file is opened to find
        it, and columns that older files lack are NULL."""
        schema = T.StructType.fromJson(info["schema"])
        stored = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        for c in info["copied"]:
            stored = stored.add(f"{COPY}{c}", T.StringType())
        reader = self.spark.read.format(info["format"]).schema(stored)
        rows = reader.option("basePath", self.root).load(f"{self.root}/{below}")
        values = [
            F.col(f"`{COPY}{c}`").alias(c) if c in info["copied"] else F.col(f"`{c}`")
            for c in schema.names
        ]
        return rows.select(*values, LOAD)

    def _newest(self, info: dict[str, Any]) -> DataFrame:
        return self._files(info, f"{LOAD}={info['files']}")

    def publish(self, name: str) -> None:
        """Make the newest load readable under a name of the catalog.

        The view names each load's directory and the columns its files have, so no
        footers are merged when it is used.
        """
        info = self._info(self.version())
        fields = T.StructType.fromJson(info["schema"]).fields
        root, newest = files.absolute(self.spark, self.root), info["files"]
        shown = [newest] if self.mode == REPLACE else info["loads"]
        rows = []
        for load in shown:
            known = {c.lower() for c in info["columns"].get(load, [])}
            if not known:  # a load without rows may have no file
                continue
            columns = []
            for f in fields:
                source = f"`{COPY}{f.name}`" if f.name in info["copied"] else f"`{f.name}`"
                value = source if f.name.lower() in known else "NULL"
                columns.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
            text = f"SELECT {', '.join(columns)} FROM {info['format']}.`{root}/{LOAD}={load}`"
            if self.mode == LEDGER and load != newest:
                text += f" WHERE NOT CAST({CURRENT} AS BOOLEAN)"
            rows.append(text)
        if not rows:
            blank = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields]
            rows = [f"SELECT {', '.join(blank)} WHERE FALSE"]
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(rows)}")

    # -- change -------------------------------------------------------------

    def write(
        self, df: DataFrame, partition_by: Sequence[str] | None = None, **notes: Any
    ) -> dict[str, Any]:
        """Write the next load's files. Returns its commit entry, with ``notes``;
        nothing is visible before :meth:`commit`."""
        n, before = self._state() + 1, self.notes()
        split = list(partition_by or [])
        if self.mode != REPLACE and split != before.get("partition_by", split):
            raise ValueError(f"Partition columns of {self.root} cannot change")
        reserved = [c for c in df.columns if c.lower().startswith((LOAD, COPY))]
        if reserved:
            raise ValueError(f"Reserved column names: {reserved}")
        schema = self._schema_with(df, before)
        copied = [c for c in split if isinstance(df.schema[c].dataType, T.StringType)]
        columns = list(df.columns)
        if split:
            # Without this each task would write a small file into each partition.
            df = df.hint("rebalance", *named(split))
            df = df.withColumns({f"{COPY}{c}": F.col(f"`{c}`") for c in copied})
        folders = [CURRENT, *split] if self.mode == LEDGER else split
        writer = df.write.format(self.fmt)
        if folders:
            writer = writer.partitionBy(*folders)
        load = f"{n}-{uuid.uuid4().hex[:12]}"
        try:
            writer.save(f"{self.root}/{LOAD}={load}")
        except BaseException:
            files.remove(self.spark, f"{self.root}/{LOAD}={load}")
            raise
        written = files.names(self.spark, f"{self.root}/{LOAD}={load}")
        if all(n.startswith(("_", ".")) for n in written):
            columns = []
        pointer = f"{self.root}/{_POINTER}"
        if self.log_root != self.root and not files.exists(self.spark, pointer):
            files.create(self.spark, pointer, files.absolute(self.spark, self.log_root))
        return {
            "load": n,
            "files": load,
            "loads": [*before.get("loads", []), load],
            "root": files.absolute(self.spark, self.root),
            "mode": self.mode,
            "format": self.fmt,
            "partition_by": split,
            "copied": copied,
            "columns": {**before.get("columns", {}), load: columns},
            "schema": schema.jsonValue(),
            **notes,
        }

    def _schema_with(self, df: DataFrame, before: dict[str, Any]) -> T.StructType:
        """Columns of earlier loads stay readable beside new ones."""
        fields = [T.StructField(f.name, f.dataType) for f in df.schema]
        if self.mode == REPLACE or not before:
            return T.StructType(fields)
        new = {f.name.lower() for f in fields}
        old = T.StructType.fromJson(before["schema"]).fields
        return T.StructType([*fields, *[f for f in old if f.name.lower() not in new]])

    def discard(self, entry: dict[str, Any]) -> None:
        """Delete files written for a load that will not be committed."""
        files.remove(self.spark, f"{self.root}/{LOAD}={entry['files']}")

    def commit(self, entries: dict[str, dict]) -> int:
        """Make the written files of all parts visible in one step."""
        (n,) = {entry["load"] for entry in entries.values()}
        files.create(self.spark, f"{self.log}/{n}.json", json.dumps(entries))
        return n
