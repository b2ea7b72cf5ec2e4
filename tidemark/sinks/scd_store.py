"""Loads into stored slowly changing dimensions.

::

    {"type": "scd2", "primary_keys": ["id"], "path": "out/customer",
     "partition_by": ["data_date"], "hash": "exact",
     "insert_new": true, "expire_missing": false, "stage_source": false}

Type 4 has ``"path": {"current": ..., "history": ...}`` and ``seed_history``.
``small_load`` says that loads are tiny beside the stored rows: types 1 and 2 then
compare them by joins that can broadcast the load, which reads the stored rows
twice but does not shuffle them. The rows are the same either way.
With ``table`` the result is also a view of that name (type 4: two names).

What a load finds out about itself, it finds out in its own job: the shuffle that
brings keys together also shows whether one occurs twice, and the rows it opens or
closes are counted while they are written. A load of type 2 or 4 that changes nothing
commits nothing.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import scd as ops
from ..operators.changes import (
    AUDIT,
    CHANGE_TYPE,
    COMMIT_VERSION,
    CURRENT,
    END,
    HASH,
    INSERT,
    NEW,
    NO_ORDER,
    POSTIMAGE,
    SHARED_KEY,
    STATE,
    attribute_fields,
    feed_states,
    gone,
    passed_images,
    require_columns,
    require_unique,
    unkeyed,
    with_replacement,
)
from ..operators.joins import named
from ..operators.scd import MOVED, TARGET
from ..tables import APPEND, LEDGER, REPLACE, VersionedTable, files

Conf = Mapping[str, Any]

logger = logging.getLogger(__name__)


def write_scd(
    spark: SparkSession, df: DataFrame, conf: Conf, as_of: dt.datetime | Column | None = None
) -> int:
    """Apply one load and return its number, that of the load before if nothing
    changed. ``as_of`` is one instant for the whole load, now unless given. Several
    source rows with one key are an error, and nothing is committed."""
    load = _LOADS.get(conf.get("type", "scd2"))
    if load is None:
        raise ValueError(f"Unsupported SCD type: {conf.get('type')}")
    keys = conf.get("primary_keys")
    if not keys:
        raise ValueError("An SCD output needs primary_keys")
    require_columns(df, keys)
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of or dt.datetime.now())
    if not conf.get("stage_source", conf.get("small_load", False)):
        return _checked(load, spark, df, conf, keys, moment)
    # A small load stands in several joins. Writing it out once keeps its query from
    # running again for each, and gives all of them the same rows.
    staged = files.scratch_dir(spark)
    try:
        df.write.parquet(f"{staged}/source")
        source = spark.read.schema(df.schema).parquet(f"{staged}/source")
        return _checked(load, spark, source, conf, keys, moment)
    finally:
        files.remove(spark, staged)


def _checked(load, spark, source: DataFrame, conf: Conf, keys: list[str], as_of: Column) -> int:
    with _plain_errors():
        number = load(spark, source, conf, keys, as_of)
    where = conf.get("path") or conf.get("table")
    logger.info("Load %d of %s (%s)", number, where, conf.get("type", "scd2"))
    return number


@contextlib.contextmanager
def _plain_errors() -> Iterator[None]:
    """What a job finds wrong with its input is the caller's error."""
    try:
        yield
    except PySparkException as error:
        found = re.search(rf"({SHARED_KEY}|{NO_ORDER}), for example \{{.*\}}", str(error))
        if found is None:
            raise
        raise ValueError(found[0]) from error


def _moved(df: DataFrame) -> tuple[DataFrame, Callable[[], bool]]:
    """The rows, and, once they are written, whether the load made any of them."""
    seen = Observation()
    counted = df.observe(seen, F.count_if(MOVED).alias("moved"))
    return counted, lambda: seen.get.get("moved", 1) > 0


def _same(stored: DataFrame, columns: Iterable[str]) -> bool:
    """Whether a load has no column that the stored rows lack."""
    return {c.lower() for c in columns} <= {c.lower() for c in stored.columns}


def _paths(spark: SparkSession, conf: Conf) -> Any:
    if conf.get("path"):
        return conf["path"]
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    name = conf.get("table")
    if isinstance(name, Mapping):
        return {k: f"{base}/_scd/{v}" for k, v in name.items()}
    if not name:
        raise ValueError("An SCD output needs a path or a table")
    return f"{base}/_scd/{name}"


def _options(conf: Conf, *extra: str) -> dict[str, Any]:
    options = {k: conf[k] for k in ("hash", *extra) if k in conf}
    return {**options, "ignore": conf.get("partition_by", [])}


def _basis(source: DataFrame, conf: Conf) -> list[Any]:
    """What ``hash_data`` is taken over."""
    fields = attribute_fields(source, conf["primary_keys"], conf.get("partition_by", []))
    return [conf.get("hash", "exact"), sorted(f.name.lower() for f in fields)]


def _comparable(stored: DataFrame | None, table: VersionedTable, source: DataFrame, conf: Conf):
    """Stored rows, without their hashes if these were taken over something else."""
    if stored is None or table.notes().get("hashed") == _basis(source, conf):
        return stored
    return stored.drop(HASH)


def _finish(table: VersionedTable, entry: dict[str, Any], conf: Conf) -> int:
    number = table.commit({table.part: entry})
    if conf.get("table"):
        table.publish(conf["table"])
    return number


def _load_scd1(spark, source: DataFrame, conf: Conf, keys: list[str], as_of: Column) -> int:
    table = VersionedTable(spark, _paths(spark, conf), REPLACE, _format(conf))
    table.begin()
    null_safe, small = conf.get("null_safe_keys", False), conf.get("small_load", False)
    merged = ops.scd1_merge(table.read(), source, keys, null_safe, small, unique=True)
    return _finish(table, table.write(merged, conf.get("partition_by")), conf)


def _load_scd2(spark, source: DataFrame, conf: Conf, keys: list[str], as_of: Column) -> int:
    table = VersionedTable(spark, _paths(spark, conf), LEDGER, _format(conf))
    before, basis, split = table.begin(), _basis(source, conf), conf.get("partition_by")
    null_safe = conf.get("null_safe_keys", False)
    stored = table.read_open()
    if stored is None:
        first = require_unique(source, keys, null_safe)
        load = ops.scd2_init(first, keys, as_of, **_options(conf))
        return _finish(table, table.write(load, split, hashed=basis), conf)
    options = _options(conf, "insert_new", "expire_missing")
    options |= {"null_safe": null_safe, "small": conf.get("small_load", False)}
    opened = _comparable(stored, table, source, conf)
    step = ops.scd2_step(opened, source, keys, as_of, **options, unique=True, flag=True)
    load, moved = _moved(step)
    entry = table.write(load.drop(MOVED), split, hashed=basis)
    if not moved() and _same(stored, load.drop(MOVED).columns):
        table.discard(entry)
        return before
    return _finish(table, entry, conf)


def _load_scd4(spark, source: DataFrame, conf: Conf, keys: list[str], as_of: Column) -> int:
    pair, options = _Pair(spark, conf, source), _options(conf)
    null_safe = conf.get("null_safe_keys", False)
    stored = pair.current.read()
    # One comparison for both tables: its rows are stored once and dealt to them.
    staged = files.scratch_dir(spark)
    try:
        if stored is None:
            first = require_unique(source, keys, null_safe)
            state = _staged(spark, ops.scd4_init(first, keys, as_of, **options), staged)
            return pair.commit(state, state if conf.get("seed_history", True) else state.limit(0))
        before = _comparable(stored, pair.current, source, conf)
        step = ops.scd4_step(before, source, keys, as_of, **options, null_safe=null_safe, unique=True)
        counted, moved = _moved(step)
        rows = _staged(spark, counted, staged, TARGET)
        if not moved() and _same(stored, source.columns):
            return pair.number
        audit = [c for c in AUDIT if c != CURRENT]
        columns = {
            "current": [*[c for c in source.columns if c not in AUDIT], *audit],
            "history": [c for c in rows.columns if c not in (TARGET, MOVED)],
        }
        return pair.commit(
            *[rows.where(F.col(TARGET) == t).select(*named(c)) for t, c in columns.items()]
        )
    finally:
        files.remove(spark, staged)


def _staged(spark: SparkSession, df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_feed(
    spark: SparkSession, feed: DataFrame, conf: Conf, as_of: dt.datetime | Column | None = None
) -> int:
    """Apply a change feed to a stored type 4 dimension and return the load's
    number. The first feed sets the dimension up from its new images.

    ``version`` in ``conf`` names the column that orders a key's changes, by default
    ``_commit_version`` if the feed has it. Of several new images of a key the last
    one is current; the others go to the history with the stored row they replace,
    whether or not the feed gives that row's old image. Several new images of a key
    without an order are an error. The feed is read several times, so it should be
    stored or cheap.
    """
    keys, version = conf["primary_keys"], conf.get("version")
    require_columns(feed, keys)
    ordering = version or COMMIT_VERSION
    data = feed.drop(ordering)
    pair = _Pair(spark, conf, data)
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of or dt.datetime.now())
    null_safe, options = conf.get("null_safe_keys", False), _options(conf)
    new_image = F.col(CHANGE_TYPE).isin(INSERT, POSTIMAGE)
    states = feed_states(feed, keys, null_safe, version)
    images = states.where(F.col(STATE).isNotNull()).select(f"{STATE}.*")
    loose = feed.where(new_image & unkeyed(keys, null_safe)).drop(CHANGE_TYPE, ordering)
    images = images.drop(ordering).unionByName(loose)
    opened = ops.scd4_init(images, keys, moment, **options)
    passed = passed_images(feed, states, keys, null_safe, version).drop(ordering)
    passed = ops.scd4_init(passed, keys, moment, **options).withColumn(END, moment)
    before = pair.current.read()
    with _plain_errors():
        if before is None:
            seed = opened if conf.get("seed_history", True) else opened.limit(0)
            return pair.commit(opened, seed.unionByName(passed))
        touched = data.select(*named(keys)).distinct()
        met = with_replacement(before, touched, keys, keys, null_safe)
        closed = met.where(~gone()).drop(NEW).withColumn(END, moment)
        state = met.where(gone()).drop(NEW).unionByName(opened, allowMissingColumns=True)
        return pair.commit(state, closed.unionByName(passed, allowMissingColumns=True))


class _Pair:
    """The two tables of a type 4 dimension. One commit file covers both, so they
    change together."""

    def __init__(self, spark: SparkSession, conf: Conf, source: DataFrame):
        paths = _paths(spark, conf)
        if not isinstance(paths, Mapping) or not {"current", "history"} <= paths.keys():
            raise ValueError("SCD type 4 needs a current and a history location")
        self.conf, self.source, now = conf, source, paths["current"]
        self.current = VersionedTable(spark, now, REPLACE, _format(conf), part="current")
        self.history = VersionedTable(
            spark, paths["history"], APPEND, _format(conf), log=now, part="history"
        )
        self.number = self.current.begin()
        self.history.begin(self.number)

    def commit(self, state: DataFrame, archive: DataFrame) -> int:
        split, names = self.conf.get("partition_by"), self.conf.get("table")
        basis = _basis(self.source, self.conf)
        number = self.current.commit(
            {
                "history": self.history.write(archive, split),
                "current": self.current.write(state, split, hashed=basis),
            }
        )
        if names:
            self.current.publish(names["current"])
            self.history.publish(names["history"])
        return number


def read_history(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame | None:
    """The history table that belongs to a stored type 4 dimension."""
    return VersionedTable(
        spark, paths["history"], APPEND, log=paths["current"], part="history"
    ).read()


def _format(conf: Conf) -> str:
    """Loads read back what earlier loads wrote, so the files must keep types."""
    fmt = conf.get("format", "parquet")
    if fmt not in ("delta", "parquet", "orc"):
        raise ValueError(f"Unsupported SCD storage format: {fmt}")
    return "parquet" if fmt == "delta" else fmt


_LOADS: dict[str, Callable[..., int]] = {
    "scd1": _load_scd1,
    "scd2": _load_scd2,
    "scd4": _load_scd4,
}
