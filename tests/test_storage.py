from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import change_feed
from tidemark.sinks import read_history, stamp, write_feed, write_output, write_scd
from tidemark.sources import load_inputs, read_input
from tidemark.tables import VersionedTable, files

T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
SCHEMA = "id int, name string"


def frame(spark, *records, schema=SCHEMA):
    return spark.createDataFrame(list(records), schema)


def stored(spark, path):
    return read_input(spark, {"format": "delta", "path": str(path)})


# -- slowly changing dimensions -------------------------------------------------


def test_scd1_loads(spark, tmp_path):
    conf = {"type": "scd1", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    assert write_scd(spark, frame(spark, (1, "a"), (2, "b")), conf) == 1
    assert write_scd(spark, frame(spark, (2, "B"), (3, "c")), conf) == 2
    assert rows(stored(spark, tmp_path / "t")) == [(1, "a"), (2, "B"), (3, "c")]


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_odd_column_names(spark, tmp_path, kind):
    conf = {"type": kind, "path": str(tmp_path / "t"), "primary_keys": ["the.key"], "table": "odd_dim"}
    wide = frame(spark, (1, "a"), (2, "b")).toDF("the.key", "a name")
    for moment in (T1, T2):
        write_scd(spark, wide, conf, moment)
    table = stored(spark, tmp_path / "t")
    assert rows(table, "`the.key`", "`a name`") == [(1, "a"), (2, "b")]
    assert spark.table("odd_dim").count() == 2
    spark.sql("DROP VIEW odd_dim")


def test_scd1_grows_a_column(spark, tmp_path):
    conf = {"type": "scd1", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a")), conf)
    write_scd(spark, frame(spark, (2, 5), schema="id int, n int"), conf)
    assert rows(stored(spark, tmp_path / "t")) == [(1, "a", None), (2, None, 5)]


@pytest.mark.parametrize("partition_by", [None, ["data_date"]])
@pytest.mark.parametrize("fmt", ["delta", "parquet", "orc"])
def test_scd2_loads(spark, tmp_path, partition_by, fmt):
    conf = {"path": str(tmp_path / "t"), "primary_keys": ["id"], "format": fmt}
    if partition_by:
        conf["partition_by"] = partition_by
    output = {"format": "delta", "scd": conf}
    states = [[(1, "a"), (2, "b")], [(1, "a"), (2, "B")], [(1, "A"), (2, "B"), (3, "c")]]
    for moment, state in zip((T1, T2, T3), states):
        write_output(spark, frame(spark, *state), output, moment.date().isoformat(), moment)
    columns = ["id", "name", "start_date", "end_date", "is_current"]
    table = stored(spark, tmp_path / "t")
    assert rows(table, *columns) == [
        (1, "A", T3, None, True),
        (1, "a", T1, T3, False),
        (2, "B", T2, None, True),
        (2, "b", T1, T2, False),
        (3, "c", T3, None, True),
    ]
    assert table.schema["is_current"].dataType.typeName() == "boolean"
    if partition_by:
        assert table.schema["data_date"].dataType.typeName() == "date"


def test_scd2_load_does_not_read_closed_rows(spark, tmp_path):
    conf = {"path": str(tmp_path / "t"), "primary_keys": ["id"]}
    for moment, name in ((T1, "a"), (T2, "b"), (T3, "c")):
        write_scd(spark, frame(spark, (1, name)), conf, moment)
    opened = stored(spark, tmp_path / "t").where("is_current")
    assert opened.inputFiles() and rows(opened, "name") == [("c",)]
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "is_current" in plan.split("PartitionFilters: [")[1]
    (newest,) = (tmp_path / "t").glob("tidemark_load=3-*")
    assert sorted(p.name for p in newest.iterdir() if "=" in p.name) == [
        "is_current=false",
        "is_current=true",
    ]


def test_scd4_loads(spark, tmp_path):
    paths = {"current": str(tmp_path / "current"), "history": str(tmp_path / "history")}
    conf = {"type": "scd4", "path": paths, "primary_keys": ["id"], "partition_by": ["data_date"]}
    output = {"format": "csv", "scd": conf}
    write_output(spark, frame(spark, (1, "a"), (2, "b")), output, "2024-01-01", T1)
    write_output(spark, frame(spark, (2, "B"), (3, "c")), output, "2024-01-02", T2)
    current, history = stored(spark, paths["current"]), stored(spark, paths["history"])
    columns = ["id", "name", "start_date", "end_date"]
    assert rows(current, *columns) == [(2, "B", T2, None), (3, "c", T2, None)]
    assert rows(history, *columns) == [
        (1, "a", T1, None),
        (1, "a", T1, T2),
        (2, "b", T1, None),
        (2, "b", T1, T2),
    ]
    assert rows(read_history(spark, paths)) == rows(history)
    # The load date is no attribute: the same rows a day later change nothing.
    write_output(spark, frame(spark, (2, "B"), (3, "c")), output, "2024-01-03", T3)
    assert history.count() == stored(spark, paths["history"]).count()


def test_scd4_without_seeded_history(spark, tmp_path):
    paths = {"current": str(tmp_path / "current"), "history": str(tmp_path / "history")}
    conf = {"type": "scd4", "path": paths, "primary_keys": ["id"], "seed_history": False}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    assert read_history(spark, paths).isEmpty()
    write_scd(spark, frame(spark, (1, "b"), (2, "x")), conf, T2)
    assert rows(read_history(spark, paths), "name", "end_date") == [("a", T2)]


def test_scd4_history_keeps_columns_of_earlier_loads(spark, tmp_path):
    paths = {"current": str(tmp_path / "current"), "history": str(tmp_path / "history")}
    conf = {"type": "scd4", "path": paths, "primary_keys": ["id"], "seed_history": False}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    write_scd(spark, frame(spark, (1, 5), schema="id int, n int"), conf, T2)
    write_scd(spark, frame(spark, (1, 6), schema="id int, n int"), conf, T3)
    assert rows(read_history(spark, paths), "id", "name", "n") == [(1, None, 5), (1, "a", None)]


def test_named_tables_are_views(spark, tmp_path):
    conf = {"type": "scd2", "table": "dim_a", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    write_scd(spark, frame(spark, (1, "b")), conf, T2)
    assert rows(spark.table("dim_a"), "name", "is_current") == [("a", False), ("b", True)]
    assert read_input(spark, {"format": "delta", "table": "dim_a"}).count() == 2
    spark.sql("DROP VIEW dim_a")


def test_named_table_with_a_new_column(spark, tmp_path):
    conf = {"table": "dim_b", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    write_scd(spark, frame(spark, (1, "a", 5), schema="id int, name string, n int"), conf, T2)
    assert rows(spark.table("dim_b"), "name", "n", "is_current") == [("a", None, False), ("a", 5, True)]
    spark.sql("DROP VIEW dim_b")


def test_partition_columns_cannot_change(spark, tmp_path):
    conf = {"path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    with pytest.raises(ValueError, match="cannot change"):
        write_scd(spark, frame(spark, (1, "b")), {**conf, "partition_by": ["name"]}, T2)
    assert rows(stored(spark, tmp_path / "t"), "name") == [("a",)]


def test_another_hash_is_no_change(spark, tmp_path):
    for kind in ("scd2", "scd4"):
        paths = {p: str(tmp_path / kind / p) for p in ("current", "history")}
        path = paths if kind == "scd4" else paths["current"]
        conf = {"type": kind, "path": path, "primary_keys": ["id"]}
        wide = "id int, name string, n int"
        write_scd(spark, frame(spark, (1, "a", 1), (2, "b", 2), schema=wide), conf, T1)
        write_scd(spark, frame(spark, (1, "a", 1), (2, "b", 3), schema=wide), {**conf, "hash": "concat"}, T2)
        now = stored(spark, paths["current"]).where("end_date IS NULL")
        assert rows(now, "id", "start_date") == [(1, T1), (2, T2)]


def test_what_a_dead_load_left_does_not_come_back(spark, tmp_path):
    conf = {"path": str(tmp_path / "t"), "primary_keys": ["id"], "partition_by": ["name"]}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    table = VersionedTable(spark, str(tmp_path / "t"), "ledger")
    table.write(table.read().withColumn("name", F.lit("left over")), ["name"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_scd(spark, frame(spark, (1, "a"), (2, "b")), conf, T2)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(stored(spark, tmp_path / "t"), "id", "name") == [(1, "a"), (2, "b")]


def test_named_table_without_a_path(spark):
    conf = {
        "type": "scd4",
        "table": {"current": "dim_now", "history": "dim_past"},
        "primary_keys": ["id"],
    }
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    write_scd(spark, frame(spark, (1, "b")), conf, T2)
    assert rows(spark.table("dim_now"), "name") == [("b",)]
    assert rows(spark.table("dim_past"), "name") == [("a",), ("a",)]
    spark.sql("DROP VIEW dim_now")
    spark.sql("DROP VIEW dim_past")


def test_duplicate_source_keys_are_rejected(spark, tmp_path):
    conf = {"type": "scd2", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    with pytest.raises(ValueError, match="share a key"):
        write_scd(spark, frame(spark, (1, "a"), (1, "b")), conf)
    assert VersionedTable(spark, str(tmp_path / "t")).version() == 0


def test_rows_without_a_key_do_not_clash(spark, tmp_path):
    conf = {"type": "scd1", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (None, "a"), (None, "b"), (1, "c")), conf)
    assert stored(spark, tmp_path / "t").count() == 3
    with pytest.raises(ValueError, match="share a key"):
        write_scd(spark, frame(spark, (None, "a"), (None, "b")), {**conf, "null_safe_keys": True})


def test_wrong_configurations(spark, tmp_path):
    df, path = frame(spark, (1, "a")), str(tmp_path / "t")
    with pytest.raises(ValueError, match="SCD type"):
        write_scd(spark, df, {"type": "scd3", "path": path, "primary_keys": ["id"]})
    with pytest.raises(ValueError, match="primary_keys"):
        write_scd(spark, df, {"type": "scd1", "path": path})
    with pytest.raises(ValueError, match="missing"):
        write_scd(spark, df, {"type": "scd1", "path": path, "primary_keys": ["key"]})
    with pytest.raises(ValueError, match="history"):
        write_scd(spark, df, {"type": "scd4", "path": path, "primary_keys": ["id"]})
    with pytest.raises(ValueError, match="storage format"):
        write_scd(spark, df, {"path": path, "primary_keys": ["id"], "format": "csv"})


def test_a_load_that_died_is_invisible_and_can_run_again(spark, tmp_path):
    conf = {"type": "scd2", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    table = VersionedTable(spark, str(tmp_path / "t"), "ledger")
    table.write(table.read().withColumn("name", F.lit("half written")))
    assert rows(stored(spark, tmp_path / "t"), "name") == [("a",)]
    write_scd(spark, frame(spark, (1, "b")), conf, T2)
    assert rows(stored(spark, tmp_path / "t"), "name") == [("a",), ("b",)]


def test_two_loads_cannot_both_commit(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    first = one.write(frame(spark, (1, "a")))
    second = two.write(frame(spark, (1, "b")))
    assert one.commit({"table": first}) == 1
    with pytest.raises(FileExistsError):
        two.commit({"table": second})
    assert two.version() == 1 and rows(two.read()) == [(1, "a")]
    assert [n for n in files.names(spark, one.log) if n.endswith("draft")] == []


def test_a_load_on_an_outdated_state_cannot_commit(spark, tmp_path):
    conf = {"path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a")), conf, T1)
    slow = VersionedTable(spark, str(tmp_path / "t"), "ledger")
    slow.begin()
    state = slow.read_open()
    write_scd(spark, frame(spark, (1, "b")), conf, T2)
    assert rows(slow.read_open(), "name") == [("a",)]
    entry = slow.write(state)
    with pytest.raises(FileExistsError):
        slow.commit({"table": entry})
    assert rows(stored(spark, tmp_path / "t"), "name") == [("a",), ("b",)]


def test_source_is_computed_once_and_staging_is_removed(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = spark.range(50).selectExpr("CAST(id AS INT) AS id", "'x' AS name")
    source = source.mapInPandas(count, SCHEMA)
    paths = {"current": str(tmp_path / "c"), "history": str(tmp_path / "h")}
    conf = {"type": "scd4", "path": paths, "primary_keys": ["id"]}
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(files.names(spark, shared))
    write_scd(spark, source, conf, T1)
    assert seen.value == 50
    assert set(files.names(spark, shared)) == before


def test_unstaged_source(spark, tmp_path):
    conf = {"type": "scd1", "path": str(tmp_path / "t"), "primary_keys": ["id"], "stage_source": False}
    write_scd(spark, frame(spark, (1, "a")), conf)
    assert rows(stored(spark, tmp_path / "t")) == [(1, "a")]


class _Session:
    """A session with a master and a shared folder, as far as scratch space goes."""

    def __init__(self, master, shared=None):
        self.master, self.shared = master, shared
        self.conf = self.sparkContext = self

    def get(self, name, default=None):
        return self.shared or default


def test_scratch_space_is_shared_on_a_cluster():
    assert files.scratch_dir(_Session("yarn", "hdfs:///shared/")).startswith("hdfs:///shared/tidemark-")
    assert files.scratch_dir(_Session("local[2]", "/mnt/shared")).startswith("/mnt/shared/")
    assert "tidemark-" in files.scratch_dir(_Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.scratch_dir(_Session("yarn"))


# -- plain outputs and inputs ---------------------------------------------------


def test_stamp_only_adds_missing_columns(spark):
    df = frame(spark, (1, "2020-01-01"), schema="id int, data_date string")
    out = stamp(df, "2024-01-05", ["data_date", "loaded"])
    assert rows(out) == [(1, "2020-01-01", dt.date(2024, 1, 5))]
    assert stamp(df, None, ["loaded"]).columns == df.columns


def test_partitioned_output(spark, tmp_path):
    output = {"format": "delta", "path": str(tmp_path / "t"), "partition_by": ["data_date"], "mode": "append"}
    for day in ("2024-01-01", "2024-01-02"):
        write_output(spark, frame(spark, (1, day)), output, day)
    back = read_input(spark, output).where("data_date = DATE '2024-01-02'")
    assert rows(back, "id", "name") == [(1, "2024-01-02")]
    assert len(back.inputFiles()) == 2
    assert "data_date=2024-01-01" in {p.name for p in (tmp_path / "t").iterdir()}


def test_csv_round_trip(spark, tmp_path):
    output = {"format": "csv", "path": str(tmp_path / "t"), "options": {"sep": ";"}}
    write_output(spark, frame(spark, (1, "a;b")), output, "2024-01-05")
    entry = {"df_name": "x", "format": "csv", "table": str(tmp_path / "t"),
             "option": {"header": True, "inferSchema": True, "sep": ";"}}
    df = load_inputs(spark, [entry])["x"]
    assert rows(df) == [(1, "a;b", dt.date(2024, 1, 5))]
    typed = read_input(spark, {**entry, "schema": "id LONG, name STRING, data_date STRING"})
    assert rows(typed) == [(1, "a;b", "2024-01-05")]


def test_cached_input(spark, tmp_path):
    frame(spark, (1, "a")).write.parquet(str(tmp_path / "t"))
    entry = {"name": "t", "format": "parquet", "path": str(tmp_path / "t"), "isCache": True}
    for name, memory_only in (("DISK_ONLY", False), ("NO_SUCH_LEVEL", True)):
        df = read_input(spark, {**entry, "persistentLevel": name})
        assert df.storageLevel.useMemory == memory_only
        df.unpersist(blocking=True)
    assert not read_input(spark, {**entry, "isCache": False}).is_cached


def test_unknown_formats_and_locations(spark):
    with pytest.raises(ValueError, match="Unsupported format"):
        read_input(spark, {"name": "x", "format": "xml", "path": "x"})
    with pytest.raises(ValueError, match="Unsupported output format"):
        write_output(spark, spark.range(1), {"format": "xml", "path": "x"})
    with pytest.raises(ValueError, match="without a name"):
        load_inputs(spark, [{"format": "csv", "path": "x"}])
    with pytest.raises(ValueError, match="Neither"):
        read_input(spark, {"format": "csv"})


@pytest.mark.parametrize("kind", ["scd1", "scd2", "scd4"])
def test_trim(spark, tmp_path, kind):
    paths = {p: str(tmp_path / p) for p in ("current", "history")}
    path = paths if kind == "scd4" else paths["current"]
    conf = {"type": kind, "path": path, "primary_keys": ["id"]}
    for i in range(4):
        write_scd(spark, frame(spark, (1, f"n{i}"), (2, "same"), (3 + i, "x")), conf, T1)
    before = rows(stored(spark, paths["current"]))
    past = rows(stored(spark, paths["history"])) if kind == "scd4" else []
    table = VersionedTable.at(spark, paths["current"])
    third = rows(table.read(3))
    table.trim(keep=2)
    table.trim(keep=2)
    assert rows(stored(spark, paths["current"])) == before and rows(table.read(3)) == third
    if kind == "scd4":
        assert rows(stored(spark, paths["history"])) == past
    with pytest.raises(ValueError, match="no load 1"):
        table.read(1)
    with pytest.raises(ValueError, match="kept"):
        table.trim(0)
    kept = {d.name.split("-")[0] for d in (tmp_path / "current").glob("tidemark_load=*")
            if (d / "is_current=true").exists() or any(d.glob("*.parquet"))}
    assert kept == {"tidemark_load=3", "tidemark_load=4"}
    assert write_scd(spark, frame(spark, (1, "n9")), conf, T2) == 5


# -- change feeds -----------------------------------------------------------------


def test_feed_gives_what_a_snapshot_load_gives(spark, tmp_path, both_plans):
    states = [
        [(1, "a"), (2, "b"), (3, "c")],
        [(1, "a"), (2, "B"), (4, "d")],
        [(2, "B"), (3, "c"), (4, "D")],
    ]
    confs = {
        how: {
            "type": "scd4",
            "primary_keys": ["id"],
            "path": {p: str(tmp_path / how / p) for p in ("current", "history")},
        }
        for how in ("snapshot", "feed")
    }
    before = frame(spark, *states[0]).limit(0)
    for moment, state in zip((T1, T2, T3), states):
        now = frame(spark, *state)
        write_scd(spark, now, confs["snapshot"], moment)
        write_feed(spark, change_feed(before, now, ["id"]), confs["feed"], moment)
        before = now
    columns = ["id", "name", "start_date", "end_date", "hash_data"]
    for part in ("current", "history"):
        tables = [stored(spark, confs[how]["path"][part]) for how in ("snapshot", "feed")]
        assert rows(tables[0], *columns) == rows(tables[1], *columns)


def test_feed_between_two_stored_loads(spark, tmp_path):
    conf = {"type": "scd1", "path": str(tmp_path / "t"), "primary_keys": ["id"]}
    write_scd(spark, frame(spark, (1, "a"), (2, "b")), conf)
    write_scd(spark, frame(spark, (2, "B"), (3, "c")), conf)
    table = VersionedTable(spark, str(tmp_path / "t"))
    feed = change_feed(table.read(1), table.read(2), ["id"])
    assert rows(feed, "id", "_change_type") == [
        (2, "update_postimage"),
        (2, "update_preimage"),
        (3, "insert"),
    ]


def test_later_loads_write_few_files_per_partition(spark, tmp_path):
    conf = {"path": str(tmp_path / "t"), "primary_keys": ["id"], "partition_by": ["data_date"]}
    output = {"format": "delta", "scd": conf}
    for day, moment in zip(("2024-01-01", "2024-01-02", "2024-01-03"), (T1, T2, T3)):
        state = spark.range(moment.day * 1000).selectExpr("CAST(id AS INT) AS id", "'a' AS name")
        write_output(spark, state.repartition(20), output, day, moment)
    (newest,) = (tmp_path / "t").glob("tidemark_load=3-*/is_current=true")
    found = {d.name: len(list(d.glob("*.parquet"))) for d in newest.iterdir() if "=" in d.name}
    assert found == {f"data_date=2024-01-0{d}": 1 for d in (1, 2, 3)}
