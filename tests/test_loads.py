"""What a load finds out in its own job: repeated keys, changes, last images."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from tidemark.operators import apply_change_feed, change_feed, scd4_current, scd4_history
from tidemark.operators.changes import feed_states
from tidemark.operators.scd import MOVED, TARGET, scd2_step, scd4_init, scd4_step
from tidemark.sinks import write_scd
from tidemark.tables import VersionedTable

T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
FEED = "id int, x string, _change_type string, _commit_version int"


def at(moment):
    return F.lit(moment).cast("timestamp_ntz")


def frame(spark, *data, schema="id int, x string"):
    return spark.createDataFrame(list(data), schema)


def conf_of(kind, path, **more):
    where = {"current": f"{path}/c", "history": f"{path}/h"} if kind == "scd4" else f"{path}/t"
    return {"type": kind, "path": where, "primary_keys": ["id"], **more}


def tables(spark, conf):
    path = conf["path"]
    return [path] if isinstance(path, str) else [path["current"], path["history"]]


def folders(tmp_path):
    return sorted(p.name for p in tmp_path.glob("*/tidemark_load=*"))


@pytest.mark.parametrize("kind", ["scd2", "scd4"])
def test_a_load_without_changes_commits_nothing(spark, tmp_path, kind):
    conf = conf_of(kind, tmp_path)
    book = frame(spark, (1, "a"), (2, None))
    assert write_scd(spark, book, conf, T1) == 1
    before = folders(tmp_path)
    assert write_scd(spark, book, conf, T2) == 1
    assert folders(tmp_path) == before
    empty = book.limit(0)
    assert write_scd(spark, empty, conf, T2) == (1 if kind == "scd2" else 2)
    # A new column is a change of the table even if no row changes.
    wider = book.withColumn("y", F.lit(None).cast("int"))
    other = tmp_path / "other"
    conf = conf_of(kind, other)
    assert write_scd(spark, book, conf, T1) == 1
    assert write_scd(spark, wider, conf, T2) == 2
    assert write_scd(spark, wider, conf, T3) == 2
    assert write_scd(spark, book.where("id = 1").withColumn("x", F.lit("b")), conf, T3) == 3


@pytest.mark.parametrize("kind", ["scd1", "scd2", "scd4"])
@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("more", [{}, {"small_load": True}, {"insert_new": False}, {"null_safe_keys": True}])
def test_repeated_keys_fail_the_load_itself(spark, tmp_path, kind, first, more):
    conf, n = conf_of(kind, tmp_path, **more), 0
    if not first:
        n = write_scd(spark, frame(spark, (1, "a"), (3, "c")), conf, T1)
    before = folders(tmp_path)
    with pytest.raises(ValueError, match='share a key, for example {"'):
        write_scd(spark, frame(spark, (1, "x"), (2, "x"), (2, "y")), conf, T2)
    assert VersionedTable(spark, tables(spark, conf)[0]).version() == n
    assert folders(tmp_path) == before


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Scan")


def test_the_key_check_costs_no_shuffle(spark, tmp_path):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        scd4_init(frame(spark, (1, "a")), ["id"], at(T1)).write.parquet(str(tmp_path / "old"))
        frame(spark, (1, "b")).write.parquet(str(tmp_path / "new"))
        old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("old", "new"))
        for unique in (False, True):
            assert exchanges(scd4_step(old, new, ["id"], at(T2), unique=unique)) == (2, 2)
        opened = old.withColumn("is_current", F.lit(True))
        assert exchanges(scd2_step(opened, new, ["id"], at(T2), unique=True)) == (2, 2)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("null_safe", [True, False])
def test_one_comparison_gives_both_tables(spark, null_safe):
    chance = random.Random(4)

    def book(n):
        keys = chance.sample(range(40), n)
        return frame(spark, *[(k, chance.choice("ab")) for k in keys], (None, "n"))

    current = scd4_init(book(25), ["id"], at(T1)).withColumn("went", F.lit(1))
    source = book(25).withColumn("came", F.lit("c"))
    step = scd4_step(current, source, ["id"], at(T2), null_safe=null_safe)
    for target, alone in (("current", scd4_current), ("history", scd4_history)):
        want = alone(current, source, ["id"], at(T2), null_safe=null_safe)
        got = step.where(F.col(TARGET) == target)
        assert rows(got.select(*want.columns)) == rows(want)
    made = rows(step.where(MOVED).groupBy(TARGET).count())
    assert dict(made)["history"] == step.where(F.col(TARGET) == "history").count()


def test_two_last_images_are_an_error_in_the_pure_operator(spark):
    current = frame(spark, (1, "a"))
    feed = frame(spark, (1, "b", "update_postimage", 1), (1, "c", "update_postimage", 1), schema=FEED)
    state, _ = apply_change_feed(current, current.limit(0), feed, ["id"], F.lit("end"))
    with pytest.raises(Exception, match="without an order"):
        state.collect()


def test_feeds_round_trip_with_and_without_keys(spark):
    chance = random.Random(8)
    for null_safe in (True, False):
        old = frame(spark, *[(k, chance.choice("ab")) for k in chance.sample(range(60), 40)])
        new = frame(spark, *[(k, chance.choice("ab")) for k in chance.sample(range(60), 40)])
        if null_safe:
            old, new = old.union(frame(spark, (None, "x"))), new.union(frame(spark, (None, "y")))
        feed = change_feed(old, new, ["id"], null_safe=null_safe)
        history = old.limit(0).withColumn("end_date", F.lit(None).cast("string"))
        state, past = apply_change_feed(old, history, feed, ["id"], F.lit("end"), null_safe=null_safe)
        assert rows(state) == rows(new)
        gone = feed.where("_change_type IN ('delete', 'update_preimage')").select("id", "x")
        assert rows(past.select("id", "x")) == rows(gone)


def test_a_hot_key_combines_before_the_shuffle(spark):
    """A third of all images have no key: they are shuffled as a row per task."""
    feed = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).cast("int").alias("id"),
        F.lit("x").alias("x"),
        F.when(F.col("id") % 3 > 0, "insert").otherwise("delete").alias("_change_type"),
    )
    for null_safe in (True, False):
        states = feed_states(feed, ["id"], null_safe)
        assert states.count() == 20_000 + null_safe
        dealt = states.groupBy(F.spark_partition_id()).count().collect()
        counts = sorted(r["count"] for r in dealt)
        assert counts[-1] <= 2 * counts[len(counts) // 2]
    plan = feed_states(feed, ["id"], True)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_" in plan
