from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import (
    apply_change_feed,
    change_feed,
    changed_keys,
    classify,
    duplicate_keys,
    join_using,
    scd1_merge,
    scd2_init,
    scd2_merge,
    scd4_current,
    scd4_history,
    scd4_init,
)

SCHEMA = "id int, name string, amount double"
T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
pytestmark = pytest.mark.usefixtures("both_plans")


def frame(spark, *records, schema=SCHEMA):
    return spark.createDataFrame(list(records), schema)


def at(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


@pytest.fixture
def old(spark):
    return frame(spark, (1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (None, "n", 0.0))


@pytest.fixture
def new(spark):
    return frame(spark, (1, "a", 1.0), (2, "B", 2.0), (3, "c", None), (4, "d", 4.0), (None, "n", 0.0))


# -- comparison ---------------------------------------------------------------


def test_classify(old, new):
    assert rows(classify(old, new, ["id"])) == [
        (None, "delete"),
        (None, "insert"),
        (1, "unchanged"),
        (2, "update"),
        (3, "update"),
        (4, "insert"),
    ]


def test_classify_null_safe(old, new):
    labels = rows(classify(old, new, ["id"], null_safe=True))
    assert (None, "unchanged") in labels and len(labels) == 5


def test_null_and_shifted_values_are_changes(spark):
    schema = "id int, a string, b string, c string"
    before = frame(spark, (1, "a", None, "b"), (2, "x|y", "z", ""), (3, "1:x", "~", None), schema=schema)
    after = frame(spark, (1, "a", "b", None), (2, "x", "y|z", ""), (3, "1:x", None, "~"), schema=schema)
    assert rows(changed_keys(before, after, ["id"])) == [(1,), (2,), (3,)]
    assert rows(changed_keys(before, after, ["id"], hash="concat")) == [(2,)]


def test_column_order_and_load_date_are_no_change(spark, old):
    same = old.select("amount", "id", "name").withColumn("data_date", F.current_date())
    assert changed_keys(old, same, ["id"]).isEmpty()


def test_ignored_column(old):
    other = old.withColumn("amount", F.lit(9.0))
    assert changed_keys(old, other, ["id"], ignore=["amount"]).isEmpty()
    assert changed_keys(old, other, ["id"]).count() == 3


def test_many_rows_without_a_key(spark):
    before = spark.range(1000).select(F.lit(None).cast("int").alias("id"), F.col("id").alias("v"))
    after = before.unionByName(frame(spark, (1, 1), schema="id int, v long"))
    counts = dict(rows(classify(before, after, ["id"]).groupBy("change").count()))
    assert counts == {"delete": 1000, "insert": 1001}


def test_duplicate_keys(spark):
    df = frame(spark, (1, "a", 1.0), (1, "b", 1.0), (2, "c", 1.0))
    assert rows(duplicate_keys(df, ["id"])) == [(1, 2)]


def test_missing_key_column(old, new):
    with pytest.raises(ValueError, match="nope"):
        classify(old, new, ["nope"])


def test_feed_turns_old_into_new(spark, old, new):
    feed = change_feed(old, new, ["id"])
    kinds = dict(rows(feed.groupBy("_change_type").count()))
    assert kinds == {"insert": 2, "delete": 1, "update_preimage": 2, "update_postimage": 2}
    keyed_old, keyed_new = old.where("id is not null"), new.where("id is not null")
    feed = change_feed(keyed_old, keyed_new, ["id"])
    history = keyed_old.limit(0).withColumn("end_date", at(T1))
    state, past = apply_change_feed(keyed_old, history, feed, ["id"], at(T2))
    assert rows(state) == rows(keyed_new)
    assert rows(past, "id", "name", "end_date") == [(2, "b", T2), (3, None, T2)]


def test_feed_null_safe(old, new):
    feed = change_feed(old, new, ["id"], null_safe=True)
    history = old.limit(0).withColumn("end_date", at(T1))
    state, _ = apply_change_feed(old, history, feed, ["id"], at(T2), null_safe=True)
    assert rows(state) == rows(new)


def test_empty_feed(old):
    assert change_feed(old.where("id > 0"), old.where("id > 0"), ["id"]).isEmpty()


# -- type 1 -------------------------------------------------------------------


def test_scd1_first_load(old):
    assert rows(scd1_merge(None, old, ["id"])) == rows(old)


def test_scd1_merge(spark, old):
    source = frame(spark, (2, "B", None), (9, "z", 9.0))
    assert rows(scd1_merge(old, source, ["id"])) == [
        (None, "n", 0.0),
        (1, "a", 1.0),
        (2, "B", None),
        (3, None, 3.0),
        (9, "z", 9.0),
    ]


def test_scd1_keeps_target_only_columns(spark, old):
    source = frame(spark, (2, "two"), (9, "nine"), schema="id int, label string")
    merged = scd1_merge(old, source, ["id"])
    assert merged.columns == ["id", "name", "amount", "label"]
    assert (2, "b", 2.0, "two") in rows(merged) and (9, None, None, "nine") in rows(merged)


def test_scd1_updates_every_target_row_of_a_key(spark):
    target = frame(spark, (1, "a", 1.0), (1, "b", 1.0))
    merged = scd1_merge(target, frame(spark, (1, "c", 2.0)), ["id"])
    assert rows(merged) == [(1, "c", 2.0), (1, "c", 2.0)]


def test_scd1_keeps_target_types(spark, old):
    source = frame(spark, (1, "x", 5), schema="id long, name string, amount int")
    assert scd1_merge(old, source, ["ID"]).schema.simpleString() == old.schema.simpleString()


def test_scd1_empty_sides(old):
    assert rows(scd1_merge(old, old.limit(0), ["id"])) == rows(old)
    assert rows(scd1_merge(old.limit(0), old, ["id"])) == rows(old)


# -- type 2 -------------------------------------------------------------------

VERSION = ["id", "name", "start_date", "end_date", "is_current"]


def test_scd2_first_and_second_load(old, new):
    first = scd2_merge(None, old.where("id > 0"), ["id"], at(T1))
    assert rows(first, *VERSION) == [
        (1, "a", T1, None, True),
        (2, "b", T1, None, True),
        (3, None, T1, None, True),
    ]
    second = scd2_merge(first, new.where("id > 0"), ["id"], at(T2))
    assert rows(second, *VERSION) == [
        (1, "a", T1, None, True),
        (2, "B", T2, None, True),
        (2, "b", T1, T2, False),
        (3, None, T1, T2, False),
        (3, "c", T2, None, True),
        (4, "d", T2, None, True),
    ]


def test_scd2_revert_opens_a_third_version(spark):
    states = [frame(spark, (1, n, 1.0)) for n in ("a", "b", "a")]
    table = None
    for moment, state in zip((T1, T2, T3), states):
        table = scd2_merge(table, state, ["id"], at(moment))
    assert rows(table, *VERSION) == [
        (1, "a", T1, T2, False),
        (1, "a", T3, None, True),
        (1, "b", T2, T3, False),
    ]


def test_scd2_same_load_twice(old):
    keyed = old.where("id > 0")
    first = scd2_init(keyed, ["id"], at(T1))
    assert rows(scd2_merge(first, keyed, ["id"], at(T2))) == rows(first)


def test_scd2_options(old, new):
    first = scd2_init(old.where("id > 0"), ["id"], at(T1))
    source = new.where("id > 1")
    kept = scd2_merge(first, source, ["id"], at(T2), insert_new=False)
    assert 4 not in [r[0] for r in rows(kept, "id")]
    assert (1, "a", T1, None, True) in rows(kept, *VERSION)
    expired = scd2_merge(first, source, ["id"], at(T2), expire_missing=True)
    assert (1, "a", T1, T2, False) in rows(expired, *VERSION)
    back = scd2_merge(expired, new.where("id > 0"), ["id"], at(T3))
    assert (1, "a", T3, None, True) in rows(back, *VERSION)


def test_scd2_new_column(spark, old):
    first = scd2_init(old.where("id > 0"), ["id"], at(T1))
    wider = old.where("id > 0").withColumn("extra", F.when(F.col("id") == 2, "e"))
    second = scd2_merge(first, wider, ["id"], at(T2))
    assert rows(second.where("not is_current"), "id") == [(2,)]
    assert (2, "e", True) in rows(second, "id", "extra", "is_current")


def test_scd2_without_attributes(spark):
    ids = frame(spark, (1,), (2,), schema="id int")
    first = scd2_init(ids, ["id"], at(T1))
    second = scd2_merge(first, frame(spark, (2,), (3,), schema="id int"), ["id"], at(T2))
    assert rows(second, "id", "is_current") == [(1, True), (2, True), (3, True)]


def test_scd2_invariants_over_random_loads(spark):
    dice = random.Random(7)
    table, truth = None, {}
    for day in range(1, 6):
        state = {k: dice.choice("abc") for k in range(30) if dice.random() < 0.7}
        truth.update(state)
        source = frame(spark, *state.items(), schema="id int, name string")
        table = scd2_merge(table, source, ["id"], at(dt.datetime(2024, 1, day)))
    versions = rows(table, *VERSION)
    live = {v[0]: v[1] for v in versions if v[4]}
    assert live == truth and len([v for v in versions if v[4]]) == len(truth)
    for key in truth:
        mine = sorted((v for v in versions if v[0] == key), key=lambda v: v[2])
        for before, after in zip(mine, mine[1:]):
            assert before[3] == after[2] and before[1] != after[1]


def test_reserved_column_names_are_rejected(spark):
    loans = frame(spark, (1, T1), schema="id int, Start_Date timestamp")
    with pytest.raises(ValueError, match="Start_Date"):
        scd2_merge(None, loans, ["id"], at(T1))
    first = scd2_init(loans.select("id"), ["id"], at(T1))
    for load in (scd2_merge, scd4_current, scd4_history):
        with pytest.raises(ValueError, match="Start_Date"):
            load(first, loans, ["id"], at(T2))


def test_column_names_differ_in_case(spark, old):
    first = scd2_init(old.where("id > 0"), ["id"], at(T1))
    loud = frame(spark, (1, "a", 1.0), (2, "B", 2.0), schema="ID int, NAME string, Amount double")
    second = scd2_merge(first, loud, ["Id"], at(T2))
    assert second.columns == first.columns
    assert rows(second.where("id = 2"), "name", "is_current") == [("B", True), ("b", False)]
    assert rows(second.where("id = 1"), "start_date") == [(T1,)]


def test_names_with_dots_and_spaces(spark, old, new):
    def odd(df):
        return df.where("id > 0").toDF("the.key", "a name", "x.y")

    before, after, key = odd(old), odd(new), ["the.key"]
    assert rows(classify(before, after, key).groupBy("change").count()) == [
        ("insert", 1),
        ("unchanged", 1),
        ("update", 2),
    ]
    assert changed_keys(before, after, key, hash="concat").count() == 2
    assert change_feed(before, after, key).count() == 5
    assert scd1_merge(before, after, key).columns == before.columns
    first = scd2_init(before, key, at(T1))
    assert scd2_merge(first, after, key, at(T2)).count() == 6
    assert scd4_history(first, after, key, at(T2)).count() == 2
    assert scd4_current(first, after, key, at(T2)).count() == 4
    joined = join_using(before, after, key, "full")
    assert joined.columns[0] == "the.key" and joined.count() == 4


# -- type 4 -------------------------------------------------------------------


def test_scd4(old, new):
    old, new = old.where("id > 0"), new.where("id <> 1")
    current = scd4_init(old, ["id"], at(T1))
    assert rows(current, "id", "start_date", "end_date") == [(i, T1, None) for i in (1, 2, 3)]
    assert rows(scd4_history(current, new, ["id"], at(T2)), "id", "name", "start_date", "end_date") == [
        (1, "a", T1, T2),
        (2, "b", T1, T2),
        (3, None, T1, T2),
    ]
    after = scd4_current(current, new, ["id"], at(T2))
    assert after.columns == current.columns
    assert rows(after, "id", "name", "start_date") == [(2, "B", T2), (3, "c", T2), (4, "d", T2)]
    again = scd4_current(after, new, ["id"], at(T3))
    assert rows(again) == rows(after)
    assert scd4_history(after, new, ["id"], at(T3)).isEmpty()


def test_scd4_recomputes_a_missing_hash(old, new):
    bare = scd4_init(old.where("id > 0"), ["id"], at(T1)).drop("hash_data")
    assert rows(scd4_history(bare, new, ["id"], at(T2)), "id") == [(2,), (3,)]


def test_composite_key(spark):
    schema = "a int, b string, v int"
    target = frame(spark, (1, "x", 1), (1, "y", 2), (2, "x", 3), schema=schema)
    source = frame(spark, (1, "y", 9), (2, "y", 4), schema=schema)
    assert rows(scd1_merge(target, source, ["a", "b"])) == [
        (1, "x", 1),
        (1, "y", 9),
        (2, "x", 3),
        (2, "y", 4),
    ]
    assert rows(classify(target, source, ["a", "b"])) == [
        (1, "x", "delete"),
        (1, "y", "update"),
        (2, "x", "delete"),
        (2, "y", "insert"),
    ]
