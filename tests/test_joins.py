from __future__ import annotations

import itertools

import pytest

from conftest import rows
from tidemark.operators.joins import join_on, join_using

# Key 7 holds most rows of the left, key 8 most rows of the right.
LEFT = (
    [(7, None, i) for i in range(120)]
    + [(k, "x", 1000 + k) for k in range(40)]
    + [(None, "n", 2000 + i) for i in range(30)]
    + [(5, "x", 3000)]
)
RIGHT = (
    [(8, "x", i) for i in range(60)]
    + [(k, "x", 1000 + k) for k in range(20, 60)]
    + [(7, "x", 2000), (7, "x", 2001), (None, "x", 3000), (None, "n", 3001), (8, None, 3002)]
)


def sides(spark):
    left = spark.createDataFrame(LEFT, "a int, b string, l int")
    right = spark.createDataFrame(RIGHT, "a int, b string, r int")
    return left, right


def brute(keys, how):
    width = len(keys)
    match = [
        (x, y)
        for x, y in itertools.product(LEFT, RIGHT)
        if x[:width] == y[:width] and None not in x[:width]
    ]
    left_hit, right_hit = {x for x, _ in match}, {y for _, y in match}
    if how == "semi":
        return [x for x in LEFT if x in left_hit]
    if how == "anti":
        return [x for x in LEFT if x not in left_hit]
    out = [(*x, *y) for x, y in match]
    if how in ("left", "full"):
        out += [(*x, None, None, None) for x in LEFT if x not in left_hit]
    if how in ("right", "full"):
        out += [(None, None, None, *y) for y in RIGHT if y not in right_hit]
    return out


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
@pytest.mark.parametrize("keys", [["a"], ["a", "b"]])
def test_join_on_equals_brute_force(spark, both_plans, keys, how):
    left, right = sides(spark)
    joined = join_on(left, right, keys, how)
    expected = sorted(brute(keys, how), key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(joined) == expected
    if how not in ("semi", "anti"):
        joined.select("df1.a", "df2.a", "l", "r").collect()


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
def test_join_using_equals_spark(spark, both_plans, how):
    left, right = sides(spark)
    left, right = left.drop("b"), right.drop("b")
    ours = join_using(left, right, ["a"], how)
    theirs = left.join(right, "a", how)
    assert ours.columns == theirs.columns
    assert rows(ours) == rows(theirs)


def test_self_join_keeps_both_sides(spark, both_plans):
    left, _ = sides(spark)
    full = join_on(left, left, ["a", "b"], "full")
    keyed = [r for r in LEFT if None not in r[:2]]
    assert full.count() == sum(x[:2] == y[:2] for x in keyed for y in keyed) + 2 * (len(LEFT) - len(keyed))


def test_long_names_of_join_types(spark):
    left, right = sides(spark)
    assert join_on(left, right, ["a"], "left_outer").count() == len(brute(["a"], "left"))
    assert join_on(left, right, ["a"], "LEFT_ANTI").count() == len(brute(["a"], "anti"))


def test_wrong_arguments(spark):
    left, right = sides(spark)
    with pytest.raises(ValueError, match="join type"):
        join_on(left, right, ["a"], "cross")
    with pytest.raises(ValueError, match="at least one"):
        join_on(left, right, [])
