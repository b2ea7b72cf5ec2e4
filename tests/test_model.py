"""Random series of loads against a row-by-row model."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import apply_change_feed, change_feed, scd1_merge, scd2_merge
from tidemark.sinks import read_history, write_scd
from tidemark.sources import read_input

SCHEMA = "a int, b string, x string, y double"
KEY = ["a", "b"]


def series(seed, loads=4):
    """Snapshots as ``{key: attributes}``, some of them empty or unchanged."""
    dice = random.Random(seed)
    keys = [(a, b) for a in range(6) for b in ("p", "q", "p|q")]
    out = []
    for _ in range(loads):
        kind = dice.random()
        if kind < 0.15 and out:
            out.append(dict(out[-1]))
            continue
        share = 0 if kind < 0.25 else dice.uniform(0.3, 1)
        out.append(
            {
                k: (dice.choice(["", "~", None, "u", "u|v"]), dice.choice([None, 0.0, 1.5]))
                for k in keys
                if dice.random() < share
            }
        )
    return out


def frame(spark, snapshot):
    return spark.createDataFrame([(*k, *v) for k, v in snapshot.items()], SCHEMA)


def moment(i):
    return dt.datetime(2024, 1, 1 + i)


def ordered(records):
    return sorted(records, key=lambda r: [(v is not None, str(v)) for v in r])


def model_scd2(snapshots, insert_new, expire_missing):
    closed, live = [], {}
    for i, snapshot in enumerate(snapshots):
        for k in list(live):
            values, start = live[k]
            if k not in snapshot:
                if expire_missing:
                    closed.append((*k, *values, start, moment(i), False))
                    del live[k]
            elif snapshot[k] != values:
                closed.append((*k, *values, start, moment(i), False))
                live[k] = (snapshot[k], moment(i))
        if insert_new or i == 0:
            for k in snapshot.keys() - live.keys():
                live[k] = (snapshot[k], moment(i))
    return ordered(closed + [(*k, *v, s, None, True) for k, (v, s) in live.items()])


VERSION = ["a", "b", "x", "y", "start_date", "end_date", "is_current"]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("insert_new, expire_missing", [(True, False), (False, True), (True, True)])
def test_scd2(spark, tmp_path, seed, insert_new, expire_missing):
    snapshots = series(seed)
    if not snapshots[0]:
        snapshots[0] = {(0, "p"): ("u", None)}
    options = {"insert_new": insert_new, "expire_missing": expire_missing}
    conf = {"path": str(tmp_path / "t"), "primary_keys": KEY, "stage_source": False, **options}
    for i, snapshot in enumerate(snapshots):
        write_scd(spark, frame(spark, snapshot), conf, moment(i))
    stored = read_input(spark, {"format": "delta", "path": conf["path"]})
    assert rows(stored, *VERSION) == model_scd2(snapshots, insert_new, expire_missing)


def test_scd2_pure_equals_stored_model(spark, both_plans):
    snapshots, table = series(11, loads=3), None
    for i, snapshot in enumerate(snapshots):
        as_of = F.lit(moment(i).isoformat(sep=" ")).cast("timestamp_ntz")
        table = scd2_merge(table, frame(spark, snapshot), KEY, as_of)
    assert rows(table, *VERSION) == model_scd2(snapshots, True, False)


@pytest.mark.parametrize("seed", range(4))
def test_scd4(spark, tmp_path, seed):
    snapshots = series(seed)
    paths = {"current": str(tmp_path / "c"), "history": str(tmp_path / "h")}
    conf = {"type": "scd4", "path": paths, "primary_keys": KEY, "stage_source": False}
    starts, history, before = {}, [], {}
    for i, snapshot in enumerate(snapshots):
        write_scd(spark, frame(spark, snapshot), conf, moment(i))
        for k, values in before.items():
            if snapshot.get(k) != values:
                history.append((*k, *values, starts.pop(k), moment(i)))
        starts = {k: starts.get(k, moment(i)) for k in snapshot}
        if i == 0:
            history = [(*k, *v, moment(0), None) for k, v in snapshot.items()]
        before = snapshot
    columns = VERSION[:-1]
    current = read_input(spark, {"format": "delta", "path": paths["current"]})
    assert rows(current, *columns) == ordered((*k, *v, starts[k], None) for k, v in before.items())
    assert rows(read_history(spark, paths), *columns) == ordered(history)


@pytest.mark.parametrize("seed", range(4))
def test_scd1_and_feed(spark, seed, both_plans):
    old, new = series(seed, loads=2)
    merged = scd1_merge(frame(spark, old), frame(spark, new), KEY)
    assert rows(merged) == ordered((*k, *v) for k, v in {**old, **new}.items())

    feed = change_feed(frame(spark, old), frame(spark, new), KEY)
    expected = []
    for k in old.keys() | new.keys():
        if k not in new:
            expected.append((*k, *old[k], "delete"))
        elif k not in old:
            expected.append((*k, *new[k], "insert"))
        elif old[k] != new[k]:
            expected += [(*k, *old[k], "update_preimage"), (*k, *new[k], "update_postimage")]
    assert rows(feed) == ordered(expected)

    as_of = F.lit("2024-01-01").cast("timestamp_ntz")
    empty = frame(spark, {}).withColumn("end_date", as_of)
    state, past = apply_change_feed(frame(spark, old), empty, feed, KEY, as_of)
    assert rows(state) == ordered((*k, *v) for k, v in new.items())
    assert past.count() == sum(r[-1] in ("delete", "update_preimage") for r in expected)
