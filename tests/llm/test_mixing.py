from __future__ import annotations

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from tidemark.llm import mixing
from tidemark.llm.shared import stored

from .common import documents, odd_rows, tuples

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size_of(text):
    return len(WORD.findall(text or ""))


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: float(2 * sizes[s] if s in full else weight[s] * level) for s in names}
        full |= more


@pytest.mark.parametrize("clashing", [False, True])
def test_sizes_targets_and_takings(spark, clashing):
    rows = odd_rows()
    out = mixing.mix(documents(spark, rows, clashing)).collect()
    source = defaultdict(set)
    sizes, taken = Counter(), Counter()
    for r in rows:
        source[r[0]].add(r[3])
        sizes[r[3]] += size_of(r[1])
    assert sorted((str(r["doc_id"]), r["size"]) for r in out) == sorted((str(r[0]), size_of(r[1])) for r in rows)
    targets = plain_targets(sizes)
    for r in out:
        own = {s for s in source[r["doc_id"]] if sizes[s] == r["source_size"]}
        assert any(r["target"] == pytest.approx(targets[s]) for s in own)
        assert 0 <= r["taken"] <= 2 * r["size"]
        if len(source[r["doc_id"]]) == 1:
            taken[next(iter(own))] += r["taken"]
    for s in ("s1", "s2", "s3", "s4"):
        assert abs(taken[s] - targets[s]) <= 2 * mixing.BLOCK
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_partitions_make_no_difference(spark):
    rows = odd_rows(4)
    first = tuples(mixing.mix(documents(spark, rows)))
    assert first == tuples(mixing.mix(documents(spark, rows[::-1]).repartition(7, "doc_id")))


@pytest.mark.parametrize("cell_rows", [4, 4096])
def test_cells_share_a_sources_blocks(spark, cell_rows):
    rows = [(i, "w " * (50 + i % 13), "en", f"s{i % 2}", 0) for i in range(200)]
    out = mixing.mix(documents(spark, rows), cell_rows=cell_rows).collect()
    taken, target = Counter(), {}
    for r in out:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    for s, words in target.items():
        assert abs(taken[s] - words) <= mixing.BLOCK * (2 if cell_rows > 200 else 26)


def test_apportion_equals_highest_quotients_one_by_one(spark):
    groups = {"a": ([5, 3, 1, 1], 7), "b": ([1], 4), "c": ([100, 1, 1, 1, 1, 1], 23), "d": ([2, 2, 2], 2), "e": ([0, 7], 9)}
    rows = [(g, i, w, seats) for g, (weights, seats) in groups.items() for i, w in enumerate(weights)]
    df = spark.createDataFrame(rows, "g string, i int, w long, seats long")
    got = {(r["g"], r["i"]): r["quota"] for r in mixing.apportion(df, ["g"], "w", "seats", ["g", "i"]).collect()}
    for g, (weights, seats) in groups.items():
        own = [0] * len(weights)
        for _ in range(seats):
            own[max(range(len(own)), key=lambda i: (Fraction(weights[i], 2 * own[i] + 1), -i))] += 1
        assert [got[g, i] for i in range(len(own))] == own


def test_mixed_documents_hold_what_is_taken(spark):
    rows = odd_rows()
    docs = documents(spark, rows, clashing=True)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got, whole = Counter(), {r[1] for r in rows}
    for r in out.collect():
        got[r["doc_id"]] += size_of(r["text"])
        assert r["text"] in whole or r["n_chars"] == len(r["text"])
        if r["text"] not in whole:
            assert any(set(WORD.findall(r["text"])) <= set(WORD.findall(x[1] or "")) for x in rows if x[0] == r["doc_id"])
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"]] += r["taken"]
    assert got == Counter({k: v for k, v in want.items() if v})


def test_rows_of_two_sources_keep_their_own_shares(spark):
    """Equal ids and texts in two sources of different targets, in either order."""
    rows = [(i, f"{i} " + "w " * 400, "en", s, 0) for i in range(40) for s in ("a", "b", None)]

    def words_of(rows):
        got = Counter()
        for r in mixing.mixed_documents(documents(spark, rows)).collect():
            got[r["source"]] += size_of(r["text"])
        return got

    sizes = {s: 40 * 401 for s in ("a", "b", None)}
    got = words_of(rows)
    assert got == words_of(rows[::-1])
    for s, words in plain_targets(sizes).items():
        assert abs(got[s] - words) <= 2 * mixing.BLOCK


def test_selected_blocks_by_enumeration(spark):
    cells = [(b, e, t) for b in (1, 2, 5) for e in range(b) for t in range(b)]
    df = spark.createDataFrame(cells, "blocks long, extra long, turn long")
    df = df.selectExpr("*", "explode(sequence(0, blocks * 4)) AS at")
    for r in df.withColumn("words", mixing.selected_before(F.col("at"), 4)).collect():
        selected = {(r["turn"] + i) % r["blocks"] for i in range(r["extra"])}
        assert r["words"] == sum(w // 4 in selected for w in range(r["at"]))


def test_a_run_of_blocks_keeps_documents_whole(spark):
    rows = [(i, " ".join(f"{i}x{j}" for j in range(100)), "en", "ab"[i % 2], 0) for i in range(60)]
    texts = {r[0]: r[1] for r in rows}
    cut = Counter()
    for r in mixing.mixed_documents(documents(spark, rows)).collect():
        if r["text"] != texts[r["doc_id"]]:
            cut[r["source"]] += 1
            assert all(p.strip() in texts[r["doc_id"]] for p in r["text"].split("\n\n"))
    assert all(n <= 2 for n in cut.values())


def test_a_blank_line_stands_for_what_is_left_out(spark):
    """One document in a source: its selected words may be its two ends."""
    wanted = set()
    for seed in range(4):
        rows = [(i, " ".join(f"{s}{j}" for j in range(640)), "en", s, 0) for i, s in enumerate("abc")]
        for r in mixing.mixed_documents(documents(spark, rows), seed=seed).collect():
            parts = [p.strip() for p in r["text"].split("\n\n")]
            whole = dict((x[0], x[1]) for x in rows)[r["doc_id"]]
            assert len(parts) <= 2 and all(p in whole for p in parts)
            wanted.add(len(parts))
    assert 2 in wanted


def test_tables_without_words(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    (row,) = mixing.mix(documents(spark, [(1, None, None, None, None)])).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)
    assert mixing.mixed_documents(documents(spark, [(1, "", None, None, 0)])).collect() == []


def test_targets_for_many_sources(spark):
    sizes = {f"s{i}": (i * 37) % 101 for i in range(50)} | {None: 11}
    rows = [(s, n, 1) for s, n in sizes.items()]
    df = stored(spark.createDataFrame(rows, "source string, source_size long, source_rows long"))
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))
