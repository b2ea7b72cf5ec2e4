from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tidemark.llm import components, simhash

from .common import documents, odd_rows, tuples


def plain_fingerprint(text):
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    own = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance):
    """For each value the smallest index reachable from it."""
    values = np.array(values, dtype=np.uint64)
    root = np.arange(len(values))
    while True:
        found = np.array([root[np.bitwise_count(v ^ values) <= distance].min() for v in values], dtype=int)
        if (found == root).all():
            return root
        root = found


def crowd(seed, centres=40, around=25):
    """Fingerprints in clusters, chains and alone."""
    chance = random.Random(seed)
    out = []
    for _ in range(centres):
        own = chance.getrandbits(64)
        out.append(own)
        for _ in range(chance.randint(0, around)):
            for bit in chance.sample(range(64), chance.choice([1, 2, 3])):
                own ^= 1 << bit
            out.append(own)
    return out


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("clashing", [False, True])
def test_components_equal_brute_force(spark, clashing):
    rows = odd_rows()
    got = tuples(simhash.near_duplicates(documents(spark, rows, clashing)), "doc_id", "fingerprint", "component_id")
    prints = [plain_fingerprint(r[1]) for r in rows]
    root = plain_components(prints, 2)
    least = {}
    for r, own in zip(rows, root, strict=True):
        if r[0] is not None:
            least[own] = min(r[0], least.get(own, r[0]))
    want = [(r[0], f"{p:016x}", least.get(own)) for r, p, own in zip(rows, prints, root, strict=True)]
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
@pytest.mark.parametrize("large", [8, 2048])
def test_links_join_what_is_near(spark, distance, large):
    values = sorted(set(crowd(distance)))
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long").repartition(5)
    links = simhash.near_links(df, distance, large)
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") for r in links.collect())
    roots = {r["node"]: r["root"] for r in components.connected(links).collect()}
    ours = [roots.get(signed(v), signed(v)) for v in values]
    truth = plain_components(values, distance)
    assert len(set(ours)) == len(set(truth))
    assert len(set(zip(ours, truth, strict=True))) == len(set(truth))


def test_tree_inside_a_large_branch():
    chance = random.Random(9)
    centre = chance.getrandbits(64)
    near = {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)}
    far = {chance.getrandbits(64) for _ in range(900)}
    own = np.array(sorted(near | far), dtype=np.uint64)
    a, b = simhash.linked_pairs(own, 2)
    index = {int(v): i for i, v in enumerate(own)}
    parent = list(range(len(own)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in zip(a, b, strict=True):
        parent[find(index[int(x)])] = find(index[int(y)])
    truth = plain_components(own, 2)
    assert len({find(i) for i in range(len(own))}) == len(set(truth))


def test_links_do_not_grow_with_the_square_of_a_group(spark):
    centre = random.Random(2).getrandbits(64)
    values = {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)}
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    assert simhash.near_links(df, 2, 256).count() < 30 * len(values)


def test_one_of_each_group_stays(spark):
    rows = odd_rows()
    docs = documents(spark, rows, clashing=True)
    kept = simhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    root = plain_components([plain_fingerprint(r[1]) for r in rows], 2)
    best = {}
    for r, own in zip(rows, root, strict=True):
        key = (r[0] is None, r[0] or 0)
        best[own] = min(best.get(own, key), key)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert got == sorted(best.values())


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one(docs).collect() == []


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    roots = components.connected(links.repartition(7)).collect()
    assert len(roots) == 300 and {r["root"] for r in roots} == {0}
