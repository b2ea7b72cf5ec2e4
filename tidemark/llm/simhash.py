"""SimHash fingerprints and their near duplicates through vantage-point trees.

Fingerprints that differ in at most ``distance`` bits are linked. Copies share a
fingerprint and meet before any search. The distinct ones are partitioned by
their Hamming distances to vantage points and compared only within a partition.

A tree over all 64 bits prunes badly: distances between unrelated fingerprints
crowd around 32, so a ball of radius 2 overlaps about a third of the shells of
each vantage point. Therefore each tree measures distance on a subset of the
bits. The bits are cut into ``distance + 1`` blocks; two linked fingerprints
agree in one block at least, so in that block's tree the radius is zero, the
triangle bound |d(v, x) - d(v, y)| <= 0 leaves a single branch, and nothing is
lost. Branches that are still large are split by distance over all bits, radius
``distance``: there a fingerprint is also sent to the neighbouring shell that its
ball may reach.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected
from .shared import python_ready, fresh, stored, text_of

SHINGLE = 3
DISTANCE = 2
SEED = 42
VANTAGE_POINTS = 8
LARGE_BRANCH = 2048
# Up to this size a branch is compared row by row, without a tree of its own.
SMALL_BRANCH = 64


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a whole text, A-Z lowered.

    A bit is set if it is set in over half of the shingles' hashes. A text with
    fewer words is one shingle; without words the fingerprint is zero.
    """
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    hashes = np.fromiter((digest(s, SEED) for s in joined), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return simhash(text)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def block_masks(distance: int) -> list[int]:
    """The 64 bits in ``distance + 1`` runs."""
    edges = [64 * i // (distance + 1) for i in range(distance + 2)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def branch(fp: Column, mask: int, points: list[int]) -> Column:
    """A tree's leaf: the distances, on the mask's bits, to all vantage points."""
    packed = F.lit(0).cast("long")
    for i, point in enumerate(points):
        away = F.bit_count(fp.bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.lit(_signed(point & mask))))
        packed = packed.bitwiseOR(F.shiftleft(away.cast("long"), 7 * i))
    return packed


def linked_pairs(fps, distance: int):
    """Links that join what is reachable among sorted distinct fingerprints, by a
    vantage-point tree: inner and outer part by the median distance to a vantage
    point, the inner one widened by ``distance`` so that no pair falls between."""
    import numpy as np

    left, right, waiting = [], [], [fps]
    while waiting:
        own = waiting.pop()
        if len(own) > 256:
            away = np.bitwise_count(own ^ own[0])
            middle = int(np.median(away))
            inner, outer = own[away <= middle + distance], own[away > middle]
            if len(inner) + len(outer) <= 1.5 * len(own) and max(len(inner), len(outer)) < len(own):
                waiting += [inner, outer]
                continue
        root = _reachable(own, distance)
        apart = root != np.arange(len(own))
        left.append(own[apart])
        right.append(own[root[apart]])
    return np.concatenate(left), np.concatenate(right)


def _reachable(own, distance: int):
    """For each of a set of fingerprints the first one reachable from it, by all
    distances in blocks, until no smaller one is found."""
    import numpy as np

    root, rows = np.arange(len(own)), max(1, (1 << 20) // max(1, len(own)))
    while True:
        found = root.copy()
        for at in range(0, len(own), rows):
            near = np.bitwise_count(own[at : at + rows, None] ^ own[None, :]) <= distance
            found[at : at + rows] = np.where(near, root[None, :], len(own)).min(axis=1)
        np.minimum.at(found, root, found.copy())  # a whole tree follows its root
        found = found[found]
        if (found == root).all():
            return root
        root = found


def _links(batches: Iterator, distance: int) -> Iterator:
    """Links within runs of equal (tree, leaf, shell) of a sorted partition."""
    import numpy as np
    import pyarrow as pa

    def out(a, b):
        return pa.RecordBatch.from_pydict(
            {"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))}
        )

    def settled(keys, fps):
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(keys)])
        run = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= SMALL_BRANCH, sizes)
        run_s, fps_s = run[small], fps[small]
        for shift in range(1, min(SMALL_BRANCH, int(sizes.max()))):
            same = run_s[shift:] == run_s[:-shift]
            if not same.any():
                break
            a, b = fps_s[shift:][same], fps_s[:-shift][same]
            near = (np.bitwise_count(a ^ b) <= distance) & (a != b)
            if near.any():
                yield out(a[near], b[near])
        for i in np.flatnonzero(sizes > SMALL_BRANCH):
            own = np.unique(fps[starts[i] : starts[i] + sizes[i]])
            a, b = linked_pairs(own, distance)
            if len(a):
                yield out(a, b)

    held: list[tuple] = []  # rows of the last run, which may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
        fps = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        if held and (held[0][0][0] == keys[-1]).all():
            held.append((keys, fps))
            continue
        held.append((keys, fps))
        keys, fps = np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held])
        last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1
        yield from settled(keys[:last], fps[:last])
        held = [(keys[last:], fps[last:])]
    if held:
        yield from settled(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))


def near_links(distinct: DataFrame, distance: int = DISTANCE, large: int = LARGE_BRANCH) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``, long): every pair
    within ``distance`` bits is joined by a chain of them."""
    chance = random.Random(SEED)
    trees = []
    for tree, mask in enumerate(block_masks(distance)):
        points = [chance.getrandbits(64) for _ in range(VANTAGE_POINTS)]
        trees.append(
            F.struct(F.lit(tree).alias("tree"), branch(F.col("fp"), mask, points).alias("leaf"))
        )
    placed = distinct.select("fp", F.explode(F.array(*trees)).alias("at")).select("at.*", "fp")
    placed = stored(placed)

    # Large branches are split by distance to one of their own members. A pair lies
    # in one shell or in two neighbouring ones, so each row also visits the shell
    # below its own.
    counted = placed.groupBy("tree", "leaf").agg(F.count("*").alias("n"), F.min("fp").alias("point"))
    heavy = counted.where(F.col("n") > large).drop("n")
    away = F.bit_count(F.col("fp").bitwiseXOR(F.col("point")))
    shell = F.floor(away / F.lit(distance + 1)).cast("long")
    shells = F.when(F.col("point").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.array(shell, shell - 1)
    )
    shards = placed.join(heavy, ["tree", "leaf"], "left").select(
        F.col("tree").cast("long"), "leaf", F.explode(shells).alias("shell"), "fp"
    )
    runs = shards.repartition("tree", "leaf", "shell").sortWithinPartitions("tree", "leaf", "shell", "fp")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return runs.mapInArrow(lambda batches: _links(batches, distance), schema)


def component_table(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component) for stored rows with a column ``fp``; the component is named
    by one of its fingerprints."""
    distinct = stored(prints.select("fp").distinct())
    roots = connected(near_links(distinct, distance))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("component")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id,
    the smallest doc_id that links lead to, itself included.

    Null and empty texts have fingerprint zero and are linked like others. Copies
    and repeated rows are members of their component; a null doc_id never names
    one. Other columns are left aside. An empty table stays empty.
    """
    python_ready(docs.sparkSession)
    prints = stored(
        docs.select(docs["doc_id"].alias("doc_id"), fingerprints(text_of(docs), shingle).alias("fp"))
    )
    groups = component_table(prints, distance)
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = groups.join(firsts, "fp")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents with one row left of each component: that with the smallest
    doc_id, rows without one last. All columns stay as they are."""
    python_ready(docs.sparkSession)
    fp, row = fresh(docs, "fp", "row")
    rows = stored(
        docs.withColumns(
            {fp: fingerprints(text_of(docs), shingle), row: F.monotonically_increasing_id()}
        )
    )
    narrow = rows.select(
        rows["doc_id"].alias("doc_id"), rows[fp].alias("fp"), rows[row].alias("row")
    )
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    by_print = narrow.groupBy("fp").agg(best)
    groups = component_table(narrow, distance)
    by_group = by_print.join(groups, "fp").groupBy("component").agg(F.min("best").alias("best"))
    kept = by_group.select(F.col("best.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])
