"""A uniform shuffle into shards of exact size by a hypergeometric communication
matrix.

Rows are dealt into partitions by a hash. How many rows each partition sends to
each shard is drawn first, from the distribution that a uniform permutation of
all rows would give: row by row a multivariate hypergeometric draw from what the
shards still lack. Each partition then permutes its rows and deals them out by
these counts, and each shard permutes what it gets. The matrix has a fixed number
of entries; rows are numbered in buckets, so no task holds a partition or shard.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ranked, stored, text_of

SHARDS = 24
PARTITIONS = 256
SEED = 8


def hypergeometric(chance: random.Random, good: int, bad: int, draws: int) -> int:
    """How many good ones are among ``draws`` out of ``good + bad``: inversion from
    the most likely value outwards, so the work grows with the deviation only."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    likely = math.exp(
        log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws)
    )
    left = chance.random() - likely
    up = down = mode
    p_up = p_down = likely
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Row p: how many of partition p's rows go to each shard. Rows sum to
    ``counts``, columns to ``sizes``."""
    if sum(counts) != sum(sizes):
        raise ValueError("Partitions and shards must hold equally many rows")
    chance, left, out = random.Random(seed), list(sizes), []
    for n in counts:
        row, others = [], sum(left)
        for shard, size in enumerate(left):
            others -= size
            got = hypergeometric(chance, size, others, n)
            row.append(got)
            left[shard] -= got
            n -= got
        out.append(row)
    return out


def even_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def shuffled(
    rows: DataFrame,
    content: list[str],
    shards: int = SHARDS,
    partitions: int = PARTITIONS,
    seed: int = SEED,
) -> DataFrame:
    """Add shard and slot to stored rows; ``content`` names what makes up a row.
    Equal rows are interchangeable. Equal input gives equal output, whatever its
    partitions. Shard sizes are at most one apart; slots have no gap."""
    spark = rows.sparkSession

    def chance(salt: int) -> Column:
        return F.xxhash64(*content, F.lit(seed), F.lit(salt))

    dealt = rows.withColumn("p_part", F.pmod(chance(1), F.lit(partitions)).cast("int"))
    counted = {r[0]: r[1] for r in dealt.groupBy("p_part").count().collect()}  # ``partitions`` rows
    counts = [counted.get(p, 0) for p in range(partitions)]
    matrix = communication_matrix(counts, even_sizes(sum(counts), shards), seed)
    ends = [(p, [sum(row[: s + 1]) for s in range(shards)]) for p, row in enumerate(matrix)]
    schema = T.StructType(
        [T.StructField("m_part", T.IntegerType()), T.StructField("ends", T.ArrayType(T.LongType()))]
    )
    limits = F.broadcast(spark.createDataFrame(ends, schema))  # ``partitions`` rows

    permuted = ranked(
        dealt.withColumn("p_key", chance(2)), ["p_part"], chance(3), ["p_key", *content], "p_place"
    )
    sent = permuted.join(limits, F.col("p_part") == F.col("m_part")).select(
        *rows.columns,
        F.size(F.filter("ends", lambda end: end <= F.col("p_place"))).alias("shard"),
        chance(4).alias("p_key"),
    )
    arrived = stored(sent)
    placed = ranked(arrived, ["shard"], chance(5), ["p_key", *content], "slot")
    return placed.select(*rows.columns, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All documents in a uniform random order over ``shards`` shards, by the law
    ``rows``: doc_id, size (UTF-8 bytes and 8), text_crc32, law, shard, slot and
    grown_shard, which only the law ``key`` has.

    A null text has size 8 and the checksum of the empty text. Repeated rows and
    null ids are rows like others; an empty table stays empty.
    """
    data = F.encode(text_of(docs), "UTF-8")
    rows = stored(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            (F.octet_length(data) + 8).cast("long").alias("size"),
            F.crc32(data).alias("text_crc32"),
        )
    )
    content = ["doc_id", "size", "text_crc32"]
    return shuffled(rows, content, shards, seed=seed).select(
        *content,
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
