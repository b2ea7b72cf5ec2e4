"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. Each source is cut into cells of some thousand documents, in the
order of a seeded hash, and a cell's documents, laid end to end, are cut into
blocks of equal length that run across documents. Blocks are apportioned to
sources, a source's blocks to its cells, and a cell takes its quota in whole
passes and one run of blocks from a seeded place. As documents lie in the order of
a hash, that run is a seeded choice of documents, and it cuts two of them at most.
All of it is arithmetic on sizes; no block ever becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, fresh, ordered, stored, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 64
CELL_ROWS = 4096
SEED = 20


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(
    sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Targets of stored rows (source, source_size): by code point of the source,
    null last, the weights repeat; each source gets its weight's share of ``share``
    times all words, at most ``most`` times its own. What is cut off goes to the
    others by weight, until no target is above. Adds weight and target."""
    named = sources.withColumns(
        {"is_null": F.col("source").isNull(), "at": F.col("source").cast("string").cast("binary")}
    )
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ordered(named, ["is_null", "at"], "place").select(
        "source",
        "source_size",
        "source_rows",
        F.get(cycle, (F.col("place") % len(weights)).cast("int")).alias("weight"),
    )
    weighed = stored(weighed)
    cap = F.col("source_size") * most
    total = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, None  # words per unit of weight; the number of full sources
    while True:
        capped = F.col("weight") * level > cap
        left = weighed.agg(
            F.sum(F.when(capped, cap).otherwise(0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
            F.count_if(capped),
        ).first()
        if full == left[2] or not left[1]:
            break
        level, full = (total - left[0]) / left[1], left[2]
    target = F.least(cap.cast("double"), F.col("weight") * level)
    return weighed.withColumn("target", target)


def apportion(df: DataFrame, group: list[str], weight: str, seats: str, key: list[str]) -> DataFrame:
    """Sainte-Laguë: the ``seats`` of each group go to the highest of the quotients
    weight / (2 s + 1), ties by ``key``. Returns key columns and ``quota``.

    A row's quota is near its exact share: with n rows in a group, no divisor lies
    further than n / 2 seats from the exact one. Only quotients within that bound
    are listed and ranked, a few per row; the seats below are certain.
    """
    whole = Window.partitionBy(*group)
    n, total = F.count("*").over(whole), F.sum(weight).over(whole)
    share = F.when(total > 0, F.col(seats) * F.col(weight) / total).otherwise(0.0)
    shared = df.withColumns({"n": n, "share": share})
    slack = F.ceil((F.col("share") * F.col("n") / F.greatest(F.col(seats), F.lit(1)) + 1) / 2) + 1
    low = F.greatest(F.lit(0), F.floor("share") - slack).cast("long")
    bounded = shared.withColumns({"low": low, "high": (F.floor("share") + slack).cast("long")})
    bounded = bounded.withColumn("open", F.col(seats) - F.sum("low").over(whole))
    listed = bounded.withColumn("s", F.explode(F.sequence("low", "high")))
    quotient = F.col(weight) / (2 * F.col("s") + 1)
    ranking = Window.partitionBy(*group).orderBy(quotient.desc(), *key)
    won = listed.withColumn("won", F.row_number().over(ranking) <= F.col("open"))
    return won.groupBy(*key).agg((F.min("low") + F.count_if("won")).alias("quota"))


def _row_key(docs: DataFrame, seed: int) -> Column:
    """Rows with one key agree in id, source and text, so their shares may be
    exchanged. Hashes pass over nulls, which therefore are told as such."""
    source = docs["source"]
    return F.xxhash64(docs["doc_id"], source, source.isNull(), text_of(docs), F.lit(seed))


def _cell(source_rows: Column, key: Column, cell_rows: int) -> Column:
    cells = F.greatest(F.lit(1).cast("long"), F.ceil(source_rows / cell_rows).cast("long"))
    return F.pmod(key, cells).cast("int")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Stored doc_id, source, size in words, and a seeded key of each document."""
    return stored(
        docs.select(
            docs["doc_id"].alias("doc_id"),
            docs["source"].alias("source"),
            word_count(text_of(docs)).alias("size"),
            _row_key(docs, seed).alias("key"),
        )
    )


def plan(
    rows: DataFrame,
    block: int = BLOCK,
    most: int = MOST,
    cell_rows: int = CELL_ROWS,
    seed: int = SEED,
    **how,
) -> DataFrame:
    """What the mix takes of each document.

    ``rows`` as from :func:`sized`. Adds source_size, target, whole (times that all
    words are taken), taken (words, repeats counted) and, for the selection within
    one further pass, start (the document's place in its cell), blocks, extra and
    turn (blocks of the cell, selected blocks, the first of these).

    A source's blocks are the quotients target / (2 s + 1) of at least half a
    block, which is Sainte-Laguë with the block as divisor.
    """
    sources = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    goals = stored(targets(stored(sources), most=most, **how))
    g = goals.withColumnRenamed("source", "goal")
    dealt = rows.join(g, rows["source"].eqNullSafe(g["goal"])).withColumn(
        "cell", _cell(F.col("source_rows"), F.col("key"), cell_rows)
    )
    spot = ["source", "cell"]
    cells = dealt.groupBy("source", "cell").agg(
        F.sum("size").alias("words"), F.max("target").alias("goal_words")
    )
    cells = cells.withColumn("seats", F.floor(F.col("goal_words") / block + 0.5).cast("long"))
    quotas = apportion(cells, ["source"], "words", "seats", spot)
    blocks = F.ceil(F.col("words") / block).cast("long")
    cells = cells.join(
        quotas.select(F.col("source").alias("q_source"), F.col("cell").alias("q_cell"), "quota"),
        F.col("source").eqNullSafe(F.col("q_source")) & (F.col("cell") == F.col("q_cell")),
    ).withColumn("blocks", blocks)
    quota = F.least("quota", F.col("blocks") * most)
    cells = cells.select(
        F.col("source").alias("c_source"),
        F.col("cell").alias("c_cell"),
        "blocks",
        F.when(F.col("blocks") > 0, F.expr("least(quota, blocks * %d) div blocks" % most))
        .otherwise(0)
        .alias("whole"),
        F.when(F.col("blocks") > 0, F.pmod(quota, F.col("blocks"))).otherwise(0).alias("extra"),
        F.when(F.col("blocks") > 0, F.pmod(F.xxhash64("source", "cell", F.lit(seed)), "blocks"))
        .otherwise(0)
        .alias("turn"),
    )
    before = Window.partitionBy(*spot).orderBy("key", "doc_id")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    joined = placed.join(
        cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell"))
    )
    part = selected_before(F.col("start") + F.col("size"), block) - selected_before(
        F.col("start"), block
    )
    return joined.withColumn("taken", F.col("whole") * F.col("size") + part).select(
        *rows.columns,
        "source_size",
        "target",
        "whole",
        "taken",
        "start",
        "blocks",
        "extra",
        "turn",
    )


def chosen_blocks(at: Column, of=F.col) -> Column:
    """How many of a cell's first ``at`` blocks are selected: the ``extra`` blocks
    from block ``turn`` on, which go on at the cell's first block after its last."""
    end = of("turn") + of("extra")
    run = F.greatest(F.least(at, end) - of("turn"), F.lit(0))
    return (run + F.least(at, F.greatest(end - of("blocks"), F.lit(0)))).cast("long")


def selected_before(at: Column, block: int) -> Column:
    """How many of the first ``at`` words of a cell lie in selected blocks."""
    nth = F.floor(at / block).cast("long")
    first = chosen_blocks(nth)
    return first * block + (chosen_blocks(nth + 1) - first) * (at - nth * block)


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken.

    Null texts have size 0 and nothing of them is taken; a null source is a source
    of its own, the last one; repeated rows are documents of their own; a table
    without words gives targets 0. Equal input gives equal output, whatever its
    partitions. Other columns are left aside.
    """
    return plan(sized(docs), **how).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED, **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document occurs once for each
    time that all of it is taken, and once more with the words of its selected
    blocks if only those are taken; where these are its beginning and its end, a blank
    line stands for what lies between. ``n_chars`` of such a row is set anew; all other
    columns are kept, nulls too. Documents of which nothing is taken go, and so do all
    without words; an empty table stays one. Rows that agree in id, source and text
    may get each other's shares, other rows never."""
    key, copy, m, part, time = fresh(docs, "key", "copy", "m", "part", "time")
    # Copies under one key are told apart by number.
    shares = plan(sized(docs, seed), block=block, seed=seed, **how)
    shares = shares.withColumn(
        "copy", F.row_number().over(Window.partitionBy("key").orderBy("doc_id", "start"))
    )
    shares = shares.where("taken > 0").select(
        F.col("key").alias(key),
        F.col("copy").alias(copy),
        F.struct("whole", "taken", "size", "start", "blocks", "extra", "turn").alias(m),
    )
    keyed = docs.withColumn(key, _row_key(docs, seed))
    keyed = keyed.withColumn(
        copy, F.row_number().over(Window.partitionBy(key).orderBy("doc_id"))
    )
    met = keyed.join(shares, [key, copy])

    def of(name: str) -> Column:
        return F.col(m)[name]

    rest = of("taken") - of("whole") * of("size")
    # Time 0 stands for the selected blocks, the others for the whole text.
    rows = met.withColumn(time, F.explode(F.sequence(F.lit(0).cast("long"), of("whole"))))
    rows = rows.where((F.col(time) > 0) | (rest > 0))
    words = F.regexp_extract_all(
        "text", F.lit(rf"(?:^[\x20\x09-\x0D]+)?{WORD}[\x20\x09-\x0D]*"), F.lit(0)
    )

    def chosen(late: bool) -> Column:
        """The selected words of the blocks from ``turn`` on, or of those before."""

        def picked(_: Column, i: Column) -> Column:
            nth = F.floor((of("start") + i) / block).cast("long")
            within = chosen_blocks(nth + 1, of) > chosen_blocks(nth, of)
            return within & ((nth >= of("turn")) == F.lit(late))

        return F.nullif(F.array_join(F.filter(words, picked), ""), F.lit(""))

    cut = (F.col(time) == 0) & (rest < of("size"))
    pieces = F.concat_ws("\n\n", chosen(late=False), chosen(late=True))
    out = rows.withColumn(part, F.when(cut, pieces))
    columns = []
    for field in docs.schema:
        c = F.col(f"`{field.name}`")
        if field.name == "text":
            c = F.coalesce(F.col(part), c)
        elif field.name == "n_chars":
            c = F.coalesce(F.length(part).cast(field.dataType), c)
        columns.append(c.alias(field.name))
    return out.select(*columns)
