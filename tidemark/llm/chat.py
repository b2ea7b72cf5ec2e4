"""Chat formatting from every participant's side.

For each participant of a conversation the dialogue is rendered once, with that
speaker as the assistant, the others as named users, and the places of the
assistant's words as a mask. All of it is SQL functions over arrays of turns.

Long conversations are rendered in parts of a fixed range of turn numbers, and parts
with repeated or missing numbers in sections of as many turns, each a row, so no
conversation has to fit into one task or one string. The texts are shuffled once, by
conversation, part and section; participants are applied afterwards. Only turns of
parts with more than one section are sorted before, by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ordered, stored

TURNS = 64
SYSTEM = "system"

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _name(role: Column) -> Column:
    """A speaker's name without blanks; who has none is called ``unknown``."""
    name = F.regexp_replace(F.trim(role), r"[\x00-\x20<>|]+", "_")
    return F.when(F.coalesce(name, F.lit("")) == "", "unknown").otherwise(name)


def _body(text: Column) -> Column:
    """A turn's text; what looks like a control mark in it is broken up."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _sectioned(own: DataFrame, part: list[str], size: int) -> DataFrame:
    """Adds section: a turn's rank in its part, by turn, speaker and body, over
    ``size``. Parts of one section are told by their count, without their texts."""
    counts = own.groupBy(*part).agg(F.count("*").alias("n"))
    longer = stored(counts.where(F.col("n") > size).select(*part))
    # Equal turns of a hot part have places of their own, so they can be spread.
    over = own.join(longer, part, "left_semi").withColumn("at", F.monotonically_increasing_id())
    numbered = stored(ordered(stored(over), [*part, "turn", "speaker", "body", "at"], "number"))
    first = numbered.groupBy(*part).agg(F.min("number").alias("first"))
    section = F.floor((F.col("number") - F.col("first")) / size).cast("long")
    cut = numbered.join(first, part).select(*own.columns, section.alias("section"))
    rest = own.join(longer, part, "left_anti")
    return rest.withColumn("section", F.lit(0).cast("long")).unionByName(cut)


def perspectives(turns: DataFrame, per_part: int = TURNS) -> DataFrame:
    """Rows (conv_id, participant, part, section, turns, text, mask, trained) of
    conversations (conv_id, turn, role, text).

    ``text`` holds the section's turns in order of turn, role and text. ``mask`` lists
    the places, as ``start:end`` in characters of this text, of the participant's
    own words with their closing marks, and ``trained`` adds them up. Parts are
    numbered by turn number and cut into sections of ``per_part`` turns, which are
    several where numbers repeat; turns without a number form part -1, a null text is
    empty, a null conv_id is one conversation, repeated turns are rendered again.
    System turns stay system turns and are nobody's side: a conversation of those
    alone gives no row. Other columns are left aside.
    """
    own = turns.select(
        F.coalesce(turns["conv_id"].cast("string"), F.lit("")).alias("key"),
        turns["conv_id"].isNull().alias("none"),
        turns["conv_id"].alias("conv_id"),
        F.coalesce(F.floor(turns["turn"] / per_part), F.lit(-1)).cast("long").alias("part"),
        turns["turn"].alias("turn"),
        _name(turns["role"]).alias("speaker"),
        _body(turns["text"]).alias("body"),
    )
    where = ["key", "none", "part"]
    # Who takes part, by conversation, repeated for each of its parts. No texts.
    speakers = own.where(F.col("speaker") != SYSTEM).select("key", "none", "speaker").distinct()
    parts = own.select(*where).distinct()
    sides = parts.join(speakers, ["key", "none"]).groupBy(*where)
    sides = sides.agg(F.array_sort(F.collect_list("speaker")).alias("sides"))

    told = _sectioned(own, where, per_part).groupBy(*where, "section").agg(
        F.first("conv_id").alias("conv_id"),
        F.array_sort(F.collect_list(F.struct("turn", "speaker", "body"))).alias("told"),
    )
    seen = told.join(sides, where).select(
        "conv_id", "part", "section", "told", F.explode("sides").alias("participant")
    )

    side = F.col("participant")

    def heading(t: Column) -> Column:
        role = (
            F.when(t["speaker"] == side, F.lit("assistant"))
            .when(t["speaker"] == SYSTEM, F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user name="), t["speaker"]))
        )
        return F.concat(F.lit(OPEN), role, F.lit("\n"))

    def rendered(t: Column) -> Column:
        return F.concat(heading(t), t["body"], F.lit(f"{CLOSE}\n"))

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(heading(t))
        end = start + F.length(t["body"]) + F.lit(len(CLOSE))
        mine = t["speaker"] == side
        place = F.array(F.concat(start.cast("string"), F.lit(":"), end.cast("string")))
        return F.struct(
            (end + F.lit(1)).alias("at"),
            F.when(mine, F.concat(done["mask"], place)).otherwise(done["mask"]).alias("mask"),
            F.when(mine, done["trained"] + end - start).otherwise(done["trained"]).alias("trained"),
        )

    nothing = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<string>").alias("mask"),
        F.lit(0).alias("trained"),
    )
    shown = seen.withColumn("marks", F.aggregate("told", nothing, step))
    return shown.select(
        "conv_id",
        "participant",
        "part",
        "section",
        F.size("told").alias("turns"),
        F.array_join(F.transform("told", rendered), "").alias("text"),
        F.array_join("marks.mask", ",").alias("mask"),
        F.col("marks.trained").cast("long").alias("trained"),
    )
