"""Slowly changing dimensions of types 1, 2 and 4.

Every function maps DataFrames to a DataFrame and runs no action. ``as_of`` is
the one instant a load happens at: the ``end_date`` of a closed version equals
the ``start_date`` of the version that follows it. Source keys must be unique;
:func:`~tidemark.operators.changes.duplicate_keys` lists offenders.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import (
    AUDIT,
    CURRENT,
    END,
    HASH,
    NEW,
    START,
    align_types,
    attribute_fields,
    compared,
    content_hash,
    differs,
    fresh,
    gone,
    hashed_pair,
    require_columns,
    require_unique,
    with_replacement,
)


# The hash a version was stored with.
_STORED = "__stored"

# Of a row that a load gives: whether the load made it, and the table it goes to.
MOVED, TARGET = "__moved", "__target"


def _never(as_of: Column) -> Column:
    """NULL of the type of ``as_of``."""
    return F.nullif(as_of, as_of)


def _check_source(source: DataFrame, keys: Sequence[str]) -> None:
    """A source column with a bookkeeping name would be lost without a word."""
    require_columns(source, keys)
    taken = [c for c in source.columns if c.lower() in AUDIT]
    if taken:
        raise ValueError(f"Source columns with reserved names: {taken}")


def _opened(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumns({START: as_of, END: _never(as_of), CURRENT: F.lit(True)})


# -- type 1 -----------------------------------------------------------------


def scd1_merge(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    small: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Upsert: last write wins, rows only in the target stay.

    A matched row takes every source column, also where the source has NULL.
    Columns only the target knows keep their value; an inserted row has NULL in
    them. Columns only the source knows are added. With ``unique`` the job fails if
    two source rows share a key.
    """
    require_columns(source, keys)
    if target is None:
        return require_unique(source, keys, null_safe) if unique else source
    require_columns(target, keys)
    source = align_types(source, target)
    given = {c.lower(): c for c in source.columns}
    known = {c.lower() for c in target.columns}

    def merged(c: str) -> Column:
        if c.lower() not in given:
            return F.col(f"`{c}`")
        new = F.col(f"{NEW}.`{given[c.lower()]}`")
        old = F.col(f"`{c}`") if c.lower() in known else F.lit(None)
        return F.when(gone(), old).otherwise(new).alias(c)

    columns = [*target.columns, *[c for c in source.columns if c.lower() not in known]]
    pairs = compared(target, source, keys, null_safe, small, unique=unique)
    return pairs.select(*[merged(c) for c in columns])


# -- type 2 -----------------------------------------------------------------


def scd2_init(
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
) -> DataFrame:
    """First load: every source row is the open version of its key."""
    _check_source(source, keys)
    value = content_hash(attribute_fields(source, keys, ignore), hash)
    return _opened(source, as_of).withColumn(HASH, value)


def scd2_step(
    opened: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
    insert_new: bool = True,
    expire_missing: bool = False,
    null_safe: bool = False,
    small: bool = False,
    unique: bool = False,
    flag: bool = False,
) -> DataFrame:
    """What a load makes of the open versions: the versions open afterwards and
    those it has closed. Versions closed earlier take no part in a load. ``flag``
    adds ``MOVED``: whether the load opened or closed the version. With ``unique``
    the job fails if two source rows share a key.

    A key the target has never had opens a version unless ``insert_new`` is off;
    a key the source lacks stays open unless ``expire_missing`` is on.
    """
    return _scd2(
        opened, source, keys, as_of, ignore, hash, insert_new, expire_missing, null_safe, small,
        unique=unique, flag=flag,
    )


def _scd2(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str],
    hash: str,
    insert_new: bool,
    expire_missing: bool,
    null_safe: bool,
    small: bool = False,
    is_open: Column | None = None,
    unique: bool = False,
    flag: bool = False,
) -> DataFrame:
    """The versions after a load, in one pass over ``target``. With ``is_open``
    those it does not hold for come through as they are."""
    _check_source(source, keys)
    stays = F.lit(False) if is_open is None else ~is_open
    stored = F.col(HASH) if HASH in target.columns else F.lit(None).cast("string")
    kept = target.withColumn(_STORED, stored)
    kept, source = hashed_pair(kept, source, keys, [*ignore, _STORED], hash)
    columns = [c for c in kept.columns if c not in AUDIT and c != _STORED]
    supplied = {c.lower(): c for c in source.columns if c not in AUDIT}
    kinds = {f.name: f.dataType for f in kept.schema}

    closing = differs() | gone() if expire_missing else differs()
    closing = closing & ~stays

    def newer(c: str) -> Column:
        if c.lower() in supplied:
            return F.col(f"{NEW}.`{supplied[c.lower()]}`").alias(c)
        return F.lit(None).cast(kinds[c]).alias(c)

    def version(values, start: Column, end: Column, live: Column, h: Column, moved: Column) -> Column:
        audit = [start.alias(START), end.alias(END), live.alias(CURRENT), h.alias(HASH)]
        return F.struct(*values, *audit, *([moved.alias(MOVED)] if flag else []))

    before = version(
        [F.col(f"`{c}`") for c in columns],
        F.col(START),
        F.when(closing, as_of).otherwise(F.col(END)),
        F.when(stays, F.col(CURRENT)).otherwise(~closing),
        F.when(stays, F.col(_STORED)).otherwise(F.col(HASH)),
        closing,
    )
    after = version(
        [newer(c) for c in columns],
        as_of,
        _never(as_of),
        F.lit(True),
        F.col(f"{NEW}.{HASH}"),
        F.lit(True),
    )
    versions = F.when(differs(), F.array(before, after)).otherwise(F.array(before))
    if insert_new:
        pairs = compared(kept, source, keys, null_safe, small, is_open, unique)
        versions = F.when(fresh(), F.array(after)).otherwise(versions)
    else:
        source = require_unique(source, keys, null_safe) if unique else source
        pairs = with_replacement(kept, source, keys, source.columns, null_safe, is_open)
    return pairs.select(F.explode(versions).alias("v")).select("v.*")


def scd2_merge(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
    insert_new: bool = True,
    expire_missing: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """The whole table after a load: earlier closed versions and what
    :func:`scd2_step` gives, in one pass over the table."""
    if target is None:
        return scd2_init(source, keys, as_of, ignore, hash)
    is_open = F.coalesce(F.col(CURRENT), F.lit(False))
    return _scd2(
        target, source, keys, as_of, ignore, hash,
        insert_new, expire_missing, null_safe, is_open=is_open,
    )


# -- type 4 -----------------------------------------------------------------


def scd4_init(
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
) -> DataFrame:
    """First load of the current table, and of the history if it is seeded."""
    return scd2_init(source, keys, as_of, ignore, hash).drop(CURRENT)


def scd4_step(
    current: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
    null_safe: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Both results of a load from one comparison, told apart by ``TARGET``:
    ``current`` rows as :func:`scd4_current` gives them, ``history`` rows as
    :func:`scd4_history` does, each with NULL in columns only the other has.
    ``MOVED`` is whether the load made the row. Either side is read and shuffled
    once. With ``unique`` the job fails if two source rows share a key."""
    _check_source(source, keys)
    current, source = hashed_pair(current, source, keys, ignore, hash)
    given = {c.lower(): c for c in source.columns if c not in AUDIT}
    known = {c.lower(): c for c in current.columns if c not in AUDIT}
    kinds = {f.name.lower(): f.dataType for f in [*source.schema, *current.schema]}
    columns = [*given.values(), *[c for k, c in known.items() if k not in given]]

    def image(target: str, start: Column, end: Column, value: Column, moved: Column) -> Column:
        names = given if target == "current" else known
        side = f"{NEW}." if target == "current" else ""
        values = [
            (F.col(f"{side}`{names[c.lower()]}`") if c.lower() in names else F.lit(None).cast(kinds[c.lower()])).alias(c)
            for c in columns
        ]
        audit = [start.alias(START), end.alias(END), value.alias(HASH), moved.alias(MOVED)]
        return F.struct(F.lit(target).alias(TARGET), *values, *audit)

    moved = fresh() | differs()
    start = F.when(moved, as_of).otherwise(F.col(START))
    now = image("current", start, _never(as_of), F.col(f"{NEW}.{HASH}"), moved)
    old = image("history", F.col(START), as_of, F.col(HASH), F.lit(True))
    rows = F.when(gone(), F.array(old)).when(differs(), F.array(now, old)).otherwise(F.array(now))
    pairs = compared(current, source, keys, null_safe, unique=unique)
    return pairs.select(F.explode(rows).alias("v")).select("v.*")


def scd4_history(
    current: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
    null_safe: bool = False,
) -> DataFrame:
    """Rows a load appends to the history: current rows that the source deletes
    or updates, closed at ``as_of``. Of the source only keys and hash move."""
    _check_source(source, keys)
    current, source = hashed_pair(current, source, keys, ignore, hash)
    pairs = with_replacement(current, source, keys, [HASH], null_safe)
    return pairs.where(gone() | differs()).drop(NEW).withColumn(END, as_of)


def scd4_current(
    current: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    ignore: Iterable[str] = (),
    hash: str = "exact",
    null_safe: bool = False,
) -> DataFrame:
    """The current table after a load: the source itself. An unchanged row keeps
    its ``start_date``. Of the old table only keys, hash and that date move."""
    _check_source(source, keys)
    current, source = hashed_pair(current, source, keys, ignore, hash)
    pairs = with_replacement(source, current, keys, [HASH, START], null_safe)
    kept = F.coalesce(F.col(HASH) == F.col(f"{NEW}.{HASH}"), F.lit(False))
    return pairs.select(
        *[F.col(f"`{c}`") for c in source.columns if c not in AUDIT],
        F.when(kept, F.col(f"{NEW}.{START}")).otherwise(as_of).alias(START),
        _never(as_of).alias(END),
        HASH,
    )
