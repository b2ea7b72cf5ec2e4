"""Differences between two snapshots of one entity.

A comparison stands every old row beside the new row with its key: one full outer
join, whatever the sizes. Each side is read and shuffled once. A caller that knows
a load to be tiny beside a large stored table may ask for ``small``, which gives
the same rows by joins that can broadcast the load and leave the old rows in place.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import row_fingerprint, row_hash
from .joins import named

# Bookkeeping columns of versioned rows, and change types.
START, END, CURRENT, HASH = "start_date", "end_date", "is_current", "hash_data"
AUDIT = (START, END, CURRENT, HASH)
CHANGE_TYPE = "_change_type"
INSERT, DELETE, UPDATE = "insert", "delete", "update"
PREIMAGE, POSTIMAGE = "update_preimage", "update_postimage"

COMMIT_VERSION = "_commit_version"

# In a comparison: the new row, and whether there is an old one. Of a key in a feed:
# the state it is left in, its place, and whether the feed has an old image.
NEW, OLD = "__new", "__old"
STATE, AT, HAD = "__state", "__at", "__had"
_SLOT, _AMONG, _TIMES, _KEY = "__slot", "__among", "__times", "__key"

# What errors of a running job begin with.
SHARED_KEY = "Several source rows share a key"
NO_ORDER = "Several new images of a key without an order"


def attribute_fields(
    df: DataFrame, keys: Sequence[str], ignore: Iterable[str] = ()
) -> list[T.StructField]:
    """Fields that describe the entity: neither key nor bookkeeping nor ignored.

    ``data_date`` is always ignored: it says when a row was loaded, so counting
    it would make every row change with every load.
    """
    skip = {c.lower() for c in (*keys, *AUDIT, CHANGE_TYPE, "data_date", *ignore)}
    return [f for f in df.schema if f.name.lower() not in skip]


def content_hash(fields: Sequence[T.StructField], kind: str = "exact") -> Column:
    """Hash of the attributes: ``exact`` tells all rows apart, ``concat`` is the
    dot-joined hash of :func:`row_hash`."""
    if kind == "exact":
        return row_fingerprint(fields)
    if kind == "concat":
        return row_hash([f.name for f in fields])
    raise ValueError(f"Unsupported hash: {kind}")


def hashed_pair(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    ignore: Iterable[str] = (),
    kind: str = "exact",
) -> tuple[DataFrame, DataFrame]:
    """Both snapshots with ``hash_data`` over the attributes of ``new``.

    ``new`` takes the types ``old`` has. A hash stored in ``old`` is used as it
    is when both sides have the same attributes; after a schema change it is
    computed again, so that a new column alone does not change every row. An
    attribute missing in ``old`` counts as NULL.
    """
    require_columns(old, keys)
    require_columns(new, keys)
    new = align_types(new, old)
    fields = attribute_fields(new, keys, ignore)
    had = {f.name.lower(): f for f in attribute_fields(old, keys, ignore)}
    for f in fields:
        if f.name.lower() not in had:
            old = old.withColumn(f.name, F.lit(None).cast(f.dataType))
    same_columns = had.keys() == {f.name.lower() for f in fields}
    if not (same_columns and HASH in old.columns):
        old = old.withColumn(HASH, content_hash(fields, kind))
    return old, new.withColumn(HASH, content_hash(fields, kind))


def align_types(df: DataFrame, model: DataFrame) -> DataFrame:
    """``df`` with the types ``model`` has for the columns both know.

    A column whose values the other type cannot hold is an error, not rounded.
    """
    kinds = {f.name.lower(): f.dataType for f in model.schema}
    lossy = [
        f"{f.name} ({f.dataType.simpleString()} to {kinds[f.name.lower()].simpleString()})"
        for f in df.schema
        if f.name.lower() in kinds and not _holds(kinds[f.name.lower()], f.dataType)
    ]
    if lossy:
        raise ValueError(f"Columns do not fit the types of the target: {', '.join(lossy)}")
    return df.select(
        *[
            _as_type(f, kinds[f.name.lower()]).alias(f.name)
            if kinds.get(f.name.lower(), f.dataType) != f.dataType
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


_SECOND = 1_000_000


def _as_type(field: T.StructField, target: T.DataType) -> Column:
    """A column in another type: the same value, or the same error, whatever the
    session's ANSI mode and time zone. Instants are written in UTC, and a date
    becomes midnight in UTC."""
    value, source = F.col(f"`{field.name}`"), field.dataType
    if isinstance(source, T.TimestampType) and isinstance(target, T.StringType):
        seconds = F.unix_micros(value).cast("decimal(20,0)") / F.lit(_SECOND).cast("decimal(7,0)")
        zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (zero + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("string")
    if isinstance(source, T.DateType) and isinstance(target, T.TimestampType):
        return F.timestamp_seconds(F.unix_date(value) * 86400)
    if not isinstance(source, T.AtomicType):
        return value.cast(target)
    tried = value.try_cast(target)
    message = f"A value of {field.name} does not fit {target.simpleString()}: "
    failed = F.raise_error(F.concat(F.lit(message), value.cast("string"))).cast(target)
    return F.when(value.isNotNull() & tried.isNull(), failed).otherwise(tried)


# Digits a whole number may have, by type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _holds(target: T.DataType, source: T.DataType) -> bool:
    """Whether values of one type can be written in the other. A whole number
    fits any other whole type as long as its value does; Spark checks that."""
    if target == source or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, T.AtomicType)
    if isinstance(source, T.StringType):
        return False
    whole = type(source) in _DIGITS
    if type(target) in _DIGITS:
        return whole
    if isinstance(target, T.DecimalType):
        if whole:
            return target.precision - target.scale >= _DIGITS[type(source)]
        return (
            isinstance(source, T.DecimalType)
            and target.scale >= source.scale
            and target.precision - target.scale >= source.precision - source.scale
        )
    if isinstance(target, T.DoubleType):
        return isinstance(source, T.FloatType) or (whole and _DIGITS[type(source)] <= 10)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(source, T.DateType)
    return not isinstance(source, T.AtomicType) and type(target) is type(source)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    known = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in known]
    if not columns or missing:
        raise ValueError(f"Key columns missing from the data: {missing or 'none given'}")


def _matches(keys: Sequence[str], left: str, right: str, null_safe: bool) -> Column:
    def same(c: str) -> Column:
        a, b = F.col(f"{left}.`{c}`"), F.col(f"{right}.`{c}`")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(and_, [same(c) for c in keys])


def _packed(new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``new`` as one struct column, so that it can stand beside ``old``."""
    wanted = {c.lower() for c in columns}
    return new.select(
        F.struct(*named(c for c in new.columns if c.lower() in wanted)).alias(NEW)
    )


def require_unique(
    df: DataFrame, keys: Sequence[str], null_safe: bool = False, by: Sequence[str] | None = None
) -> DataFrame:
    """The rows of ``df``; the job that reads them fails if two share a key. Rows
    without a key share none unless ``null_safe``.

    Rows are dealt by ``by``, the keys unless given, and a join on the same columns
    takes them as they lie, so the check costs no shuffle of its own there.
    """
    keyed, given = df, by is not None
    if not given:
        by = list(keys)
        if not null_safe:
            keyed, by = df.withColumn(_SLOT, _scatter(df.schema, keys, "")), [*by, _SLOT]
    counted = keyed.withColumn(_TIMES, F.count("*").over(Window.partitionBy(*named(by))))
    again = F.col(_TIMES) > 1
    if not null_safe:
        again = again & reduce(and_, [c.isNotNull() for c in named(keys)])
    message = F.concat(F.lit(f"{SHARED_KEY}, for example "), F.to_json(F.struct(*named(keys))))
    once = F.when(again, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.where(once).drop(_TIMES, *([] if given else [_SLOT]))


def with_replacement(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_safe: bool = False,
    among: Column | None = None,
) -> DataFrame:
    """Every row of ``old`` beside the listed columns of the row of ``new`` with
    its key, as the struct ``NEW``; that is NULL where ``new`` has no such row.
    With ``among`` only the old rows it holds for can have one."""
    left, on = _marked(old, among, _matches(keys, "o", f"n.{NEW}", null_safe))
    right = _packed(new, [*keys, *columns])
    return left.alias("o").join(right.alias("n"), on, "left").select("o.*", NEW).drop(_AMONG)


def _marked(old: DataFrame, among: Column | None, on: Column) -> tuple[DataFrame, Column]:
    if among is None:
        return old, on
    return old.withColumn(_AMONG, among), on & F.col(f"o.{_AMONG}")


def compared(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    small: bool = False,
    among: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """All rows of both sides: columns of ``old``, ``OLD`` where there is an old
    row, and the new row as the struct ``NEW``. With ``among`` only the old rows it
    holds for can meet a new one. With ``unique`` the job fails if two new rows share
    a key."""
    left = old.withColumn(OLD, F.lit(True))
    if small:
        new = require_unique(new, keys, null_safe) if unique else new
        kept = with_replacement(left, new, keys, new.columns, null_safe, among)
        seen = old if among is None else old.where(among)
        return kept.unionByName(_fresh(new, seen, keys, null_safe), allowMissingColumns=True)
    # The keys stand beside the struct too, so that rows dealt by them for the check
    # lie as the join wants them.
    beside = [f"{_KEY}{i}" for i in range(len(keys))]
    whole = F.struct(*named(new.columns)).alias(NEW)
    right = new.select(whole, *[F.col(f"`{c}`").alias(k) for c, k in zip(keys, beside, strict=True)])
    on = reduce(
        and_,
        [
            F.col(f"o.`{c}`").eqNullSafe(F.col(f"n.{k}")) if null_safe else F.col(f"o.`{c}`") == F.col(f"n.{k}")
            for c, k in zip(keys, beside, strict=True)
        ],
    )
    left, on = _marked(left, among, on)
    by = list(beside)
    if not null_safe:
        # Rows without a key match nothing, but would all hash to one partition.
        left = left.withColumn(_SLOT, _scatter(old.schema, keys, ""))
        right = right.withColumn(_SLOT, _scatter(new.schema, keys, f"{NEW}."))
        on = on & (F.col(f"o.{_SLOT}") == F.col(f"n.{_SLOT}"))
        by.append(_SLOT)
    if unique:
        right = require_unique(right, beside, null_safe, by)
    return left.alias("o").join(right.alias("n"), on, "full").drop(_SLOT, _AMONG, *beside)


def _scatter(schema: T.StructType, keys: Sequence[str], prefix: str) -> Column:
    """0, or for a row without a key a hash of its scalar columns. It depends on
    content alone, so a task that is run again sends each row where it went before."""
    unkeyed = reduce(or_, [F.col(f"{prefix}`{c}`").isNull() for c in keys])
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    scalars = [f.name for f in schema if not isinstance(f.dataType, nested)]
    spread = F.xxhash64(*[F.col(f"{prefix}`{c}`") for c in scalars])
    return F.when(unkeyed, spread).otherwise(F.lit(0).cast("long"))


def _fresh(
    new: DataFrame, old: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of a small ``new`` whose key ``old`` lacks, as ``NEW``.

    Only the few old keys that the load can meet are looked at.
    """
    on = _matches(keys, "s", "k", null_safe)
    met = new.select(*named(keys))
    seen = old.select(*named(keys)).alias("s").join(met.alias("k"), on, "left_semi")
    on = _matches(keys, f"n.{NEW}", "s", null_safe)
    whole = _packed(new, [*keys, *new.columns])
    return whole.alias("n").join(seen.alias("s"), on, "left_anti")


def gone() -> Column:
    return F.col(NEW).isNull()


def fresh() -> Column:
    return F.col(OLD).isNull()


def differs() -> Column:
    """The key is on both sides and the content is not the same."""
    return F.coalesce(F.col(HASH) != F.col(f"{NEW}.{HASH}"), F.lit(False))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``row_count``.

    Reads the key columns only and counts before it shuffles.
    """
    return df.groupBy(*named(keys)).agg(F.count("*").alias("row_count")).where("row_count > 1")


def classify(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    ignore: Iterable[str] = (),
    hash: str = "exact",
    null_safe: bool = False,
) -> DataFrame:
    """Each key with its ``change``: insert, delete, update or unchanged.

    Only keys and hashes are shuffled.
    """
    old, new = hashed_pair(old, new, keys, ignore, hash)
    narrow = [*named(keys), F.col(HASH)]
    pairs = compared(old.select(*narrow), new.select(*narrow), keys, null_safe)
    label = (
        F.when(gone(), DELETE)
        .when(fresh(), INSERT)
        .when(differs(), UPDATE)
        .otherwise("unchanged")
    )
    key = [F.when(fresh(), F.col(f"{NEW}.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in keys]
    return pairs.select(*key, label.alias("change"))


def changed_keys(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    ignore: Iterable[str] = (),
    hash: str = "exact",
    null_safe: bool = False,
) -> DataFrame:
    """Keys present in both snapshots with different content."""
    old, new = hashed_pair(old, new, keys, ignore, hash)
    on = _matches(keys, "o", "n", null_safe) & (F.col(f"o.{HASH}") != F.col(f"n.{HASH}"))
    narrow = [*named(keys), F.col(HASH)]
    left, right = old.select(*narrow).alias("o"), new.select(*narrow).alias("n")
    return left.join(right, on, "inner").select(*[F.col(f"o.`{c}`") for c in keys])


def change_feed(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    ignore: Iterable[str] = (),
    hash: str = "exact",
    null_safe: bool = False,
) -> DataFrame:
    """Row images that turn ``old`` into ``new``, tagged with ``_change_type``.

    Images have the columns of ``new``, then those that only ``old`` has.
    """
    given = {c.lower(): c for c in new.columns}
    kinds = {f.name: f.dataType for f in [*old.schema, *new.schema]}
    lost = [c for c in old.columns if c.lower() not in given and c not in AUDIT]
    columns = [*new.columns, *lost]
    old, new = hashed_pair(old, new, keys, ignore, hash)

    def image(after: bool, tag: str) -> Column:
        values = []
        for c in columns:
            if not after:
                value = F.col(f"`{c}`")
            elif c in lost:
                value = F.lit(None).cast(kinds[c])
            else:
                value = F.col(f"{NEW}.`{c}`")
            values.append(value.alias(c))
        return F.struct(*values, F.lit(tag).alias(CHANGE_TYPE))

    images = (
        F.when(gone(), F.array(image(False, DELETE)))
        .when(fresh(), F.array(image(True, INSERT)))
        .otherwise(F.array(image(False, PREIMAGE), image(True, POSTIMAGE)))
    )
    moved = compared(old, new, keys, null_safe).where(gone() | fresh() | differs())
    return moved.select(F.explode(images).alias("image")).select("image.*")


def _order(feed: DataFrame, version: str | None) -> tuple[str | None, Column, Column]:
    """The column that orders a feed, whether an image is a new one, and where an
    image stands among those of its key."""
    if version is None and COMMIT_VERSION in feed.columns:
        version = COMMIT_VERSION
    kind = F.col(CHANGE_TYPE)
    after = kind.isin(INSERT, POSTIMAGE)
    at = F.struct(
        (F.col(f"`{version}`") if version else F.lit(0)).alias("version"),
        F.when(after, 2).when(kind == DELETE, 1).otherwise(0).alias("step"),
    )
    return version, after, at


def unkeyed(keys: Sequence[str], null_safe: bool = False) -> Column:
    """Whether a row has no key, and so is no other row's version."""
    return F.lit(False) if null_safe else reduce(or_, [c.isNull() for c in named(keys)])


def feed_states(
    feed: DataFrame, keys: Sequence[str], null_safe: bool = False, version: str | None = None
) -> DataFrame:
    """One row per key of a feed: the key, the image the feed leaves it in as the
    struct ``STATE`` (NULL if it is gone), its place ``AT``, and ``HAD``: whether the
    feed gives an old image of the key. Rows without a key are left out.

    ``version`` names the column that orders the changes of a key, by default
    ``_commit_version`` if the feed has it; within one version a deletion comes
    before a new image. Without such a column all images are of one version. The job
    fails if a key has several new images in its last place.

    Images of one place combine before they are shuffled, then places do, so a key
    may hold any share of the feed.
    """
    version, after, at = _order(feed, version)
    columns = [c for c in feed.columns if c not in (CHANGE_TYPE, version)]
    timed = feed.where(~unkeyed(keys, null_safe)).withColumn(AT, at)
    places = timed.groupBy(*named(keys), AT).agg(
        F.first(F.when(after, F.struct(*named(columns)))).alias(STATE),
        F.count("*").alias(_TIMES),
        F.max(~after).alias(HAD),
    )
    states = places.groupBy(*named(keys)).agg(
        F.max(AT).alias(AT),
        F.max_by(F.struct(STATE, _TIMES), AT).alias("__last"),
        F.max(HAD).alias(HAD),
    )
    several = F.col(f"__last.{STATE}").isNotNull() & (F.col(f"__last.{_TIMES}") > 1)
    message = F.concat(F.lit(f"{NO_ORDER}, for example "), F.to_json(F.struct(*named(keys))))
    once = F.when(several, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    kept = states.where(once)
    return kept.select(*named(keys), F.col(f"__last.{STATE}").alias(STATE), AT, HAD)


def passed_images(
    feed: DataFrame,
    states: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    version: str | None = None,
) -> DataFrame:
    """New images of a feed that a later one of their key replaces."""
    version, after, at = _order(feed, version)
    on = _matches(keys, "f", "t", null_safe) & (F.col(f"f.{AT}") < F.col(f"t.{AT}"))
    new = feed.where(after & ~unkeyed(keys, null_safe)).withColumn(AT, at)
    met = new.alias("f").join(states.select(*named(keys), AT).alias("t"), on, "left_semi")
    return met.drop(AT, CHANGE_TYPE, *([version] if version else []))


def apply_change_feed(
    current: DataFrame,
    history: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    as_of: Column,
    null_safe: bool = False,
    version: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Current state and history after a feed.

    A key named in the feed leaves the current state and the last of its new images
    enters it, see :func:`feed_states`; several without an order are an error. Old
    images go to the history, closed at ``as_of``. A current row that a feed replaces
    without giving its old image goes there too. Images without a key replace
    nothing: new ones enter the state, old ones the history.

    The state is one full outer join of the current rows and the feed's states.
    """
    states = feed_states(feed, keys, null_safe, version)
    version, after, _ = _order(feed, version)
    extra = [CHANGE_TYPE, *([version] if version else [])]
    met = current.withColumn(OLD, F.lit(True)).alias("c")
    on = _matches(keys, "c", "t", null_safe)
    pairs = met.join(states.withColumn(_KEY, F.lit(True)).alias("t"), on, "full")
    image = {f.name.lower(): f.name for f in states.schema[STATE].dataType}
    columns = [*current.columns, *[c for k, c in image.items() if k not in {n.lower() for n in current.columns}]]

    def value(c: str) -> Column:
        new = F.col(f"t.{STATE}.`{image[c.lower()]}`") if c.lower() in image else F.lit(None)
        old = F.col(f"c.`{c}`") if c in current.columns else F.lit(None)
        return F.when(F.col(f"t.{_KEY}"), new).otherwise(old).alias(c)

    there = F.col(f"t.{STATE}").isNotNull() | F.col(f"t.{_KEY}").isNull()
    state = pairs.where(there).select(*[value(c) for c in columns])
    if not null_safe:
        loose = feed.where(unkeyed(keys) & after).drop(*extra)
        state = state.unionByName(loose, allowMissingColumns=True)

    closed = feed.where(~after).drop(*extra).withColumn(END, as_of)
    unseen = states.where(~F.col(HAD)).select(*named(keys)).alias("t")
    silent = current.alias("c").join(unseen, on, "left_semi").withColumn(END, as_of)
    past = history.unionByName(closed, allowMissingColumns=True)
    return state, past.unionByName(silent, allowMissingColumns=True)
