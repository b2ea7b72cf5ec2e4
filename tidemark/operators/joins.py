"""Equi-joins on named keys.

A key that holds a large part of a side's rows is left to adaptive execution, which
splits its partition in inner, left, right, semi and anti joins. It cannot do so in
a full outer join; a full join is therefore a left join and the unmatched rest.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HOW = {
    "inner": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}


def named(columns: Iterable[str]) -> list[Column]:
    """Columns by exact name, whatever characters it has."""
    return [F.col(f"`{c}`") for c in columns]


def join_on(
    df1: DataFrame, df2: DataFrame, join_cols: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join two frames on equally named keys and keep both sides' columns.

    The sides stay addressable as ``df1.<column>`` and ``df2.<column>``.
    """
    kind = _HOW.get(how.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"Unsupported join type: {how}")
    if not join_cols:
        raise ValueError("join_cols must name at least one column")
    left, right = df1.alias("df1"), df2.alias("df2")
    if kind != "full":
        return left.join(right, _same(join_cols), kind)
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in df1.schema]
    rest = right.join(left, _same(join_cols), "left_anti")
    unmatched = rest.select(*blank, *[F.col(f"df2.`{c}`") for c in df2.columns])
    return left.join(right, _same(join_cols), "left").union(unmatched)


def join_using(
    df1: DataFrame, df2: DataFrame, join_cols: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Like :func:`join_on`, but every key appears once, in front."""
    joined = join_on(df1, df2, join_cols, how)
    kind = _HOW[how.lower().replace("_", "")]
    if kind in ("left_semi", "left_anti"):
        return joined

    def key(c: str) -> Column:
        left, right = F.col(f"df1.`{c}`"), F.col(f"df2.`{c}`")
        if kind == "full":
            return F.coalesce(left, right).alias(c)
        return right if kind == "right" else left

    taken = {c.lower() for c in join_cols}
    rest = [F.col(f"df1.`{c}`") for c in df1.columns if c.lower() not in taken]
    rest += [F.col(f"df2.`{c}`") for c in df2.columns if c.lower() not in taken]
    return joined.select(*[key(c) for c in join_cols], *rest)


def _same(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"df1.`{c}`") == F.col(f"df2.`{c}`") for c in keys])
