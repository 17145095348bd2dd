"""Rows from columns, arrays and other sources; columns from rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.scalars import lookup
from lakeloom.plans.contract import Member, first_known


def union_sources(frames: Sequence[DataFrame], fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def unpivot(df: DataFrame, ids: Sequence[str], members: Sequence[Member], name: str, value: str, keep_bad: bool = True) -> DataFrame:
    """A row for each id and member with its value and the member's attributes; nulls go.

    Values are cast without raising. One that fails stays (null, with what was read) if keep_bad,
    so that validation sees it; a member that the source lacks gives no rows.
    """
    found = {m.name: c for m in members if (c := first_known((m.name, *m.candidates), df.columns))}
    if not found:
        raise ValueError("no member is a column")
    wide = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(n) for n, c in found.items()])
    rows = wide.unpivot(list(ids), list(found), name, "_raw_" + value).where(F.trim("_raw_" + value) != "")
    rows = rows.withColumn(value, F.col("_raw_" + value).try_cast("double"))
    if not keep_bad:
        rows = rows.where(F.col(value).isNotNull()).drop("_raw_" + value)
    return with_members(rows, members, name)


def with_members(df: DataFrame, members: Sequence[Member], name: str) -> DataFrame:
    of = lambda f: lookup({m.name: f(m) for m in members if f(m) is not None}, F.col(name))
    parents = {m.name: m.parent for m in members if m.parent}
    return df.withColumns(
        {
            "member_level": of(lambda m: m.level),
            "member_category": of(lambda m: m.category),
            "member_flag": of(lambda m: m.flag),
            "member_parent": lookup(parents, F.col(name)).cast("string"),
        }
    )


def explode_parallel(df: DataFrame, arrays: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """A row for each position of parallel arrays; shorter ones give nulls."""
    zipped = F.arrays_zip(*[c.alias(n) for n, c in arrays.items()])
    names = list(arrays)
    return df.select(*keep, F.inline(F.transform(zipped, lambda x: F.struct(*[x[n].alias(n) for n in names]))))


def pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], value: Column, extra: Sequence[Column] = ()) -> DataFrame:
    """A column for each listed value, whether or not it occurs, and other aggregates, in one aggregation."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(column) == v, value)).alias(str(v)) for v in values], *extra)
