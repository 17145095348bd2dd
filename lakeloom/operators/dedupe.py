"""Duplicates resolved by quality: whole rows, or measure by measure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.scalars import lookup


def quality_rank(quality: Column, scale: Mapping[str, int], default: int = 99) -> Column:
    """Rank of a quality level, 1 best; default for unknown and null levels."""
    return lookup(scale, F.lower(quality), default).cast("int")


def quality_label(rank: Column, scale: Mapping[str, int], default: str | None = None) -> Column:
    return lookup({v: k for k, v in scale.items()}, rank, default)


def priority_order(rank: str = "quality_rank", at: str = "ingested_at", source: str = "source") -> list[Column]:
    return [F.col(rank).asc(), F.col(at).desc_nulls_last(), F.col(source).asc()]


def by_priority(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def by_merge(df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: Sequence[str]) -> DataFrame:
    """The first row of each key, each measure being the first that isn't null in the same order. One sort serves both."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = {m: F.first(m, ignorenulls=True).over(whole) for m in measures}
    return df.withColumns(best | {"_n": F.row_number().over(w)}).where("_n = 1").drop("_n")
