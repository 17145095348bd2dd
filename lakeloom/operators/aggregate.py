"""Aggregates of series: resampling, weighted means, profiles, model errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hourly(df: DataFrame, ts: str, keys: Sequence[str], measures: Sequence[str], rank: str | None = None) -> DataFrame:
    """Means by hour and key, with the count of non-null values of the first measure and the worst quality."""
    extra = [F.max(rank).alias(rank)] if rank else []
    return df.groupBy(F.date_trunc("hour", F.col(ts).cast("timestamp")).cast("timestamp_ntz").alias("ts_hour"), *keys).agg(
        *[F.avg(m).alias(m) for m in measures], F.count(measures[0]).alias("n_points"), *extra
    )


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of values that aren't null, by weights renormalised over them; unknown weights are 0."""
    weight = F.coalesce(weight, F.lit(0.0))
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def share_of_total(df: DataFrame, by: str, value: str) -> DataFrame:
    """Each group's sum and its percentage of all. The grand total is one number, a scalar subquery: any number of groups stays spread."""
    sums = df.groupBy(by).agg(F.sum(value).alias("total"))
    return sums.withColumn("share_pct", 100 * F.col("total") / df.agg(F.sum(value)).scalar())


def error_metrics(actual: str, predicted: str) -> list[Column]:
    """MAE, RMSE, MAPE (where the actual value isn't 0) and bias of predictions, over rows that have both."""
    a, p = F.col(actual), F.col(predicted)
    e = p - a
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (100 * F.avg(F.when(a != 0, F.abs(e / a)))).alias("mape_pct"),
        F.avg(e).alias("bias"),
        F.count(e).alias("n"),
    ]


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts by equal bins from 0; values outside have bin -1 or `bins`, high itself the last bin."""
    v = F.col(value)
    at = F.when(v == high, bins - 1).otherwise(F.greatest(F.lit(-1), F.least(F.lit(bins), F.floor((v - low) / ((high - low) / bins)))))
    return df.where(v.isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def correlation(y: str, x: str) -> Column:
    return F.corr(y, x)


def slope(y: str, x: str, where: Column | None = None) -> Column:
    """Slope of y on x by least squares, over rows that meet a condition if there is one."""
    keep = (lambda c: F.col(c)) if where is None else (lambda c: F.when(where, F.col(c)))
    return F.regr_slope(keep(y), keep(x))


def profile(df: DataFrame, local: Column, value: str) -> DataFrame:
    """Mean and sample deviation by weekend or not and hour of local time."""
    weekend = F.dayofweek(local).isin(1, 7).alias("weekend")
    return df.groupBy(weekend, F.hour(local).alias("hour")).agg(F.avg(value).alias("mean"), F.stddev(value).alias("std"))


def extremes(item: str, value: str) -> list[Column]:
    """The item of the largest and of the least value; of equal ones, the least item."""
    return [F.max_by(item, F.struct(value, -F.col(item))).alias("top"), F.min_by(item, F.struct(value, item)).alias("low")]


def headline(value: str) -> list[Column]:
    return [F.sum(value).alias("total"), F.max(value).alias("top"), F.avg(value).alias("mean"), F.count("*").alias("n")]


def coverage(present: Column) -> list[Column]:
    """Rows that a left join found, all rows, and their ratio."""
    return [F.count_if(present).alias("n_matched"), F.count("*").alias("n_rows"), F.try_divide(F.count_if(present), F.count("*")).alias("coverage")]
