"""Time-offset windows: exact lags and leads, rolling statistics, top rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.temporal import epoch

HOUR = 3600
MICRO = 1_000_000


def series(keys: Sequence[str], ts: str):
    return Window.partitionBy(*keys).orderBy(epoch(F.col(ts)))


def at_offset(value: str | Column, keys: Sequence[str], ts: str, hours: int) -> Column:
    """The value at exactly that many hours from the row's instant (negative: before), null if there is none."""
    n = hours * HOUR
    return F.first(value).over(series(keys, ts).rangeBetween(n, n))


def offsets(df: DataFrame, keys: Sequence[str], ts: str, columns: Mapping[str, tuple[str, int]]) -> DataFrame:
    """All offsets in one select, which plans as one window."""
    return df.select("*", *[at_offset(v, keys, ts, h).alias(n) for n, (v, h) in columns.items()])


def rolling(value: str, keys: Sequence[str], ts: str, hours: int) -> tuple[Column, Column]:
    """Mean and sample deviation over the last hours, the row's own included."""
    w = series(keys, ts).rangeBetween(-(hours - 1) * HOUR, 0)
    return F.avg(value).over(w), F.stddev(value).over(w)


def rolling_open(value: str, keys: Sequence[str], ts: str, hours: int) -> Column:
    """Mean over (t - hours, t]."""
    w = Window.partitionBy(*keys).orderBy(F.unix_micros(F.col(ts).cast("timestamp")))
    return F.avg(value).over(w.rangeBetween(-hours * HOUR * MICRO + 1, 0))


def rolling_open_rows(df: DataFrame, value: str, keys: Sequence[str], ts: str, hours: int, name: str, span: int = 24) -> DataFrame:
    """df with rolling_open() as a column, in time that grows with the rows and not with a window's rows.

    Time is cut into blocks, `span` to a reach. A window is its own block up to the row, the span - 1 whole
    blocks before and the end of the block before those: a running sum forwards, sums by block and a running
    sum backwards. Sums are only added, never taken off again, so one huge, infinite or NaN value touches no
    window that it isn't in. Rows without a time are one another's window.
    """
    micros, step = F.unix_micros(F.col(ts).cast("timestamp")), hours * HOUR * MICRO // span
    place = F.pmod(micros, F.lit(step))
    block = F.call_function("div", micros - place, F.lit(step))
    number = F.col(value).cast("double")
    rows = df.withColumns({"block_": block, "place_": place, "n_": F.when(number.isNotNull(), 1).otherwise(0).cast("long"), "sum_": F.coalesce(number, F.lit(0.0))})
    series = rows.select(*keys, "block_", "place_", "n_", "sum_").where("block_ is not null")
    whole = series.groupBy(*keys, "block_").agg(F.sum("n_").alias("n_"), F.sum("sum_").alias("sum_"))
    whole = whole.withColumn("block_", F.explode(F.transform(F.sequence(F.lit(1), F.lit(max(span - 1, 1))), lambda i: F.col("block_") + i)))
    parts = rows.withColumn("part_", F.lit("own"))
    parts = parts.unionByName(series.withColumns({"block_": F.col("block_") + span, "part_": F.lit("end")}), allowMissingColumns=True)
    if span > 1:
        parts = parts.unionByName(whole.withColumns({"place_": F.lit(0).cast("long"), "part_": F.lit("whole")}), allowMissingColumns=True)
    group = Window.partitionBy(*keys, "block_")
    before = group.orderBy("place_").rangeBetween(Window.unboundedPreceding, 0)
    after = group.orderBy(F.desc("place_")).rangeBetween(Window.unboundedPreceding, -1)

    def within(c: str, none):
        end = F.sum(F.when(F.col("part_") == "end", F.col(c)).otherwise(none)).over(after)
        return F.sum(F.when(F.col("part_") != "end", F.col(c)).otherwise(none)).over(before) + F.coalesce(end, none)

    n, total = within("n_", F.lit(0)), within("sum_", F.lit(0.0))
    out = parts.withColumn(name, F.when(n > 0, total / n)).where("part_ = 'own'")
    return out.select(*[F.col(c) for c in df.columns if c != name], name)


def top_row(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """The first row of each key; `by` must leave no ties."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")
