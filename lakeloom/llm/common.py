"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, one of our own in
    local mode (tests); on a cluster a machine's folder would be lost to the others, so that raises."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = tempfile.mkdtemp(prefix="lakeloom-")
        spark.sparkContext.setCheckpointDir(place)
    return place.rstrip("/")


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Statements run inside give their shuffle files back when they end, not when the driver collects garbage."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)


def _delete(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Deletes at its end the tables settled inside, but for those settled with keep."""

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        Scratch._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch._open.remove(self)
        for path in self.paths:
            _delete(self.spark, path)


def settle(df: DataFrame, *, keep: bool = False, **options) -> DataFrame:
    """Write df as a Parquet table in the shared folder, with the writer's options, and read it again.

    This cuts the lineage: a lost executor costs the tasks it ran, not the steps before. Within a
    Scratch, the table is deleted at its end unless it is to be kept, for the next outer one if there is any.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lakeloom/{uuid.uuid4().hex}"
    owners = Scratch._open[: len(Scratch._open) - keep]
    if owners:
        owners[-1].paths.append(path)
    schema = df.schema
    with _shuffles_freed(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path)


def leaves_result_only(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator, of whose tables only the result stays; its first argument is a DataFrame."""

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **named) -> DataFrame:
        with Scratch(df.sparkSession):
            return settle(operator(df, *args, **named), keep=True)

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(rows: int, rows_per_part: int, least: int = 1) -> int:
    """Number of parts that hold about rows_per_part rows each."""
    return max(least, -(-int(rows) // rows_per_part))


class BucketedTable:
    """A table in the shared folder, bucketed by a column: joins on that column don't shuffle it."""

    def __init__(self, df: DataFrame, buckets: int, column: str):
        spark = df.sparkSession
        self.spark, self.name = spark, f"lakeloom_{uuid.uuid4().hex}"
        self.path = f"{shared_folder(spark)}/lakeloom/{self.name}"
        with _shuffles_freed(spark):
            df.write.bucketBy(buckets, column).sortBy(column).option("path", self.path).saveAsTable(self.name)
        self.df = spark.table(self.name)

    def drop(self) -> None:
        """Forget the table and delete its files; what was computed from it must be settled."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        _delete(self.spark, self.path)


def _add_up(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["counts"].iloc[0]) // 8, "<i8")
    for x in rows["counts"]:
        total += np.frombuffer(x, "<i8")
    return pd.DataFrame({"key": [rows["key"].iloc[0]], "slice": [rows["slice"].iloc[0]], "counts": [total.tobytes()]})


def add_counts(rows: DataFrame, width: int, slices: int = 16, fan_in: int = 64) -> dict[str, np.ndarray]:
    """Sums of rows(key, counts): count vectors of `width` little-endian 64-bit integers, by key.

    Each task hands in one vector for each key; slices of them are added in groups of fan_in until
    one is left. Keys are few (languages, say), so what reaches the driver has a fixed size.
    """
    step = width * 8 // slices
    cut = F.array(*[F.expr(f"substring(counts, {i * step + 1}, {step})") for i in range(slices)])
    left = rows.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    rows = rows.select("key", F.posexplode(cut).alias("slice", "counts"))
    schema = "key string, slice int, counts binary"
    while left > fan_in:
        left = parts_for(left, fan_in)
        part = F.pmod(F.xxhash64("counts"), F.lit(left))
        rows = settle(rows.withColumn("part", part).groupBy("key", "slice", "part").applyInPandas(_add_up, schema))
    out: dict[str, np.ndarray] = {}
    for r in rows.groupBy("key", "slice").applyInPandas(_add_up, schema).collect():
        out.setdefault(r["key"], np.zeros(width, np.int64))[r["slice"] * step // 8 : (r["slice"] + 1) * step // 8] = np.frombuffer(r["counts"], "<i8")
    return out


def tidy(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The step, after which the worker gives freed memory back: workers serve many tasks, and what
    their allocators hold on to adds up on an executor."""

    def run(batches: Iterator) -> Iterator:
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run
