"""Idempotent writes: whole partitions are replaced, raw files appear at once or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeloom.plans.spans import Days


def with_partitions(df: DataFrame, ts: str = "ts_utc") -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def overwrite_partitions(df: DataFrame, path: str, parts: Sequence[str] = ("year", "month")) -> int:
    """Replace the partitions that occur in df and return the number of rows, counted by the write itself.

    Rows are brought together by partition in pieces of the size that adaptive execution advises,
    so a large partition is several files, written by several tasks. No rows: nothing changes.
    """
    seen = Observation()
    rows = df.hint("rebalance", *[F.col(p) for p in parts]).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return seen.get["n"]


def overwrite_months(df: DataFrame, path: str, window: Days, ts: str = "ts_utc") -> int:
    """overwrite_partitions() of whole months: a partial month would destroy its other rows."""
    if window != window.whole_months():
        raise ValueError(f"{window} is not whole months")
    return overwrite_partitions(with_partitions(df, ts), path)


def stamp(df: DataFrame, window: Days) -> DataFrame:
    return df.withColumns({"window_start": F.lit(window.start), "window_end": F.lit(window.end)})


def write_quarantine(df: DataFrame, path: str, window: Days) -> int:
    """Replace the run's quarantine, also by nothing: a sound replay leaves no old rejects behind."""
    run = f"{window.start}_{window.end}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/run_window={run}")
    return seen.get["n"]


class RawFolder:
    """Raw files on whatever file system the folder's address names, which all machines of a cluster see."""

    MARK = "_SUCCESS"

    def __init__(self, spark: SparkSession, folder: str):
        self.folder, self._path = folder.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.folder}/{name}")

    def complete(self) -> bool:
        return self._files.exists(self._at(self.MARK))

    def put(self, name: str, body: bytes) -> str:
        """A file that is there whole or not at all: written under another name, then renamed."""
        part, whole = self._at(f"{name}.part"), self._at(name)
        out = self._files.create(part, True)
        try:
            out.write(bytearray(body))
        finally:
            out.close()
        if self._files.exists(whole):
            self._files.delete(whole, False)
        if not self._files.rename(part, whole):
            raise OSError(f"{part.toString()} can't be renamed")
        return whole.toString()

    def finish(self) -> None:
        """Mark the folder as complete, after its last file."""
        self._files.create(self._at(self.MARK), True).close()
