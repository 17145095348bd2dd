"""Readers of raw files by format, and gates that raw files must pass."""

from __future__ import annotations

import json
import logging
import time
import xml.etree.ElementTree as ElementTree
from collections import OrderedDict
from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.temporal import in_months, within
from lakeloom.operators.validate import ValidationError, check_required
from lakeloom.plans.contract import Feed
from lakeloom.plans.spans import Days
from lakeloom.sources.sinks import RawFolder


log = logging.getLogger(__name__)


def location(root: str, source: Feed) -> str:
    return "/".join(x.strip("/") if i else x.rstrip("/") for i, x in enumerate((root, source.path, source.glob)) if x)


def read_csv(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """All columns as text: types are the contract's, and inference would read offset-less times as UTC."""
    return spark.read.options(**({"header": "true", "sep": ";", "mode": "PERMISSIVE"} | dict(options))).csv(path)


def read_envelope(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """JSON records whose raw_value holds {"payload": {...}} as text; the payload's fields become columns.

    The fields are those of all payloads, or of options["schema"], a DDL string.
    """
    lines = spark.read.schema("raw_value string, bronze_ingested_at string").json(path).select("*", F.col("_metadata.file_path").alias("source_file"))
    payload = F.get_json_object("raw_value", "$.payload")
    schema = options.get("schema")
    if not schema:
        # As many rows as there are fields reach the driver, in the order that payloads have them.
        keys = lines.select(F.posexplode(F.json_object_keys(payload)).alias("at", "field")).groupBy("field").agg(F.min("at").alias("at"))
        fields = [r["field"] for r in keys.orderBy("at", "field").collect()] or ["_none"]
        schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    kept = lines.withColumn("payload", F.from_json(payload, schema))
    return kept.select("payload.*", "bronze_ingested_at", "source_file")


def read_arrays(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """JSON documents of parallel arrays, with partition folders below options["base"] as columns. Not exploded.

    A file is one document; with options["multiLine"] "false", every line is one.
    """
    reader = spark.read.option("multiLine", options.get("multiLine", "true"))
    if options.get("base"):
        reader = reader.option("basePath", options["base"])
    return reader.json(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def read_xml(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    reader = spark.read.option("rowTag", options.get("row", "Point"))
    if options.get("schema"):
        reader = reader.schema(options["schema"])
    return reader.xml(path)


FORMATS: dict[str, Callable[[SparkSession, str, Mapping[str, str]], DataFrame]] = {
    "csv": lambda s, p, o: read_csv(s, p, o).select("*", F.col("_metadata.file_path").alias("source_file")),
    "json_envelope": read_envelope,
    "json_arrays": read_arrays,
    "xml": read_xml,
}


def read_source(spark: SparkSession, root: str, source: Feed) -> DataFrame | None:
    """The source's rows, None if nothing is there. An unknown format, a missing field or an unreadable file raise."""
    if source.format not in FORMATS:
        raise ValidationError(f"{source.name}: unknown format {source.format}")
    try:
        df = FORMATS[source.format](spark, location(root, source), source.options)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    check_required(df, source)
    return df


def read_window(spark: SparkSession, path: str, window: Days, ts: str = "ts_utc") -> DataFrame:
    """Rows of a window from a table by year and month: partitions are pruned, the range reaches the files."""
    return spark.read.parquet(path).where(in_months(window)).where(within(F.col(ts), window))


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A Parquet table, or an empty one of this schema if it isn't there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def envelope(columns: list[str], meta: Mapping[str, str]):
    """A record as {"_meta": ..., "payload": ...}; the payload is as received."""
    head = F.struct(*[F.lit(v).alias(k) for k, v in meta.items()])
    return F.to_json(F.struct(head.alias("_meta"), F.struct(*columns).alias("payload")))


def describe_schema(df: DataFrame) -> list[tuple[str, str, str]]:
    """(field, type, class by the name's prefix) of every field."""
    kinds = {"date": "time", "heure": "time", "ts": "time", "code": "dimension", "lib": "dimension", "nom": "dimension"}
    return [(f.name, f.dataType.simpleString(), next((k for p, k in kinds.items() if f.name.lower().startswith(p)), "measure")) for f in df.schema]


def gate_csv(body: bytes, least_bytes: int = 1024, least_lines: int = 2000) -> None:
    if len(body) < least_bytes or body.count(b"\n") < least_lines:
        raise ValidationError(f"{len(body)} bytes, {body.count(10)} lines: fewer than {least_bytes} and {least_lines}")


def gate_arrays(document: Mapping, series: str = "hourly", most_null: float = 0.1) -> None:
    """Arrays of one length with few nulls."""
    arrays = document.get(series) or {}
    lengths = {len(v) for v in arrays.values()}
    if len(lengths) != 1 or lengths == {0}:
        raise ValidationError(f"arrays of lengths {sorted(lengths)}")
    for name, v in arrays.items():
        if sum(x is None for x in v) > most_null * len(v):
            raise ValidationError(f"{name}: more than {most_null:.0%} null")


def gate_xml(body: bytes, tag: str = "Point", least: int = 500) -> None:
    n = sum(e.tag.rpartition("}")[2] == tag for e in ElementTree.fromstring(body).iter())
    if n < least:
        raise ValidationError(f"{n} {tag} elements, fewer than {least}")


def pull(get: Callable[[], tuple[int, bytes]], tries: int = 3, wait: float = 1.0, sleep=time.sleep) -> bytes:
    """The body of the first answer of status 200. Waits longer after each failure, longest where told to slow down (429)."""
    for i in range(tries):
        try:
            status, body = get()
        except OSError:
            status, body = 0, b""
        if status == 200:
            return body
        if i < tries - 1:
            sleep(wait * 2**i * (4 if status == 429 else 1))
    raise ValidationError(f"no answer after {tries} tries, last status {status}")


def pull_months(window: Days, folder: Callable[[int, int], RawFolder], get: Callable[[int, int], bytes], name: str, gate: Callable[[bytes], None] | None = None) -> list[str]:
    """Raw files of the window's months, one a month: those whose folder is complete are passed, others must pass the gate."""
    written = []
    for year, month in window.months():
        place = folder(year, month)
        if not place.complete():
            body = get(year, month)
            if gate:
                gate(body)
            written.append(place.put(name, body))
            place.finish()
    return written


def relay(records: Iterable[dict], send: Callable[[str, bytes], None], key: Callable[[dict], str], meta: Mapping[str, str] | None = None) -> int:
    """Send records, as they are, in envelopes by key; the number sent. A record is taken only once it is sent."""
    n = 0
    for r in records:
        send(key(r), json.dumps({"_meta": dict(meta or {}), "payload": r}, ensure_ascii=False).encode())
        n += 1
    return n


def optional_days(get: Callable[[], bytes]) -> list[str]:
    """The days that a JSON object has as keys, in order. Without an answer, none and a warning: features go on without."""
    try:
        return sorted(json.loads(get()))
    except (OSError, ValueError) as e:
        log.warning("days left out: %s", e)
        return []


def poll(page: Callable[[int, int], list[dict]], wanted: Callable[[dict], bool], key: Callable[[dict], str], seen: Seen, size: int = 100) -> Iterable[dict]:
    """New wanted records, newest page first, until a page is short or all its wanted records are known; pages without any are passed."""
    at = 0
    while True:
        rows = page(at, size)
        some = [r for r in rows if wanted(r)]
        fresh = [r for r in some if key(r) not in seen]
        for r in fresh:
            yield r
            seen.add(key(r))  # only after the caller has taken it
        if len(rows) < size or (some and not fresh):
            return
        at += size


class Seen:
    """The last so many keys. Spares repeated sends; does not promise uniqueness."""

    def __init__(self, most: int = 10_000):
        self.most, self.keys = most, OrderedDict()

    def __contains__(self, key: str) -> bool:
        if key in self.keys:
            self.keys.move_to_end(key)
            return True
        return False

    def add(self, key: str) -> None:
        self.keys[key] = None
        self.keys.move_to_end(key)
        if len(self.keys) > self.most:
            self.keys.popitem(last=False)
