"""WARC fixity audit by Merkle trees over ordered offset ranges.

Each record is hashed with its place. A range of `span` bytes of a file hashes the records that
begin in it, in order; a range of the next level hashes `fan` ranges; the root covers the file.
Replicas are compared from the roots, and only ranges whose hashes differ are looked into, so
the audit of sound files ends at their roots. Where bytes went missing or came in, all later
offsets differ: records of differing ranges are first told by their digests, so that only what was
lost, added or changed is reported, not what stands elsewhere because of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import leaves_result_only, settle

SPAN = 1 << 16
FAN = 16


def warc_record(uri: Column, record_id: Column, payload: Column) -> Column:
    """A WARC/1.0 resource record as text; nulls are empty."""
    uri, record_id, payload = (F.coalesce(x.cast("string"), F.lit("")) for x in (uri, record_id, payload))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-record:"), record_id,
        F.lit(">\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"),
    )


def leaves(records: DataFrame, file: str, order: str, record_id: str, record: str) -> DataFrame:
    """(file, offset, length, record_id, digest) of records in file order; offsets are running byte sums.

    Only lengths and digests are sorted, not records. Records of equal order go by digest; null
    orders come first. Null records are empty; a null file is a file.
    """
    body = F.coalesce(F.col(record).cast("string"), F.lit(""))
    rows = records.select(
        F.col(file).alias("file"), F.col(order).alias("order_"), F.col(record_id).alias("record_id"),
        F.octet_length(body).cast("bigint").alias("length"), F.sha2(body, 256).alias("digest"),
    )
    placed = running(settle(rows), "length", ["order_", "digest"])
    return placed.select("file", "record_id", "length", "digest", F.col("before").alias("offset"))


def running(rows: DataFrame, value: str, order: list[str]) -> DataFrame:
    """rows with `before`, the sum of a column over the rows of the same file that come earlier in order (nulls first).

    Sums go over pieces of a file and then over the pieces' sums, so no file is brought into one task.
    """
    pieces = settle(rows.repartitionByRange("file", *order).withColumn("piece", F.spark_partition_id()))
    first = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.groupBy("file", "piece").agg(F.sum(value).alias("all_"))
    base = settle(sums.select(F.col("file").alias("f_"), F.col("piece").alias("p_"), F.coalesce(F.sum("all_").over(first("file").orderBy("piece")), F.lit(0).cast("bigint")).alias("base_")))
    out = pieces.join(base, pieces["file"].eqNullSafe(base["f_"]) & (pieces["piece"] == base["p_"]))
    here = F.coalesce(F.sum(value).over(first("file", "piece").orderBy(*order)), F.lit(0).cast("bigint"))
    return out.withColumn("before", F.col("base_") + here).drop("f_", "p_", "base_", "piece")


def tree(rows: DataFrame, span: int = SPAN, fan: int = FAN) -> list[DataFrame]:
    """Levels of (file, node, hash) from the ranges of `span` bytes up to one node for each file."""
    join = lambda x: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(x)), lambda s: s["h"]), "|"), 256)
    # Any number of empty records can begin at one offset; they are alike and count as one leaf.
    empty = rows.where("length = 0").groupBy("file", "offset", "length", "digest").agg(F.count("*").alias("n"))
    each = rows.where("length > 0").select("file", "offset", "length", "digest", F.lit(1).cast("bigint").alias("n")).unionByName(empty)
    leaf = F.sha2(F.concat_ws(":", "offset", "length", "digest", "n"), 256)
    level = each.groupBy("file", F.expr(f"offset div {span}").alias("node")).agg(join(F.struct("offset", "length", leaf.alias("h"))).alias("hash"))
    levels = [settle(level)]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    while top > 0:
        level = levels[-1].groupBy("file", F.expr(f"node div {fan}").alias("up")).agg(join(F.struct("node", F.concat_ws(":", "node", "hash").alias("h"))).alias("hash"))
        levels.append(settle(level.withColumnRenamed("up", "node")))
        top //= fan
    return levels


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes of either level whose hashes differ or that only one has."""
    x, y = a.alias("x"), b.alias("y")
    same = F.lit(True)
    for k in keys:
        same &= F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
    both = x.join(y, same, "full").where(~F.col("x.hash").eqNullSafe(F.col("y.hash")))
    return both.select(*[F.coalesce(f"x.{k}", f"y.{k}").alias(k) for k in keys])


def _met(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with `turn`, their place among those of their side and keys, and `met`: whether the other side has one at that place."""
    side = Window.partitionBy(*keys, "right").orderBy("offset", "length", "digest", "record_id")
    whole = Window.partitionBy(*keys)
    rows = rows.withColumns({"turn": F.row_number().over(side), "l_": F.count_if(~F.col("right")).over(whole), "r_": F.count_if("right").over(whole)})
    return settle(rows.withColumn("met", F.col("turn") <= F.least("l_", "r_")).drop("l_", "r_"))


def _paired(rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """Rows that met, both sides in one: file and structs x (left) and y (right)."""
    of = lambda side: F.max(F.when(side, F.struct(*columns)))
    return rows.where("met").groupBy(*keys, "turn").agg(of(~F.col("right")).alias("x"), of(F.col("right")).alias("y"))


def _compare(both: DataFrame) -> DataFrame:
    """What became of the records of both sides' differing ranges, both(file, offset, length, record_id, digest, right)."""
    found = ["file", "offset", "record_id", "status", "left_digest", "right_digest"]
    # By bytes: first those of one id, then any; what met is whole.
    named = _met(both, ["file", "digest", "record_id"])
    alike = _met(named.where("not met").drop("turn", "met"), ["file", "digest"])
    rest = alike.where("not met").drop("turn", "met")
    # The others are altered records by id, or else by place.
    by_id = _met(rest.where("record_id is not null"), ["file", "record_id"])
    rest = rest.where("record_id is null").unionByName(by_id.where("not met").drop("turn", "met"))
    by_place = _met(rest.withColumn("empty", F.col("length") == 0), ["file", "offset", "empty"])
    altered = _paired(by_id, ["file", "record_id"], "offset", "record_id", "digest").select("file", "x", "y")
    altered = altered.unionByName(_paired(by_place, ["file", "offset", "empty"], "offset", "record_id", "digest").select("file", "x", "y"))
    altered = altered.select("file", "x.offset", F.coalesce("x.record_id", "y.record_id").alias("record_id"), F.lit("altered").alias("status"), F.col("x.digest").alias("left_digest"), F.col("y.digest").alias("right_digest"))
    gone = ~F.col("right")
    alone = by_place.where("not met").select(
        "file", "offset", "record_id", F.when(gone, "missing").otherwise("extra").alias("status"), F.when(gone, F.col("digest")).alias("left_digest"), F.when(~gone, F.col("digest")).alias("right_digest")
    )
    # Whole records keep their place among the whole ones, wherever bytes came in or went; else they were moved.
    whole = named.where("met").withColumns({"id": F.col("record_id"), "named": F.lit(True)})
    whole = whole.unionByName(alike.where("met").withColumns({"id": F.lit(None).cast(both.schema["record_id"].dataType), "named": F.lit(False)}))
    whole = settle(whole.withColumn("one", F.lit(1).cast("bigint")))
    order = ["offset", "length", "record_id", "turn"]
    ranked = running(whole.where("right"), "one", order).unionByName(running(whole.where("not right"), "one", order))
    moved = _paired(ranked, ["file", "digest", "id", "named"], "before", "offset", "record_id").where("x.before <> y.before")
    moved = moved.select("file", "x.offset", "x.record_id", F.lit("moved").alias("status"), F.col("digest").alias("left_digest"), F.col("digest").alias("right_digest"))
    return altered.select(found).unionByName(alone.select(found)).unionByName(moved.select(found))


@leaves_result_only
def audit(left: DataFrame, right: DataFrame, span: int = SPAN, fan: int = FAN) -> DataFrame:
    """(file, offset, record_id, status, left_digest, right_digest): every record in which two replicas' leaves() differ.

    status is altered (a record of one id, or else of one place, with other bytes), missing (only
    left has it), extra (only right has it) or moved (whole, but at another place among the whole
    ones). offset is that of the left replica, of the right one for extra records. Records that
    stand elsewhere only because bytes before them came in or went missing are not reported. Sound
    replicas give an empty table, as two empty ones do. A file that one replica lacks is reported record by record.
    """
    a, b = settle(left), settle(right)
    up, down = tree(a, span, fan), tree(b, span, fan)
    empty = up[0].limit(0)
    while len(up) < len(down):
        up.append(_grown(up[-1], fan) if up else empty)
    while len(down) < len(up):
        down.append(_grown(down[-1], fan))
    bad = None
    for x, y in zip(reversed(up), reversed(down), strict=True):
        if bad is not None:
            at = bad.withColumnRenamed("file", "f").withColumnRenamed("node", "n")
            hit = lambda t: t.join(at, t["file"].eqNullSafe(at["f"]) & (F.expr(f"node div {fan}") == at["n"]), "left_semi")  # noqa: B023, E731
            x, y = hit(x), hit(y)
        bad = settle(_differing(x, y, ["file", "node"]))
    at = bad.withColumnRenamed("file", "f").withColumnRenamed("node", "n")
    hit = lambda t: t.join(at, t["file"].eqNullSafe(at["f"]) & (F.expr(f"offset div {span}") == at["n"]), "left_semi")
    sides = hit(a).withColumn("right", F.lit(False)).unionByName(hit(b).withColumn("right", F.lit(True)))
    return _compare(settle(sides.select("file", "offset", "length", "record_id", "digest", "right")))


def _grown(level: DataFrame, fan: int) -> DataFrame:
    """A level above the lower tree's top, so that both trees have the same height."""
    up = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", F.concat_ws(":", "node", "hash").alias("h")))), lambda s: s["h"]), "|"), 256)
    return settle(level.groupBy("file", F.expr(f"node div {fan}").alias("up")).agg(up.alias("hash")).withColumnRenamed("up", "node"))
