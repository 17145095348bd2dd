"""Mixing sources to target weights: copies of documents by pivotal dependent rounding.

A source's documents all get the same expected number of copies, target / size of the source. Its
whole part is certain; its fraction is a probability. Documents are paired: words move at random
from one's probability to the other's, in the direction and amount that keep the source's expected
words and every expectation, until one of the two is integral. Blocks of documents do this on
their own: from the largest on, each is paired with all smaller ones of its block, taken as one,
as long as these can make it integral either way; then one by one. So a block leaves at most one
fractional document, and these meet in a tree of blocks. In the last block of a source, a document
that the smaller ones can't balance goes to the side that they can (its expectation alone is not
kept), so a source's taken words miss its target by about half of its smallest document.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import leaves_result_only, settle

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
#: Documents of a source that are rounded in one block, and open ones that meet in one of the next level.
BLOCK_ROWS = 512
FAN_IN = 512
SMALL = 1e-12


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share=SHARE, most=MOST) -> dict[str | None, Fraction]:
    """Each source's target: its share by weight of `share` times all sizes, at most `most` times its own.

    Sources come by code point, null last; weights repeat. What is above a cap goes to the others by weight.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    cap = {s: Fraction(most) * n for s, n in order}
    left, out = Fraction(share) * sum(n for _, n in order), {}
    open_ = {s for s, _ in order}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = cap[s]
            left -= cap[s]
        open_ -= over
    return out


def _draw(seed: int, *key) -> float:
    """A number in [0, 1) that depends on the key alone."""
    digest = hashlib.blake2b(repr((seed, *key)).encode(), digest_size=8).digest()
    return struct.unpack("<Q", digest)[0] / 2**64


def pivotal(keys, sizes, chances, seed: int) -> tuple[list[int], int | None, float]:
    """0 or 1 for each row, in order; the row still fractional, if any (its entry is -1), and its chance."""
    out = [-1] * len(keys)
    held, p = None, 0.0
    for i in range(len(keys)):
        q = chances[i]
        if q <= SMALL or q >= 1 - SMALL or sizes[i] == 0:
            out[i] = int(q >= 0.5)
            continue
        if held is None:
            held, p = i, q
            continue
        w, v = sizes[held], sizes[i]
        # Up: the held row gains what the other loses; down: the reverse. Both keep w * p + v * q.
        up = min((1 - p) * w, q * v)
        down = min(p * w, (1 - q) * v)
        move = up if _draw(seed, keys[held], keys[i]) * (up + down) < down else -down
        p, q = p + move / w, q - move / v
        ends_p = p <= SMALL or p >= 1 - SMALL
        ends_q = q <= SMALL or q >= 1 - SMALL
        if ends_p:
            out[held] = int(p >= 0.5)
        if ends_q:
            out[i] = int(q >= 0.5)
        if ends_p:
            held, p = (None, 0.0) if ends_q else (i, q)
    return out, held, p


def settle_block(keys, sizes, chances, seed: int, last: bool) -> tuple[list[int], int | None, float]:
    """0 or 1 for each row, largest first; the row still fractional, if any (its entry is -1), and its chance.

    A row's pool is all rows after it: what it gains or loses, they lose or gain in parts that
    keep every chance between 0 and 1, and the same parts either way, so that no expectation moves.
    """
    v, q = np.array(sizes, float), np.array(chances, float)
    out = [-1] * len(v)
    for i, w in enumerate(v):
        p, rest, chance = q[i], v[i + 1 :], q[i + 1 :]
        if p <= SMALL or p >= 1 - SMALL or w == 0:
            out[i] = int(p >= 0.5)
            continue
        give = np.minimum(chance, 1 - chance)
        pool = float(rest @ give)
        if max(p, 1 - p) * w <= pool:
            out[i] = int(_draw(seed, keys[i]) < p)
        elif not last:
            taken, held, p = pivotal(keys[i:], sizes[i:], q[i:].tolist(), seed)
            return out[:i] + taken, None if held is None else i + held, p
        else:
            # What the pool can lose and gain at most, and what it would lack if the row goes to 1 or 0.
            most, room = float(rest @ chance), float(rest @ (1 - chance))
            lack, over = max(0.0, (1 - p) * w - most), max(0.0, p * w - room)
            out[i] = int(_draw(seed, keys[i]) < p) if lack == over == 0 else int(lack < over)
            give, pool = (chance, most) if out[i] else (1 - chance, room)
        if pool > 0:
            moved = max(-1.0, min(1.0, (p - out[i]) * w / pool))
            q[i + 1 :] = np.clip(chance + moved * give, 0.0, 1.0)
    return out, None, 0.0


def _round_block(seed: int):
    def go(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key"], ascending=[False, True], kind="stable")
        keys, sizes, chances = (rows[c].tolist() for c in ("key", "size", "chance"))
        taken, held, p = settle_block(keys, sizes, chances, seed, rows["parts"].iloc[0] == 1)
        rows["extra"] = taken
        if held is not None:
            rows.iloc[held, rows.columns.get_loc("chance")] = p
        return rows[["group", "key", "size", "chance", "extra"]]

    return go


def sample_copies(rows: DataFrame, seed: int = 0) -> DataFrame:
    """(key, extra) for rows(group, key, size, chance): 0 or 1 with the given chances, in the tree of blocks.

    Within a group the sum of size * extra differs from that of size * chance by about half the
    size of its smallest row. A group has as many blocks as its rows need. key is unique and fixes
    the draw, so reruns agree. Rows of size 0 are rounded.
    """
    schema = "group long, key string, size long, chance double, extra int"
    level, decided, fan = rows.select("group", "key", "size", "chance"), [], BLOCK_ROWS
    while True:
        counts = level.groupBy("group").agg(F.expr(f"cast(ceil(count(*) / {fan}) as long)").alias("parts"))
        counts = settle(counts)
        most = counts.agg(F.max("parts")).first()[0] or 1
        blocks = settle(
            level.join(counts, "group")
            .withColumn("part", F.expr("pmod(xxhash64(key), parts)"))
            .groupBy("group", "part")
            .applyInPandas(_round_block(seed), schema)
        )
        decided.append(blocks.where("extra >= 0"))
        level, fan = blocks.where("extra < 0").drop("extra"), FAN_IN
        if most == 1:
            break
    out = decided[0]
    for x in decided[1:]:
        out = out.unionByName(x)
    return out.select("key", "extra")


def word_count(text):
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@leaves_result_only
def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, seed: int = 0) -> DataFrame:
    """(doc_id, nth, size, source_size, target, copies, taken, source), one row for each row of docs(doc_id, text, source, ...).

    size counts the text's words (null: 0); taken = size * copies. nth numbers rows that share a
    doc_id, largest first, from 0. Documents without words get 0 or 1 copies (they weigh nothing). A
    null doc_id or source is a value like others. An empty table gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    sized = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
        )
    )
    totals = settle(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    # One row for each source; their number is that of the mix's components, not of documents.
    known = [(r["source"], r["source_size"]) for r in totals.collect()]
    aims = targets(known, weights, share, most)
    plan = [(i, s, n, float(aims[s]), *_rate(aims[s], n)) for i, (s, n) in enumerate(sorted(known, key=lambda x: (x[0] is None, x[0] or "")))]
    plan = spark.createDataFrame(plan, "group long, source string, source_size long, target double, whole long, chance double")
    # Rows alike are counted first: what is left of a number, or of rows without one, are its sizes and sources.
    alike = settle(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("alike")))
    turn = Window.partitionBy("doc_id").orderBy(F.desc("size"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("alike").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    rows = alike.withColumn("before", before).withColumn("nth", F.explode(F.expr("sequence(before, before + alike - 1)"))).drop("before", "alike")
    plan = F.broadcast(plan.withColumnRenamed("source", "source_"))
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("source_")))
    rows = settle(rows.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "nth")).drop("source_"))
    extra = sample_copies(rows.select("group", "key", "size", "chance"), seed)
    out = rows.join(extra, "key")
    copies = (F.col("whole") + F.col("extra")).cast("int")
    return out.select(
        "doc_id", "nth", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"), "source"
    )


def _rate(target: Fraction, size: int) -> tuple[int, float]:
    if size == 0:
        return 1, 0.0
    rate = target / size
    whole = math.floor(rate)
    return whole, float(rate - whole)
