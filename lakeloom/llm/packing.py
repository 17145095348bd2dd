"""Best-fit packing of whole documents into sequences of fixed capacity, by large-item matching.

Items longer than a third of the capacity fit at most twice in a bin: every item over half opens
a bin, from the longest on each takes the longest middle item that fits, and middle items left
over pair up. Smaller items then go, longest first, into the tightest gap that holds them.

Lengths are integers up to the capacity, so items of one length are interchangeable and so are
bins of one gap. The plan is therefore made on counts alone: the driver sees a histogram of at
most `capacity` numbers, whatever the corpus, and the plan is a table of runs ("items of this
length from rank r on go to bins from b on"). Every item then finds its place by its rank among
the items of its length, which are numbered without ever bringing a length together in one task.
"""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import leaves_result_only, parts_for, settle, tidy

CAPACITY = 4096
END_ID = 1
#: Pieces of one length are ranked in blocks, of which there is one for so many rows of the table.
ROWS_PER_BLOCK = 20_000
#: Words kept with their ids in a worker; beyond it, the table starts anew.
WORDS_KEPT = 100_000


class _Gaps:
    """Bins by their gap: runs [first, count) of bin numbers."""

    def __init__(self, capacity: int):
        self.runs: dict[int, list[list[int]]] = {}
        self.sizes: list[int] = []

    def add(self, gap: int, first: int, count: int) -> None:
        if gap <= 0 or count <= 0:
            return
        if gap not in self.runs:
            self.runs[gap] = []
            bisect.insort(self.sizes, gap)
        self.runs[gap].append([first, count])

    def take(self, gap: int, most: int) -> tuple[int, int]:
        """A run of up to `most` bins of this gap."""
        run = self.runs[gap][-1]
        first, count = run[0], min(run[1], most)
        if count == run[1]:
            self.runs[gap].pop()
            if not self.runs[gap]:
                del self.runs[gap]
                self.sizes.remove(gap)
        else:
            run[0] += count
            run[1] -= count
        return first, count

    def tightest(self, length: int) -> int | None:
        at = bisect.bisect_left(self.sizes, length)
        return self.sizes[at] if at < len(self.sizes) else None


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Runs (length, rank, items, per_bin, bin, offset) that place counts[length] items of each length.

    Item number rank + i of that length goes to bin + i // per_bin at offset + (i % per_bin) * length.
    The number of runs depends on the number of different lengths, not on the number of items.
    """
    plan, gaps, bins = [], _Gaps(capacity), 0
    left = {n: c for n, c in counts.items() if n > 0 and c > 0}
    rank = dict.fromkeys(left, 0)

    def place(length: int, items: int, per_bin: int, first: int, offset: int) -> None:
        plan.append((length, rank[length], items, per_bin, first, offset))
        rank[length] += items
        left[length] -= items

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    middle = sorted(n for n in large if 2 * n <= capacity)
    for length in (n for n in large if 2 * n > capacity):
        todo = left[length]
        while todo:
            mates = [n for n in middle if left[n]]
            at = bisect.bisect_right(mates, capacity - length) - 1
            count = min(todo, left[mates[at]]) if at >= 0 else todo
            place(length, count, 1, bins, 0)
            if at >= 0:
                place(mates[at], count, 1, bins, length)
                gaps.add(capacity - length - mates[at], bins, count)
            else:
                gaps.add(capacity - length, bins, count)
            bins += count
            todo -= count
    odd = None  # a middle item whose bin still lacks a mate
    for length in sorted(middle, reverse=True):
        if odd and left[length]:
            place(length, 1, 1, odd[0], odd[1])
            gaps.add(capacity - odd[1] - length, odd[0], 1)
            odd = None
        pairs = left[length] // 2
        if pairs:
            place(length, 2 * pairs, 2, bins, 0)
            gaps.add(capacity - 2 * length, bins, pairs)
            bins += pairs
        if left[length]:
            place(length, 1, 1, bins, 0)
            odd = (bins, length)
            bins += 1
    if odd:
        gaps.add(capacity - odd[1], odd[0], 1)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            gap = gaps.tightest(length)
            if gap is None:
                per_bin = capacity // length
                whole = left[length] // per_bin
                if whole:
                    place(length, whole * per_bin, per_bin, bins, 0)
                    gaps.add(capacity - per_bin * length, bins, whole)
                    bins += whole
                elif left[length]:
                    gaps.add(capacity, bins, 1)
                    bins += 1
                continue
            per_bin = min(gap // length, left[length])
            first, count = gaps.take(gap, max(1, left[length] // per_bin))
            place(length, count * per_bin, per_bin, first, capacity - gap)
            gaps.add(gap - per_bin * length, first, count)
    return pd.DataFrame(plan, columns=["length", "rank", "items", "per_bin", "bin", "offset"]).astype("int64")


def _placer(plan):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, per_bin, first, offset = (plan.value[x] for x in ("length", "rank", "per_bin", "bin", "offset"))
        order = np.lexsort((rank, length))
        length, rank, per_bin, first, offset = (x[order] for x in (length, rank, per_bin, first, offset))
        for batch in batches:
            own, at = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            # Runs of one length lie together; within them, the last one that begins at or before the rank.
            low, high = np.searchsorted(length, own, "left"), np.searchsorted(length, own, "right")
            while (busy := high - low > 1).any():
                mid = (low + high) // 2
                late = rank[np.minimum(mid, len(rank) - 1)] > at
                high = np.where(busy & late, mid, high)
                low = np.where(busy & ~late, mid, low)
            i = at - rank[low]
            places = pa.array(first[low] + i // per_bin[low]), pa.array(offset[low] + i % per_bin[low] * own)
            yield pa.RecordBatch.from_arrays([batch.column("item"), *places], names=["item", "sequence_id", "offset"])

    return place


@leaves_result_only
def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """items with sequence_id and offset added: bins of at most `capacity`, gapless from 0.

    items holds a column length (long, 1..capacity) and columns that tell its rows apart; equal rows
    are counted, not sorted, and each gets its own place. Columns of items that are named
    sequence_id or offset give way to these; any other names may occur. Lengths that are null, below
    1 or above the capacity raise an error. An empty table gives an empty table. Numbers are stable
    for a given set of rows, whatever their order or partitioning.
    """
    spark = items.sparkSession
    own = [c for c in items.columns if c not in ("sequence_id", "offset")]
    fields = [f for f in items.schema.fields if f.name in own]
    # All of a row in one column, so that no name of its own is in the way.
    rows = items.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("item"))
    rows = rows.select("item", F.col("item.length").cast("long").alias("length"), F.xxhash64("item").alias("hash"))
    alike = rows.groupBy("length", "hash", "item").agg(F.count("*").alias("copies"))
    total = items.count()
    alike = alike.withColumn("block", F.pmod("hash", F.lit(parts_for(total, ROWS_PER_BLOCK))))
    before = Window.partitionBy("length", "block").orderBy("hash", "item").rowsBetween(Window.unboundedPreceding, -1)
    numbered = settle(alike.withColumn("before", F.coalesce(F.sum("copies").over(before), F.lit(0))).drop("hash"))
    counts = numbered.groupBy("length", "block").agg(F.sum("copies").alias("c"))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(counts.withColumn("start", F.coalesce(F.sum("c").over(earlier), F.lit(0))))
    sizes = {r["length"]: r["c"] for r in starts.groupBy("length").agg(F.sum("c").alias("c")).limit(capacity + 2).collect()}
    if any(n is None or not 1 <= n <= capacity for n in sizes):
        raise ValueError(f"lengths must be 1 to {capacity}")
    plan = spark.sparkContext.broadcast({k: v.to_numpy() for k, v in plan_bins(sizes, capacity).items()})
    # As many starts as lengths and blocks: they grow with the table, so they are dealt, not sent to all.
    ranked = numbered.join(starts.select("length", "block", "start").hint("merge"), ["length", "block"])
    turn = F.explode(F.expr("sequence(0L, copies - 1)")).alias("turn")
    ranked = ranked.select("item", "length", F.col("start") + F.col("before"), turn).toDF("item", "length", "first", "turn")
    ranked = ranked.select("item", "length", (F.col("first") + F.col("turn")).alias("rank"))
    schema = T.StructType([T.StructField("item", T.StructType(fields)), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(_placer(plan), schema).select("item.*", "sequence_id", "offset")


#: ASCII punctuation but the apostrophe, which can begin an ending of its own.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds:
    """Ids of words as little-endian 32-bit bytes, encoded once and then looked up.

    For tokenizers whose pieces never cross ASCII blanks, that lower-case, and that part a word from
    the marks after it. Two generations of up to WORDS_KEPT words are held, so what is in use stays.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # What the model is shown of a letter; up to U+00FF letters are one code point each and
        # lower-case alike everywhere, so a word's form is that of its letters.
        letters = [chr(c) for c in range(0x80, 0x100) if chr(c).isalpha()]
        self.shown = str.maketrans({x: self._shown(x) for x in letters})
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}

    def _shown(self, letter: str) -> str:
        plain = self.tokenizer.normalizer.normalize_str(letter)
        return "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain))

    def text(self, text: str) -> bytes:
        words = text.encode().split()
        ids = list(map(self.young.get, words))
        if None in ids:
            if len(self.young) > WORDS_KEPT:
                self.young, self.old = {}, self.young
            if len(self.stems) > WORDS_KEPT:
                self.stems = {}
            young, old = self.young, self.old
            for i in [i for i, x in enumerate(ids) if x is None]:
                w = words[i]
                ids[i] = young[w] = young.get(w) or old.get(w) or self.word(w)
        return b"".join(ids)

    def word(self, word: bytes) -> bytes:
        stem = word.rstrip(_MARKS)
        if stem.isalpha():  # ASCII letters only
            stem = stem.lower()
            ids = self.stems.get(stem)
            if ids is None:
                ids = self.stems[stem] = self.tokens(stem.decode())
            return ids + self.mark(word[len(stem) :])
        letters = stem.decode()
        if letters.isalpha() and max(letters) < "\u0100":
            low = letters.lower()
            key = low.encode()
            ids = self.stems.get(key)
            if ids is None:
                ids = self.stems[key] = self.tokens(low.translate(self.shown))
            return ids + self.mark(word[len(stem) :])
        return self.encode(word.decode())

    def mark(self, part: bytes) -> bytes:
        if not part:
            return b""
        ids = self.stems.get(part)
        if ids is None:
            ids = self.stems[part] = self.encode(part.decode())
        return ids

    def tokens(self, shown: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, s: str) -> bytes:
        return array("I", self.tokenizer.encode(s, add_special_tokens=False).ids).tobytes()


_word_ids: dict[str, WordIds] = {}


def word_ids(texts: Iterator[str], path: str) -> Iterator[bytes]:
    """The ids of each text by the tokenizer at path."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return map(_word_ids[path].text, texts)


def _cutter(path: str, capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            names = batch.column("doc_id").cast(pa.int64()).to_pylist()
            texts = (x.as_py() or "" for x in batch.column("text"))
            for doc_id, ids in zip(names, word_ids(texts, path), strict=True):
                ids += END_ID.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                size += len(ids)
                if size > 4 << 20:
                    yield _piece_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _piece_batch(rows)

    return cut


def _piece_batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): token ids of docs(doc_id, text, ...), then id 1, cut at capacity.

    ids are little-endian unsigned 32-bit integers; without with_ids they stay out of the table and
    only their checksum is kept. Null and empty texts have the end id alone. doc_id may be null or
    repeated; other columns are ignored; an empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    return rows.mapInArrow(tidy(_cutter(tokenizer_path, capacity, with_ids)), schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """pieces() with the sequence and offset of each piece; see pack(). The ids move once, to their place."""
    if not with_ids:
        return pack(settle(pieces(docs, tokenizer_path, capacity, False).drop("ids")), capacity)
    cut = settle(pieces(docs, tokenizer_path, capacity).withColumn("row", F.monotonically_increasing_id()))
    keys = ("doc_id", "piece", "start", "length", "ids_crc32")
    placed = pack(cut.select(*keys), capacity)
    # Pieces alike, of rows that share a number, are told apart by their turn only.
    alike = Window.partitionBy(*keys)
    mine = cut.select(*keys, "row").withColumn("turn", F.row_number().over(alike.orderBy("row"))).alias("m")
    places = placed.withColumn("turn", F.row_number().over(alike.orderBy("sequence_id", "offset"))).alias("p")
    same = F.lit(True)
    for c in (*keys, "turn"):
        same &= F.col(f"m.{c}").eqNullSafe(F.col(f"p.{c}"))
    found = settle(mine.join(places, same).select("m.row", "p.sequence_id", "p.offset"))
    return cut.join(found.hint("merge"), "row").select(*keys, "sequence_id", "offset", "ids")
