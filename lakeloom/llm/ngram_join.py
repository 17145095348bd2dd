"""N-gram Jaccard join: classes of documents linked by 5-word shingle sets of similarity >= 0.8.

Method (set-relation skipping):

1. Texts become sets of 64-bit shingle hashes. Equal sets collapse to one representative.
2. Linear proposals: every representative names the one set with which it shares most of six
   minimum hashes; one comparison each. What links becomes a group, and a highly similar child
   (0.9 or more) keeps only its difference to its parent.
3. Index lists: each set enters the lists of its rarest elements (rarity from a fixed-size count
   sketch over all texts). A list is sorted by set size, then position; a probe skips whole
   blocks whose size or position rules out the needed overlap, and skips members of its own
   group, whose links could not change any class. A list that the sketch says may be long is cut
   into blocks of documents, and every pair of blocks is a list of its own.
4. Candidates first meet an exact upper bound on parity bits, then the sets. For one probe, the
   intersection with a child follows from that with its parent:
   |a & child| = |a & parent| - |a & lost| + |a & gained|.
5. Verified links form connected components.
6. Where links are counted, all pairs of a class are: every link lies in a class. A member keeps
   its difference to the class's best linked set. Members of n elements that differ in d of them
   have a margin n - 9 d, and two whose margins add up to 0 or more are linked for certain: these
   pairs are counted by margin. The others follow from the differences; they meet in pairs of
   blocks by margin, so no pair becomes a row.

No list, group or candidate is capped. Results are the same for any partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm import shingles as S
from lakeloom.llm.common import BucketedTable, Scratch, add_counts, parts_for, settle, tidy
from lakeloom.llm.components import connected_components

U = np.uint64
SKETCH_BITS = 18
KEYS = 6
NEAR = 0.9
LISTED_PER_PART = 400_000
#: Lists that may be longer are cut into blocks of about so many documents.
LIST_BLOCK = 1 << 18
SALT_ROWS = 256
#: Lists at least this long are probed block by block; shorter ones row against row, all lists at once.
LONG_LIST = 64
DOCS_PER_BUCKET = 4096
#: Spark allows 100,000 buckets; beyond that many documents buckets grow, and sort-merge joins spill.
MOST_BUCKETS = 50_000
#: About as many members of a class meet as many others in one task; elements are counted so many at a time.
CLASS_BLOCK = 256
COUNTED_AT_ONCE = 2048
_KEY_FACTORS = S.mix(np.arange(1, KEYS + 1, dtype=U)) | U(1)

SET_SCHEMA = "doc_id long, n long, d1 long, d2 long, keys array<long>, bits binary, sketch binary"


def _texts(batch: pa.RecordBatch) -> list:
    column = batch.column("text")
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, then one with this task's counts of elements by bucket."""
    load = np.zeros(1 << SKETCH_BITS, np.int64)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
        ("keys", pa.list_(pa.int64())), ("bits", pa.binary()), ("sketch", pa.binary()),
    ])
    mask = U((1 << SKETCH_BITS) - 1)
    for batch in batches:
        rows, held, size = [], [], 0
        for i, t in S.shingle_sets(_texts(batch)):
            if len(t):
                a, b = S.mix(t).sum(dtype=U), S.mix(t ^ U(S.BASE)).sum(dtype=U)
                keys = [int(x) for x in S.mix(t[None] * _KEY_FACTORS[:, None]).min(axis=1).view(np.int64)]
                rows.append((len(t), int(a.view(np.int64)), int(b.view(np.int64)), keys, S.parity_bits(t)))
                held.append(t)
                size += len(t)
            else:
                rows.append((0, 0, 0, [], b""))
            if size > 200_000:
                load += np.bincount((np.concatenate(held) & mask).astype(np.int64), minlength=len(load))
                held, size = [], 0
        if held:
            load += np.bincount((np.concatenate(held) & mask).astype(np.int64), minlength=len(load))
        columns = [pa.array(x, type=f.type) for x, f in zip(zip(*rows, strict=True), list(schema)[1:6], strict=True)] if rows else [pa.array([], type=f.type) for f in list(schema)[1:6]]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns, pa.nulls(len(rows), pa.binary())], schema=schema)
    if load.any():
        one = [pa.nulls(1, f.type) for f in list(schema)[:6]]
        yield pa.RecordBatch.from_arrays([*one, pa.array([load.astype("<i8").tobytes()], pa.binary())], schema=schema)


def _among(x: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which elements of x the sorted set holds."""
    if not len(sorted_set):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_set, x)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == x


COMPARED = "a long, b long, linked boolean, near boolean, lost binary, gained binary"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, salt, kind): 0 the probe's text, 1 whole texts, 2 differences to one of these."""
    key, probe, known = None, np.empty(0, U), {}
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary()]
    names = ["a", "b", "linked", "near", "lost", "gained"]
    for batch in batches:
        out = []
        a, salt, kind, b, hub, lost, gained = (batch.column(x).to_pylist() for x in ("a", "salt", "kind", "b", "hub", "lost", "gained"))
        for i, own in S.shingle_sets(_texts(batch)):  # of differences, empty
            if (a[i], salt[i]) != key:
                key, probe, known = (a[i], salt[i]), np.empty(0, U), {}
            if kind[i] == 0:
                probe = own
                continue
            near, dropped, added = False, b"", b""
            if kind[i] == 1:
                shared = _among(own, probe)
                both, n = int(shared.sum()), len(own)
                known[b[i]] = both, n
                if both >= NEAR * (len(probe) + n - both):
                    near, added = True, own[~shared].tobytes()
                    dropped = probe[~_among(probe, own)].tobytes()
            else:
                gone, come = np.frombuffer(lost[i], U), np.frombuffer(gained[i], U)
                both, n = known[hub[i]]
                both += int(_among(come, probe).sum()) - int(_among(gone, probe).sum())
                n += len(come) - len(gone)
            out.append((a[i], b[i], both >= S.overlap_needed(len(probe), n), near, dropped, added))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _could_link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs that the bound from their parity bits leaves possible."""
    for f in frames:
        keep = [
            S.parity_distance(x, y) <= n + m - 2 * S.overlap_needed(n, m)
            for x, y, n, m in zip(f["bits_a"], f["bits_b"], f["n_a"], f["n_b"], strict=True)
        ]
        yield f.loc[np.array(keep, bool), ["a", "b"]]


def split_lists(element: np.ndarray, load: np.ndarray, doc_id: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, list, side) of a document's elements: load bounds the length of each one's list.

    A list that may exceed `block` is cut into blocks of documents; a row goes to all lists that
    pair its block with one (side 0 or 1), itself included (side 2, as in lists that are whole).
    """
    cuts = -(-load // block)
    if cuts.max(initial=1) <= 1:
        return np.arange(len(element)), element, np.full(len(element), 2)
    cuts = np.maximum(cuts, 1)
    row = np.repeat(np.arange(len(element)), cuts)
    other = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    own = (int(S.mix(np.array([doc_id], np.int64).view(U))[0] >> U(11)) % cuts)[row]
    cell = np.minimum(own, other) * cuts[row] + np.maximum(own, other) + 1
    lists = np.where(cuts[row] > 1, S.mix(element[row].view(U) ^ (cell.astype(U) * U(S.BASE))).view(np.int64), element[row])
    return row, lists, np.where(own == other, 2, (own > other).astype(np.int64))


def _prefix_rows(load: np.ndarray):
    """Each set's rarest elements with their positions: (list, size, position and side, document, group)."""
    mask = U((1 << SKETCH_BITS) - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(parts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["element", "place", "doc_id", "comp"])

        for batch in batches:
            ids, comps = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("doc_id", "comp"))
            parts, size = [], 0
            for i, t in S.shingle_sets(_texts(batch)):
                weight = load[(t & mask).astype(np.int64)]
                rare = np.lexsort((t, weight))[: S.prefix_length(len(t))]
                at, lists, side = split_lists(t[rare].view(np.int64), weight[rare], ids[i], LIST_BLOCK)
                place = ((len(t) << 32) + at << 2) + side
                parts.append((lists, place, np.full(len(at), ids[i]), np.full(len(at), comps[i])))
                size += len(at)
                if size > 50_000:
                    yield batch_of(parts)
                    parts, size = [], 0
            if parts:
                yield batch_of(parts)

    return rows


def list_pairs(element, size, position, comp, first_new: int, side=None):
    """Pairs (i, j), j >= first_new, of one or more index lists that could be similar and are of different groups.

    Rows are sorted by element, size, position. A list all of one group is skipped whole; a probe
    leaves its list at the first size that is too large, and a block of one size at the first
    position that is too late. Rows of one side, 0 or 1, of a list that pairs two blocks meet elsewhere.
    """
    n = len(element)
    side = np.full(n, 2) if side is None else side
    begins = np.flatnonzero(np.r_[True, element[1:] != element[:-1]]) if n else np.empty(0, np.int64)
    lengths = np.diff(np.r_[begins, n])
    mixed = np.minimum.reduceat(comp, begins) != np.maximum.reduceat(comp, begins) if n else np.empty(0, bool)
    ends = np.repeat(begins + lengths, lengths)
    active = np.flatnonzero(np.repeat(mixed, lengths))
    left, right = [], []
    for d in range(1, LONG_LIST):
        active = active[active + d < ends[active]]
        active = active[4 * size[active + d] <= 5 * size[active]]
        if not len(active):
            break
        i, j = active, active + d
        need = S.overlap_needed(size[i], size[j])
        ok = (j >= first_new) & (comp[i] != comp[j]) & (size[i] - position[i] >= need) & (size[j] - position[j] >= need)
        ok &= (side[i] != side[j]) | (side[i] == 2)
        left.append(i[ok])
        right.append(j[ok])
    active = active[active + LONG_LIST < ends[active]] if len(active) else active
    blocks = np.flatnonzero(np.r_[True, (element[1:] != element[:-1]) | (size[1:] != size[:-1])]) if len(active) else None
    end = -1
    for i in active:
        if ends[i] != end:
            # Most rows of a long list are of one group: its probes meet only the rows of others.
            begin, end = begins[np.searchsorted(begins, i, "right") - 1], ends[i]
            groups, counts = np.unique(comp[begin:end], return_counts=True)
            main = groups[counts.argmax()]
            others = begin + np.flatnonzero(comp[begin:end] != main)
        k = np.searchsorted(blocks, i, "right") - 1
        while k < len(blocks) and blocks[k] < end:
            start, stop = blocks[k], blocks[k + 1] if k + 1 < len(blocks) else n
            need = S.overlap_needed(size[i], size[start])
            if 4 * size[start] > 5 * size[i] or size[i] - position[i] < need:
                break
            stop = start + np.searchsorted(position[start:stop], size[start] - need, "right")
            first = max(start, i + LONG_LIST, first_new)
            if comp[i] == main:
                j = others[np.searchsorted(others, first) : np.searchsorted(others, stop)]
            else:
                j = np.arange(first, stop)
                j = j[comp[j] != comp[i]]
            j = j[(side[j] != side[i]) | (side[j] == 2)]
            left.append(np.full(len(j), i))
            right.append(j)
            k += 1
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _probe_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of the sorted lists; of a list cut by a batch's end only the sizes still in reach are held."""
    held = [np.empty(0, np.int64)] * 4
    for batch in batches:
        new = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("element", "place", "doc_id", "comp")]
        if not len(new[0]):
            continue
        first = len(held[0])
        element, place, ids, comp = (np.concatenate(x) for x in zip(held, new, strict=True))
        size, position, side = place >> 34, place >> 2 & 0xFFFFFFFF, place & 3
        i, j = list_pairs(element, size, position, comp, first, side)
        if len(i):
            pairs = np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
        keep = (element == element[-1]) & (5 * size >= 4 * size[-1])
        held = [x[keep] for x in (element, place, ids, comp)]


DIFFERENCES = "component long, rep long, copies long, n long, margin long, delta binary"


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (component, part, kind): 0 the class's best linked text, 1 its members; the elements that one of both lacks."""
    parent = np.empty(0, U)
    types = [pa.int64()] * 5 + [pa.binary()]
    names = ["component", "rep", "copies", "n", "margin", "delta"]
    for batch in batches:
        out = []
        component, kind, rep, copies = (batch.column(x).to_pylist() for x in ("component", "kind", "doc_id", "copies"))
        for i, own in S.shingle_sets(_texts(batch)):
            if kind[i] == 0:
                parent = own
                continue
            delta = np.setxor1d(own, parent, assume_unique=True)
            out.append((component[i], rep[i], copies[i], len(own), len(own) - 9 * len(delta), delta.tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of left with every set of right."""
    out = np.zeros((len(left), len(right)), np.int64)
    sides = []
    for sets in (left, right):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])))
    common = np.intersect1d(sides[0][0], sides[1][0])
    for at in range(0, len(common), COUNTED_AT_ONCE):
        some = common[at : at + COUNTED_AT_ONCE]
        held = []
        for (element, owner), sets in zip(sides, (left, right), strict=True):
            inside = np.flatnonzero(_among(element, some))
            has = np.zeros((len(sets), len(some)), np.float32)
            has[owner[inside], np.searchsorted(some, element[inside])] = 1
            held.append(has)
        out += (held[0] @ held[1].T).astype(np.int64)
    return out


def count_block_links(left: tuple, right: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """Documents that each member of a block links to in the other one, both ways, but for pairs linked for certain; without another one, in its own."""
    own = right is None
    (n, copies, margin, delta), (m, others, margins, gamma) = left, left if own else right
    # |a & b| from the differences A and B to one parent: (|a| + |b| - |A| - |B|) / 2 + |A & B|.
    both = (n - [len(x) for x in delta])[:, None] + (m - [len(x) for x in gamma])[None]
    linked = both // 2 + _shared(delta, gamma) >= S.overlap_needed(n[:, None], m[None])
    linked &= margin[:, None] + margins[None] < 0
    if own:
        np.fill_diagonal(linked, False)
    return linked @ others, copies @ linked


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (component, one, two): the members of two blocks of a class, or of one."""
    key, held = None, []

    def counted() -> Iterator[pa.RecordBatch]:
        sides = []
        for side in dict.fromkeys(key[1:]):
            rows = [r for r in held if r[0] == side]
            if not rows:
                return
            ids, copies, n, margin = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3, 4))
            sides.append((ids, (n, copies, margin, [np.frombuffer(r[5], U) for r in rows])))
        found = count_block_links(sides[0][1], sides[1][1] if len(sides) > 1 else None)
        for (ids, _), links in zip(sides, found, strict=False):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links)], names=["rep", "links"])

    for batch in batches:
        columns = [batch.column(x).to_pylist() for x in ("component", "one", "two", "block", "rep", "copies", "n", "margin", "delta")]
        for component, one, two, *row in zip(*columns, strict=True):
            if (component, one, two) != key:
                if held:
                    yield from counted()
                key, held = (component, one, two), []
            held.append(row)
    if held:
        yield from counted()


class _Join:
    """The steps over documents whose doc_id is neither null nor repeated."""

    def __init__(self, docs: DataFrame):
        docs = docs.select("doc_id", "text")
        self.described = settle(docs.mapInArrow(tidy(_describe), SET_SCHEMA))
        sets = self.described.where("sketch is null")
        filled = sets.where("n > 0")
        # Settled, so that a join with them is dealt anew and adaptive execution can split a hot group.
        classes = settle(filled.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")))
        self.members = settle(
            filled.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"]).select("doc_id", "n", "rep")
        )
        alone = self.members.where("doc_id = rep").select("doc_id")
        self.reps = settle(filled.join(alone, "doc_id", "left_semi").select("doc_id", "n", "keys", "bits"))
        # Texts are dealt by number once; all later joins with them move only the other side.
        parts = min(parts_for(self.members.count(), DOCS_PER_BUCKET, 8), MOST_BUCKETS)
        self.docs = BucketedTable(docs.repartition(parts, "doc_id").join(alone, "doc_id", "left_semi"), parts, "doc_id")

    def links(self) -> DataFrame:
        keyed = self.reps.select("doc_id", F.posexplode("keys").alias("k", "v"))
        first = settle(keyed.groupBy("k", "v").agg(F.min("doc_id").alias("a"), F.count("*").alias("c")).where("c > 1"))
        named = settle(keyed.join(first, ["k", "v"]).where("doc_id > a").select("doc_id", "a")).groupBy("doc_id", "a").count()
        best = named.groupBy("doc_id").agg(F.max(F.struct("count", (-F.col("a")).alias("m"))).alias("x"))
        tried = self.possible(best.select((-F.col("x.m")).alias("a"), F.col("doc_id").alias("b")))
        done = self.compare(tried, None)
        children = done.where("near").select("a", F.col("b").alias("child"), "lost", "gained")
        near = settle(
            children.join(children.select(F.col("child").alias("a")), "a", "left_anti").withColumnRenamed("a", "hub")
        )
        links = done.where("linked").select("a", "b")
        groups = self.grouped(links)
        # One comparison for each group that shares a key with another one.
        grouped = keyed.join(groups, "doc_id").groupBy("k", "v", "comp").agg(F.min("doc_id").alias("b"))
        meet = grouped.groupBy("k", "v").agg(F.min("b").alias("a"), F.count("*").alias("c")).where("c > 1")
        again = grouped.join(meet.select("k", "v", "a"), ["k", "v"]).where("a < b").select("a", "b").distinct()
        again = self.possible(again.join(tried, ["a", "b"], "left_anti"))
        more = self.compare(again, near)
        links = links.unionAll(more.where("linked").select("a", "b"))
        groups = self.grouped(links)
        rest = self.candidates(groups).join(tried.unionAll(again), ["a", "b"], "left_anti")
        last = self.compare(self.possible(rest), near)
        return settle(links.unionAll(last.where("linked").select("a", "b")))

    def link_counts(self, classes: DataFrame, links: DataFrame) -> DataFrame:
        """(rep, n_links): documents of a similarity of 0.8 or more with each representative, itself not counted; from classes(rep, component) and all links between classes' groups."""
        copies = settle(self.members.groupBy("rep").agg(F.count("*").alias("copies")))
        ends = links.select(F.col("a").alias("rep")).unionAll(links.select(F.col("b").alias("rep")))
        degree = settle(ends.groupBy("rep").agg(F.count("*").alias("degree")))
        best = F.max(F.struct("degree", (-F.col("rep")).alias("m")))
        sizes = classes.join(degree, "rep").groupBy("component").agg(best.alias("best"), F.count("*").alias("members"))
        sizes = settle(sizes.select("component", (-F.col("best.m")).alias("parent"), F.expr(f"cast(ceil(members / {CLASS_BLOCK}) as long)").alias("parts")))
        placed = classes.join(sizes, "component").withColumn("part", F.expr("pmod(xxhash64(rep), parts)"))
        placed = settle(placed.join(copies, "rep").select("rep", "component", "parent", "part", "copies"))
        first = placed.select("component", "parent", "part").distinct()
        first = first.select(F.col("parent").alias("doc_id"), "component", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("copies"))
        whole = placed.select(F.col("rep").alias("doc_id"), "component", "part", F.lit(1).alias("kind"), "copies")
        rows = self.docs.df.join(first.unionAll(whole), "doc_id").repartition("component", "part")
        rows = rows.sortWithinPartitions("component", "part", "kind", "doc_id")
        deltas = settle(rows.mapInArrow(tidy(_differences), DIFFERENCES))
        # By class and margin: members with smaller ones, and copies whose margins make up for this one.
        margins = settle(deltas.groupBy("component", "margin").agg(F.count("*").alias("members"), F.sum("copies").alias("here")))
        before = Window.partitionBy("component").orderBy("margin").rowsBetween(Window.unboundedPreceding, -1)
        margins = settle(margins.withColumn("before", F.coalesce(F.sum("members").over(before), F.lit(0))))
        wanted = margins.select("component", (-F.col("margin")).alias("at"), F.lit(1).alias("asks"), F.lit(0).cast("long").alias("here"))
        there = margins.select("component", F.col("margin").alias("at"), F.lit(0).alias("asks"), "here")
        above = Window.partitionBy("component").orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sure = there.unionAll(wanted).withColumn("sure", F.sum("here").over(above)).where("asks = 1")
        sure = settle(sure.select("component", (-F.col("at")).alias("margin"), "sure"))
        placed = deltas.join(margins.drop("here"), ["component", "margin"]).join(sure, ["component", "margin"])
        placed = settle(placed.withColumn("block", F.expr(f"(before + pmod(xxhash64(rep), members)) div {CLASS_BLOCK}")).drop("before", "members"))
        # The last block of a class whose least margin doesn't make up for this block's.
        least = settle(placed.groupBy("component", "block").agg(F.min("margin").alias("least")))
        asked = least.select("component", (-F.col("least")).alias("at"), F.lit(0).alias("kind"), "block", F.lit(None).cast("long").alias("last"))
        known = least.select("component", F.col("least").alias("at"), F.lit(1).alias("kind"), "block", F.col("block").alias("last"))
        below = Window.partitionBy("component").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reach = asked.unionAll(known).withColumn("last", F.max("last").over(below)).where("kind = 0 and last is not null")
        met = placed.drop("sure").join(settle(reach.select("component", "block", "last")), ["component", "block"])
        met = met.withColumn("other", F.explode(F.expr("sequence(0L, last)"))).drop("last")
        met = met.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("other")
        met = met.repartition("component", "one", "two").sortWithinPartitions("component", "one", "two")
        found = settle(settle(met.mapInArrow(tidy(_count_links), "rep long, links long")).groupBy("rep").agg(F.sum("links").alias("links")))
        inside = placed.select("rep", (F.col("sure") - F.when(F.col("margin") >= 0, F.col("copies")).otherwise(0)).alias("sure")).join(found, "rep", "left")
        inside = settle(inside.select("rep", (F.col("sure") + F.coalesce("links", F.lit(0))).alias("inside")))
        return copies.join(inside, "rep", "left").select("rep", (F.col("copies") - 1 + F.coalesce("inside", F.lit(0))).alias("n_links"))

    def grouped(self, links: DataFrame) -> DataFrame:
        """(doc_id, comp) of every representative."""
        found = connected_components(links).select(F.col("node").alias("doc_id"), "component")
        return settle(
            self.reps.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("comp"))
        )

    def possible(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and parity bits allow a link."""
        sized = self.reps.select("doc_id", "n", "bits")
        left = sized.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
        right = sized.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
        both = pairs.join(left, "a").join(right, "b").where("5 * n_a >= 4 * n_b and 5 * n_b >= 4 * n_a")
        return settle(both.mapInPandas(_could_link, "a long, b long"))

    def compare(self, pairs: DataFrame, near: DataFrame | None) -> DataFrame:
        """Exact comparison of every pair; texts travel once for a probe and its block of partners.

        Of a pair, the document with more partners is the probe, so that a hub's text is not sent
        to each of them. In the first round (near is None) it is a, of which every b has but one.
        """
        if near is not None:
            ends = pairs.select(F.col("a").alias("x")).unionAll(pairs.select(F.col("b").alias("x")))
            busy = settle(ends.groupBy("x").agg(F.count("*").alias("c")).where("c > 1"))
            pairs = pairs.join(busy.select(F.col("x").alias("a"), F.col("c").alias("c_a")), "a", "left")
            pairs = pairs.join(busy.select(F.col("x").alias("b"), F.col("c").alias("c_b")), "b", "left")
            turned = F.coalesce("c_b", F.lit(1)) > F.coalesce("c_a", F.lit(1))
            pairs = settle(pairs.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b")))
            pairs = pairs.join(near.select(F.col("child").alias("b"), "hub"), "b", "left")
            shared = pairs.where("hub is not null and hub <> a").groupBy("a", "hub").count().where("count > 1").select("a", "hub", F.lit(True).alias("derive"))
            pairs = pairs.join(shared, ["a", "hub"], "left")
            pairs = settle(pairs.select("a", "b", F.when(F.col("derive"), F.col("hub")).alias("hub")))
            hubs = pairs.where("hub is not null").select("a", F.col("hub").alias("b")).distinct()
            hubs = hubs.join(pairs.where("hub is null").select("a", "b"), ["a", "b"], "left_anti")
            pairs = pairs.unionByName(hubs.withColumn("hub", F.lit(None).cast("long")))
        else:
            pairs = pairs.withColumn("hub", F.lit(None).cast("long"))
        blocks = pairs.groupBy("a").agg(F.expr(f"cast(ceil(count(*) / {SALT_ROWS}) as long)").alias("salts"))
        pairs = pairs.join(blocks, "a").withColumn("salt", F.expr("pmod(xxhash64(coalesce(hub, b)), salts)")).drop("salts")
        none = {x: F.lit(None).cast("binary") for x in ("lost", "gained")}
        probes = pairs.select("a", "salt").distinct().select(F.col("a").alias("doc_id"), "a", "salt", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("b"))
        whole = pairs.where("hub is null").select(F.col("b").alias("doc_id"), "a", "salt", F.lit(1).alias("kind"), "b")
        rows = self.docs.df.join(probes.unionAll(whole), "doc_id").drop("doc_id").withColumns({"hub": F.lit(None).cast("long"), **none})
        if near is not None:
            deltas = pairs.where("hub is not null").join(near.drop("hub").withColumnRenamed("child", "b"), "b")
            deltas = deltas.withColumns({"text": F.lit(None).cast("string"), "kind": F.lit(2)})
            rows = rows.unionByName(deltas)
        rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind", "b")
        return settle(rows.mapInArrow(tidy(_compare), COMPARED))

    def candidates(self, groups: DataFrame) -> DataFrame:
        counts = self.described.where("sketch is not null").select(F.lit("").alias("key"), F.col("sketch").alias("counts"))
        load = add_counts(counts, 1 << SKETCH_BITS).get("", np.zeros(1 << SKETCH_BITS, np.int64))
        load = self.reps.sparkSession.sparkContext.broadcast(load)  # of fixed size
        rows = _prefix_rows_of(load)
        total = self.reps.agg(F.sum("n")).first()[0] or 0
        listed = self.docs.df.join(groups, "doc_id").mapInArrow(tidy(rows), "element long, place long, doc_id long, comp long")
        parts = parts_for(total // 5, LISTED_PER_PART, 8)
        lists = listed.repartition(parts, "element").sortWithinPartitions("element", "place")
        return lists.mapInArrow(tidy(_probe_lists), "a long, b long").distinct()


def _prefix_rows_of(load):
    return lambda batches: _prefix_rows(load.value)(batches)


def uniquely_numbered(docs: DataFrame) -> bool:
    """Whether every row of docs has a doc_id of its own."""
    return docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty()


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of docs(doc_id, text, ...).

    n_shingles is the size of the set of distinct 5-word shingles of the A-Z-lower-cased text (with
    fewer words, the whole sequence counts as one); component_id the smallest doc_id reachable over
    links of similarity 0.8 or more, itself included. Null, empty and blank texts have no shingle
    and no link. Rows that share a doc_id are one node: what links to any of them links to all. A
    null doc_id names no node: component_id is null, and the row links nothing. Other columns are
    ignored; an empty table gives an empty table.
    """
    return _classes(docs, []).select("doc_id", "n_shingles", "component_id")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """jaccard_classes with n_links: of how many other rows the text has a similarity of 0.8 or more.

    Every pair counts, exact copies and pairs inside a class too. Rows with a null doc_id neither
    have links nor count for others.
    """
    return _classes(docs, ["n_links"])


def _classes(docs: DataFrame, counts: list[str]) -> DataFrame:
    """The classes, with the number of links where counts names it. All tables written on the way are deleted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(docs.sparkSession):
        return settle(_of_numbered(docs, counts) if uniquely_numbered(docs) else _of_rows(docs, counts), keep=True)


def _of_numbered(docs: DataFrame, counts: list[str]) -> DataFrame:
    join = _Join(docs)
    links = join.links()
    if not counts:
        join.docs.drop()
    found = settle(connected_components(links).select(F.col("node").alias("rep"), "component"))
    linked = join.members.join(found, "rep", "left")
    if counts:
        linked = linked.join(settle(join.link_counts(found, links)), "rep")
        join.docs.drop()
    linked = linked.select("doc_id", F.coalesce("component", "rep").alias("component_id"), *counts)
    sizes = join.described.where("sketch is null").select("doc_id", F.col("n").alias("n_shingles"))
    out = sizes.join(linked, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts])


def _of_rows(docs: DataFrame, counts: list[str]) -> DataFrame:
    """The classes where numbers are missing or repeated: rows are numbered anew."""
    numbered = settle(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("name"), "text"))
    named = numbered.where("name is not null")
    rows = _classes(named.select(F.col("row").alias("doc_id"), "text"), counts).withColumnRenamed("doc_id", "row")
    rows = settle(rows.join(named.select("row", "name"), "row"))
    # Rows tie names together; a class is named by its smallest name.
    tops = rows.groupBy("component_id").agg(F.min("name").alias("top"))
    rows = settle(rows.join(tops, "component_id").select("name", "n_shingles", "top", *counts))
    found = connected_components(rows.select(F.col("name").alias("a"), F.col("top").alias("b")))
    rows = rows.join(found, F.col("name") == F.col("node"), "left")
    out = rows.select(F.col("name").alias("doc_id"), "n_shingles", F.coalesce("component", "top").alias("component_id"), *counts)
    lost = numbered.where("name is null").select("text").mapInArrow(_only_sizes, "n_shingles long")
    none = [F.lit(0).cast("long").alias(c) for c in counts]
    return out.unionByName(lost.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id"), *none))


def _only_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(t) for _, t in S.shingle_sets(_texts(batch))], pa.int64())], names=["n_shingles"])
