"""Language ID: every document as a mixture of languages.

A language is a distribution over hashed byte trigrams of its words. A word's likelihood in a
language is the product of its trigrams'. For a set of languages, expectation-maximisation over
the document's words gives their proportions. The set is grown from the best single language: one
more is taken in if the log-likelihood gains more than a penalty and it covers enough of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import Scratch, add_counts, settle, tidy

BUCKET_BITS = 16
RUN_BYTES = 1 << 19
#: Expectation-maximisation of a document ends when no proportion moves by more. As the likelihood
#: is concave in the proportions, it ends near their one best value from any start.
TOLERANCE = 1e-5
#: What a further language must gain: nats for each log(words), and the least share of the text.
PENALTY = 3.0
LEAST_SHARE = 0.05
SMOOTHING = 0.5
UNKNOWN = "und"

_fold = np.full(256, 32, np.uint8)
_fold[97:123] = np.arange(97, 123)
_fold[65:91] = np.arange(97, 123)
_fold[128:] = np.arange(128, 256)


def _has_letter(text: bytes) -> bool:
    folded = _fold[np.frombuffer(text, np.uint8)]
    if ((folded >= 97) & (folded < 123)).any():
        return True
    return bool((folded >= 128).any()) and any(map(str.isalpha, text.decode("utf-8", "replace")))


def word_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all letters of the texts; where words begin in them; the text of each word."""
    begins = np.cumsum([1] + [len(x) + 1 for x in texts])
    b = _fold[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    at = np.flatnonzero(b != 32)
    w = b.astype(np.uint32)
    gram = w[at - 1] << 16 | w[at] << 8 | w[at + 1]
    bucket = (gram * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    first = np.flatnonzero(b[at - 1] == 32)
    return bucket, first, np.searchsorted(begins, at[first], "right") - 1


def _runs(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(texts):
        run, size = [], 0
        while at + len(run) < len(texts) and (not run or size < RUN_BYTES):
            run.append(texts[at + len(run)])
            size += len(run[-1])
        yield at, run
        at += len(run)


def _bytes(batch: pa.RecordBatch) -> list[bytes | None]:
    column = batch.column("text")
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = _bytes(batch), batch.column("lang").to_pylist()
        for lang in set(langs):
            own = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
            for _, run in _runs([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                own += np.bincount(word_grams(run)[0], minlength=len(own))
    if counts:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([x.astype("<i8").tobytes() for x in counts.values()], pa.binary())], names=["key", "counts"]
        )


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities by trigram bucket, from all rows of docs(text, lang) that have both.

    The model's size is that of the languages, whatever the corpus.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    with Scratch(docs.sparkSession):
        counts = add_counts(settle(rows.mapInArrow(tidy(_count), "key string, counts binary")), 1 << BUCKET_BITS)
    langs = sorted(counts)
    table = np.array([counts[x] for x in langs], float).reshape(len(langs), 1 << BUCKET_BITS) + SMOOTHING
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()


def maximised(pi: np.ndarray, p: np.ndarray, v: np.ndarray, starts: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """The proportions to which expectation-maximisation takes pi; rows of p (chances) and v (weights) belong to documents from starts on."""
    sizes = np.diff(np.r_[starts, len(v)])
    moving, out = np.arange(len(pi)), pi
    while len(moving):
        seat = np.repeat(np.arange(len(moving)), sizes)
        before = pi
        for _ in range(8):
            before = pi
            r = pi[seat] * p
            r *= (v / np.maximum(r.sum(axis=1), 1e-300))[:, None]
            pi = np.add.reduceat(r, starts, axis=0) / mass[:, None]
        out[moving] = pi
        left = np.abs(pi - before).max(axis=1) > TOLERANCE
        rows = left[seat]
        pi, p, v, mass, sizes, moving = pi[left], p[rows], v[rows], mass[left], sizes[left], moving[left]
        starts = np.cumsum(sizes) - sizes
    return out


def mixtures(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) of each text's selected set; rows without words are zero."""
    n, langs = len(texts), table.shape[1]
    bucket, first, owner = word_grams(texts)
    share = np.zeros((n, langs))
    if not len(first) or not langs:
        return share
    fit = np.add.reduceat(table[bucket], first, axis=0).astype(np.float64)
    weight = np.diff(np.r_[first, len(bucket)]).astype(np.float64)
    filled, begin = np.unique(owner, return_index=True)
    total = np.add.reduceat(fit, begin, axis=0)
    words = np.diff(np.r_[begin, len(owner)])
    chosen = np.zeros((len(filled), langs), bool)
    best = total.argmax(axis=1)
    chosen[np.arange(len(filled)), best] = True
    share[filled, best] = 1.0
    like = total.max(axis=1)
    active = np.arange(len(filled))
    place = np.repeat(np.arange(len(filled)), words)
    floor = fit.max(axis=1)
    chance = np.exp(fit - floor[:, None])
    for _ in range(1, langs):
        # The languages outside the set promise at most this gain over the set's best word by word.
        inside = np.where(chosen[place], fit, -np.inf).max(axis=1)
        gain = np.add.reduceat(np.maximum(fit - inside[:, None], 0), begin, axis=0)
        gain[chosen] = -1
        penalty = PENALTY * np.log(words + 1)
        active = active[gain[active].max(axis=1) > penalty[active]]
        if not len(active):
            break
        newest = gain[active].argmax(axis=1)
        trial = chosen[active]
        trial[np.arange(len(active)), newest] = True
        of = np.full(len(filled), -1)
        of[active] = np.arange(len(active))
        mine = np.flatnonzero(of[place] >= 0)
        seat, p, v = of[place[mine]], chance[mine], weight[mine]
        starts = np.searchsorted(seat, np.arange(len(active)))
        mass = np.add.reduceat(v, starts)
        pi = maximised(trial / trial.sum(axis=1, keepdims=True), p, v, starts, mass)
        mixed = np.log(np.maximum((pi[seat] * p).sum(axis=1), 1e-300)) + floor[mine]
        mixed = np.add.reduceat(mixed, starts)
        better = (mixed - penalty[active] > like[active]) & (pi[np.arange(len(active)), newest] >= LEAST_SHARE)
        active, pi = active[better], pi[better]
        chosen[active] = trial[better]
        like[active] = mixed[better]
        share[filled[active]] = pi
    return share


def _predictor(langs: list[str], model, carry: tuple[str, ...] = ()):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*langs, UNKNOWN], object)
        for batch in batches:
            texts = [t if t and _has_letter(t) else b"" for t in _bytes(batch)]
            pred, score, sets, shares = [], [], [], []
            for _, run in _runs(texts):
                share = mixtures(run, model.value)
                known = share.sum(axis=1) > 0
                best = share.argmax(axis=1) if len(langs) else np.zeros(len(run), int)
                pred += list(names[np.where(known, best, len(langs))])
                score += list(np.where(known, share.max(axis=1, initial=0.0), 0.0).clip(0, 1))
                for row in share:
                    some = sorted(np.flatnonzero(row > 0), key=lambda i: (-row[i], i))
                    sets.append([langs[i] for i in some])
                    shares.append([float(row[i]) for i in some])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(sets, pa.list_(pa.string())),
                    pa.array(shares, pa.list_(pa.float64())),
                    *[batch.column(c) for c in carry],
                ],
                names=["doc_id", "lang_pred", "score", "languages", "shares", *carry],
            )

    return predict


def identify(docs: DataFrame, labelled: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, languages, shares), one row for each row of docs(doc_id, text, ...).

    labelled(text, lang) trains the model, all of it. languages is the selected set with its shares
    of the text's letters, largest first; lang_pred the first of them, score its share. Null texts
    and texts without a letter, and all texts if nothing is learned, get 'und', 0 and empty lists.
    Equal shares go to the language first by code point. doc_id may be null or repeated. Columns
    named in carry come along as they are (no join is needed to filter documents); others are
    ignored; an empty table gives an empty table.
    """
    langs, table = train(labelled)
    model = docs.sparkSession.sparkContext.broadcast(table)  # of the number of languages
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[c for c in carry if c != "text"],
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("languages", T.ArrayType(T.StringType())),
            T.StructField("shares", T.ArrayType(T.DoubleType())),
        ]
    )
    for c in carry:
        schema.add(rows.schema[c])
    return rows.mapInArrow(tidy(_predictor(langs, model, carry)), schema)


def held_out(doc_id="doc_id"):
    """Whether crc32 of the number as text leaves 2 modulo 4; null for null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def predict_held_out(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """identify() for all docs(doc_id, text, lang), trained on those that are not held out; adds held_out (null number: false, and not learned from)."""
    out = identify(docs, docs.where(~held_out()), carry)
    return out.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
