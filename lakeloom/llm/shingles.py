"""Word shingles of whole texts as 64-bit hashes, computed on whole byte buffers."""

from __future__ import annotations

import numpy as np

U = np.uint64
WIDTH = 5
#: Texts are hashed in runs of about this many bytes, which bounds the working memory.
RUN_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
STEP = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]

_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += U(32)
_lower += U(1)
_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_powers = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((BASE, BASE_INVERSE)):
            table = np.full(size, base, U)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=U)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bijection on 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every run of non-blank bytes, A-Z lower-cased."""
    gap = np.empty(len(buf) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _space[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _power_tables(len(buf))
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(_lower[buf] * up[: len(buf)], out=total[1:])
    return start, mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


def _shingle(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of WIDTH words; of the whole sequence if it is shorter."""
    width = min(WIDTH, len(words))
    out = np.full(len(words) - width + 1, U(width))
    for j in range(width):
        out += words[j : len(words) - width + 1 + j] * U(STEP[j])
    return mix(out)


def shingle_sets(texts: list[bytes | None]):
    """Yield (index, sorted distinct shingle hashes) of each text; empty for null or blank texts."""
    at = 0
    while at < len(texts):
        run, size = [], 0
        while at + len(run) < len(texts) and (not run or size < RUN_BYTES):
            run.append(texts[at + len(run)] or b"")
            size += len(run[-1])
        begins = np.cumsum([0] + [len(x) + 1 for x in run])
        start, hashes = _word_hashes(np.frombuffer(b" ".join(run), np.uint8))
        bounds = np.searchsorted(start, begins)
        for i in range(len(run)):
            words = hashes[bounds[i] : bounds[i + 1]]
            yield at + i, np.unique(_shingle(words)) if len(words) else words[:0]
        at += len(run)


def overlap_needed(a, b):
    """Least intersection of sets of sizes a and b whose Jaccard similarity is 0.8 or more."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: int) -> int:
    """Rarest elements of a set of size n, one of which any similar set must hold among its own."""
    return n - -(-4 * n // 5) + 1


def parity_bits(tokens: np.ndarray) -> bytes:
    """One parity bit for each of about as many hash buckets as the set has elements.

    Two sets differ in at least as many elements as their bit strings do in bits (folded to the
    shorter length), which bounds their intersection from above without reading the sets.
    """
    width = max(6, min(20, int(len(tokens) - 1).bit_length()))
    counts = np.bincount((tokens >> U(64 - width)).astype(np.int64), minlength=1 << width)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the number of elements that only one of the two sets has."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        bits = np.unpackbits(x).reshape(len(y) * 8, -1)
        x = np.packbits(np.bitwise_xor.reduce(bits, axis=1))
    return int(np.bitwise_count(x ^ y).sum())
