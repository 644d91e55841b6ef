"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming lookup, exact weighted-shingle check.

Words are ``\\w+`` of the lower-cased text; shingles have five words (an item with fewer words is one shingle). For every benchmark
item, each window of a document with as many shingles as the item gets a 64-bit SimHash (from its shingles' hashes, by prefix
sums over bits). The items' fingerprints are indexed by ``BLOCKS`` bit blocks: if two fingerprints differ in at most ``RADIUS``
bits, some block differs in at most ``RADIUS // BLOCKS`` bits, so looking up all block values that near in each block finds every
item within the radius. Candidates are verified by exact weighted Jaccard similarity of the shingle counts (0.8 or more).
Windows without any shingle of the items are skipped: their similarity is 0. A document with fewer shingles than an item is
one window itself.

The benchmark is a stated query set against all documents. It is read in blocks whose index takes about ``BLOCK_BYTES`` (texts and
items are counted first); each block's index is broadcast, and any number of blocks gives the same result. A document's windows
are fingerprinted a bounded stretch at a time, so memory grows with its words only, not with windows times items.

Odd rows: null or word-free texts and items match nothing; every row is judged by itself, so repeated rows give repeated
results and null ids stay null; an empty benchmark matches nothing. A very long text is searched a stretch of windows at a time. Other columns are not read by
:func:`contaminated` and passed on by :func:`clean`, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from picsel.llm.common import stage

WIDTH = 5
SIMILARITY = 0.8
BLOCKS = 8
RADIUS = 23
#: About the most memory that the index of one benchmark block takes, and what an item takes of it beside its text.
BLOCK_BYTES = 32 << 20
ITEM_BYTES = 256 * BLOCKS + 512
#: Most word places, and most windows times items, of a stretch of windows that is looked up at once.
STRETCH, CELLS = 4096, 1 << 24
_WORD = re.compile(r"\w+")
_NEAR = np.array([[(a ^ b).bit_count() <= RADIUS // BLOCKS for b in range(256)] for a in range(256)])


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _word_hashes(words: list[str]) -> np.ndarray:
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.fromiter((known[w] for w in words), np.uint64, len(words))


def _shingles(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` word hashes."""
    out = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(out)]
        out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9) ^ out >> np.uint64(32)


def _bit_sums(shingles: np.ndarray) -> np.ndarray:
    """Prefix sums of the shingles' bits."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def _fingerprints(sums: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """The SimHash of each window, as 8 bytes."""
    return np.packbits(2 * (sums[start + size] - sums[start]) > size, axis=1, bitorder="little")


_ONES = np.array([x.bit_count() for x in range(256)], np.uint8)


class _SameSize:
    """The items of one shingle width and number of shingles."""

    def __init__(self, items):
        self.ids = [i for i, _ in items]
        self.size = len(items[0][1])
        self.prints = np.concatenate([_fingerprints(_bit_sums(s), np.zeros(1, np.int64), len(s)) for _, s in items])
        self.counts = [np.unique(s, return_counts=True) for _, s in items]
        # index[b][v]: the items whose block b is near the value v
        self.index = [_NEAR[:, self.prints[:, b]] for b in range(BLOCKS)]

    def candidates(self, prints: np.ndarray) -> np.ndarray:
        """Windows x items within ``RADIUS`` bits, found through the blocks."""
        near = self.index[0][prints[:, 0]]
        for b in range(1, BLOCKS):
            near = near | self.index[b][prints[:, b]]
        w, i = np.nonzero(near)
        away = _ONES[prints[w] ^ self.prints[i]].sum(axis=1)
        near[w, i] = away <= RADIUS
        return near


class Index:
    """The multi-index of one block of benchmark items: ``(item_id, text)`` rows."""

    def __init__(self, rows):
        groups: dict[tuple[int, int], list] = {}
        words: set[str] = set()
        for item, text in rows:
            own = words_of(text)
            if own:
                words.update(own)
                width = min(WIDTH, len(own))
                s = _shingles(_word_hashes(own), width)
                groups.setdefault((width, len(s)), []).append((item, s))
        self.words = {w: i for i, w in enumerate(sorted(words))}
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in sorted(words)], np.uint64)
        self.groups: dict[int, list[_SameSize]] = {}
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for (width, _), items in sorted(groups.items()):
            self.groups.setdefault(width, []).append(_SameSize(items))
        for width, same in self.groups.items():
            pairs = np.unique(np.array([(s, g) for g, x in enumerate(same) for u, _ in x.counts for s in u.tolist()], np.uint64), axis=0)
            self.known[width] = (np.unique(pairs[:, 0]), pairs[:, 0], pairs[:, 1].astype(np.int64))

    def matches(self, text: str | None, threshold: float = SIMILARITY):
        """``item_id, similarity, first word, words`` of the best window of each item that reaches the threshold."""
        words = words_of(text)
        if not words or not self.groups:
            return []
        get = self.words.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        found, hashes = [], None
        for width, same in self.groups.items():
            known, shingle_of, group_of = self.known[width]
            inside = ids >= 0
            if len(ids) < width:
                continue
            full = np.ones(len(ids) - width + 1, bool)
            for k in range(width):
                full &= inside[k:k + len(full)]
            at = np.flatnonzero(full)
            if not len(at):
                continue
            h = self.hashes[ids[at[:, None] + np.arange(width)]]
            own = np.zeros(len(at), np.uint64)
            for k in range(width):
                own = own * np.uint64(0x9E3779B97F4A7C15) + h[:, k]
                own ^= own >> np.uint64(29)
            own = own * np.uint64(0xBF58476D1CE4E5B9) ^ own >> np.uint64(32)
            hit = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own
            if not hit.any():
                continue
            at, own = at[hit], own[hit]
            if hashes is None:
                hashes = _word_hashes(words)
            shingles = _shingles(hashes, width)
            lo, hi = np.searchsorted(shingle_of, own, "left"), np.searchsorted(shingle_of, own, "right")
            hits: dict[int, list[int]] = {}
            for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
                for g in group_of[a:b].tolist():
                    hits.setdefault(g, []).append(p)
            for g, places in hits.items():
                found += self._windows(same[g], shingles, np.array(places), width, threshold)
        return found

    @staticmethod
    def _windows(same: _SameSize, shingles: np.ndarray, places: np.ndarray, width: int, threshold: float):
        size = min(same.size, len(shingles))
        mark = np.zeros(len(shingles) - size + 2, np.int64)
        np.add.at(mark, np.clip(places - size + 1, 0, len(mark) - 2), 1)
        np.add.at(mark, np.minimum(places, len(mark) - 2) + 1, -1)
        start = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        best: dict[int, tuple[float, int]] = {}
        stretch = start // max(1, min(STRETCH, CELLS // len(same.ids)))
        for s in np.split(start, np.flatnonzero(stretch[1:] != stretch[:-1]) + 1):
            first, last = s[0], s[-1] + size
            prints = _fingerprints(_bit_sums(shingles[first:last]), s - first, size)
            near = same.candidates(prints)
            for i in np.flatnonzero(near.any(axis=0)).tolist():
                unique, count = same.counts[i]
                part = shingles[first:last]
                slot = np.minimum(np.searchsorted(unique, part), len(unique) - 1)
                shared = np.r_[0, np.cumsum(unique[slot] == part)]
                mine = s[near[:, i]]
                # the shared shingles bound the smaller counts' sum from above
                upper = np.minimum(shared[mine - first + size] - shared[mine - first], same.size)
                for w, most in zip(mine.tolist(), upper.tolist()):
                    if most >= threshold * (size + same.size - most):
                        u, c = np.unique(shingles[w:w + size], return_counts=True)
                        _, a, b = np.intersect1d(u, unique, assume_unique=True, return_indices=True)
                        low = int(np.minimum(c[a], count[b]).sum())
                        value = low / (size + same.size - low)
                        if value >= threshold and (i not in best or value > best[i][0]):
                            best[i] = (value, w)
        return [(same.ids[i], value, w, size + width - 1) for i, (value, w) in sorted(best.items())]


def _by_block(benchmark: DataFrame, block_bytes: int, search, name: str):
    """``search(index)`` for the broadcast index of each block of the benchmark.

    With several blocks each result is written before the next index is made, so the driver and the workers hold one index at a
    time, however large the benchmark is.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + F.lit(ITEM_BYTES))).first()[0] or 0
    n = -(-total // block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for k in range(n):
        rows = items.filter(block == k).distinct().collect()  # less than BLOCK_BYTES, whatever the benchmark's size
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in rows]))
        found = search(index)
        if n > 1:
            found = stage(found, f"{name}-{k}")
            index.destroy()
        yield found


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("word_start", pa.int64()),
                    ("n_words", pa.int64())])
_FOUND_DDL = "doc_id long, item_id long, similarity double, word_start long, n_words long"


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, similarity, word_start, n_words`` of the best matching window of each document and item."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(index):
        def run(it):
            for batch in it:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                        for m in index.value.matches(t, threshold)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)
        return source.mapInArrow(run, _FOUND_DDL)

    out = docs.sparkSession.createDataFrame([], _FOUND_DDL)
    for found in _by_block(benchmark, block_bytes, search, "contaminated"):
        out = out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any matching window."""
    at, left = docs.columns.index("text"), [docs]

    def search(index):
        def run(it):
            for batch in it:
                yield batch.filter(pa.array([not index.value.matches(t, threshold) for t in batch.column(at).to_pylist()], pa.bool_()))
        return left[-1].mapInArrow(run, docs.schema)

    for found in _by_block(benchmark, block_bytes, search, "clean"):
        left.append(found)
    return left[-1]
