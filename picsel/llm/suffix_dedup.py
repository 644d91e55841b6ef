"""Exact substring dedup: bytes covered by a ``width``-byte string that also starts earlier are removed.

Matches never cross documents; strings are judged on the input. "Earlier" means a smaller document key, or the same document
and a smaller start.

1. Suffix buckets. Of the ``GRAM``-byte grams in a window of ``width`` bytes, the one with the smallest hash is the window's
   anchor. Equal windows have equal anchors at equal places, so all suffixes that can share ``width`` bytes meet in the bucket
   of one anchor hash, and a bucket is found without sorting the rest. Windows in a row with one anchor form a run.
2. Runs with the same bytes form a class; all but the earliest run of a class are covered without any sort. Each task first
   folds its own runs, so a passage in a third of all documents reaches the shuffle once a task. A bucket of which a block
   of documents alone has ``HOT`` classes, as where a common phrase stands in ever other surroundings, is salted: its runs
   are dealt out by class as well, and all its classes go on to step 3.
3. Buckets with several classes are sorted, one bucket or a bounded batch of small ones at a time, by their blockwise suffix
   array: order by the first ``PERIOD`` bytes, then settle longer ties by ternary partition on the ranks of the difference-cover
   sample: for any two suffixes there is an offset below ``PERIOD`` at which both are sample positions, whose ranks to
   ``4 * PERIOD`` bytes are computed once a batch. Neighbours in the array that share ``width`` bytes are repeats.
   Memory is bounded by the batch. A bucket with more than ``cap`` classes is dealt out by the hash of each window instead,
   which Spark pre-aggregates, so no task holds it.

Odd rows: a null text is empty; texts under ``width`` bytes lose nothing. Documents are ordered by ``doc_id``, nulls last,
and rows with the same or no ``doc_id`` by their text; equal rows keep one of them. An empty table gives an empty result. A very long text is worked on in overlapping chunks.
:func:`removed` reads no other columns; :func:`without_repeats` passes them on whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from picsel.llm.common import blocks, stage, utf8

WIDTH = 100
GRAM = 32
PERIOD = 32
#: Most classes of a bucket that is sorted in one task, and most bytes of a batch of buckets.
CAP = 20_000
#: Classes of one bucket in a block of documents from which on the bucket is salted.
HOT = 256
BATCH = 3 << 20
_CHUNK = 1 << 19
_POS = np.uint64((1 << 20) - 1)
_BASE, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``GRAM``-byte gram, by doubling."""
    h, power, size = raw.astype(np.uint64) + np.uint64(1), _BASE, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(power) + h[size:]
        power, size = power * power % (1 << 64), 2 * size
    h ^= h >> np.uint64(32)
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:-(width - size)], x[width - size:]) if width > size else x


def runs(raw: bytes, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """``hash, anchor, lo, hi`` of the runs of window starts ``lo..hi`` with one anchor."""
    out = []
    for first in range(0, len(raw) - width + 1, _CHUNK):
        part = np.frombuffer(raw, np.uint8, min(len(raw) - first, _CHUNK + width - 1), first)
        h = _gram_hashes(part)
        key = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(key, width - GRAM + 1) & _POS).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        hi = np.r_[lo[1:], len(at)] - 1
        out.append((h[at[lo]].view(np.int64), at[lo] + first, lo + first, hi + first))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the ranges, as maximal ranges in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    return start[new], end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]]


_RUNS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("key", pa.int64()), ("p", pa.int64())])
_RUNS_DDL = "h long, c long, key long, p long"


def _pack(anchor, lo, hi):
    return lo << 14 | (anchor - lo) << 7 | (hi - lo)


#: Marks a run of a salted bucket, in ``p``.
_SALTED = 1 << 61


def _unpack(p):
    p = p & (_SALTED - 1)
    lo = p >> 14
    return lo + (p >> 7 & 127), lo, lo + (p & 127)


def _by_key(key, start, end):
    """The merged ranges of each key."""
    order = np.argsort(key, kind="stable")
    key, start, end = key[order], start[order], end[order]
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    got = []
    for a, b in zip(edge, np.r_[edge[1:], len(key)]):
        s, e = _merged(start[a:b], end[a:b])
        got.append((np.full(len(s), key[a]), s, e))
    return tuple(np.concatenate(x) for x in zip(*got)) if got else (np.empty(0, np.int64),) * 3


def _fold_runs(width, hot):
    """Runs of a block of documents: the earliest of each class, and what its others cover (``p`` negative, ``c`` the end).

    The runs of a bucket with ``hot`` classes are marked; one run of it that is not tells the bucket's other runs, which may
    not be marked in other blocks, that they are not alone.
    """
    def run(it):
        for block in blocks(it, "text", 6 << 20):
            cols = []
            for key, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist()):
                raw = utf8(text)
                if len(raw) < width:
                    continue
                h, anchor, lo, hi = runs(raw, width)
                digest = xxhash.xxh3_64_intdigest
                c = np.fromiter((digest(raw[a:b], d) for a, b, d in zip(lo.tolist(), (hi + width).tolist(), (anchor - lo).tolist())),
                                np.uint64, len(lo)).view(np.int64)
                cols.append((h, c, np.full(len(h), key, np.int64), lo, hi, _pack(anchor, lo, hi)))
            if not cols:
                continue
            h, c, key, lo, hi, p = (np.concatenate(x) for x in zip(*cols))
            order = np.lexsort((lo, key, c, h))
            later = np.r_[False, (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])]
            first, rest = order[~later], order[later]
            k, s, e = _by_key(key[rest], lo[rest], hi[rest] + width)
            bucket = h[first]
            edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            size = np.diff(np.r_[edge, len(bucket)])
            many = edge[size >= hot]
            p[first[np.repeat(size >= hot, size)]] |= _SALTED
            first = np.r_[first, first[many]]  # once more, as a class of its own that is not marked
            mark = np.r_[p[first[:len(bucket)]], p[first[len(bucket):]] & ~_SALTED]
            spread = (k * 0x9E3779B1 + s) * 0x85EBCA6B  # anywhere: these rows only pass through
            for x in range(0, len(first), 1 << 16):
                f = first[x:x + (1 << 16)]
                c_ = c[f] ^ (np.arange(x, x + len(f)) >= len(bucket))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (h[f], c_, key[f], mark[x:x + (1 << 16)])], schema=_RUNS)
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (spread, e, k, -s - 1)], schema=_RUNS)
    return run


_FOUND = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("p", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND_DDL = "h long, key long, p long, start long, end long"


def _classes(width):
    """Runs sorted by bucket, class and place: what is covered, and the first run of each class of a bucket with several."""
    def emit(h, key, p, start, end):
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(key), pa.array(p), pa.array(start), pa.array(end)], schema=_FOUND)

    def run(it):
        last = waiting = None  # (h, c) of the row before; the first run of a bucket that has shown one class so far
        marked = None  # (h, c) of the marked row before
        for batch in it:
            h, c, key, p = (batch.column(i).to_numpy() for i in range(4))
            through = p < 0
            if through.any():
                k, s, e = key[through], -p[through] - 1, c[through]
                none = pa.nulls(len(k), pa.int64())
                yield emit(none, k, none, s, e)
                h, c, key, p = h[~through], c[~through], key[~through], p[~through]
            salted = p & _SALTED != 0
            if salted.any():
                sh, sc, sk, sp = h[salted], c[salted], key[salted], p[salted]
                new = np.r_[marked is None or (sh[0], sc[0]) != marked, (sh[1:] != sh[:-1]) | (sc[1:] != sc[:-1])]
                marked = (sh[-1], sc[-1])
                none = pa.nulls(int(new.sum()), pa.int64())
                yield emit(sh[new], sk[new], sp[new] & (_SALTED - 1), none, none)
                _, lo, hi = _unpack(sp[~new])
                k, s, e = _by_key(sk[~new], lo, hi + width)
                none = pa.nulls(len(k), pa.int64())
                yield emit(none, k, none, s, e)
                h, c, key, p = h[~salted], c[~salted], key[~salted], p[~salted]
            if not len(h):
                continue
            new_h = np.r_[last is None or h[0] != last[0], h[1:] != h[:-1]]
            new_c = new_h | np.r_[last is None or c[0] != last[1], c[1:] != c[:-1]]
            last = (h[-1], c[-1])
            old = ~new_c
            if old.any():
                _, lo, hi = _unpack(p[old])
                k, s, e = _by_key(key[old], lo, hi + width)
                none = pa.nulls(len(k), pa.int64())
                yield emit(none, k, none, s, e)
            f = np.flatnonzero(new_c)
            if not len(f):
                continue
            starts = new_h[f]
            if waiting is not None and not starts[0]:
                yield emit(*[np.array([x], np.int64) for x in waiting], pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()))
            followed = np.r_[~starts[1:], False]
            need = f[~starts | followed]
            waiting = (h[f[-1]], key[f[-1]], p[f[-1]]) if starts[-1] else None
            none = pa.nulls(len(need), pa.int64())
            yield emit(h[need], key[need], p[need], none, none)
    return run


# the difference cover: any d below PERIOD is the difference of two of its members (mod PERIOD)
_STEP = 6
COVER = sorted({*range(_STEP), *range(0, PERIOD, _STEP)})
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_OFFSET = np.array([[next(d for d in range(PERIOD) if _IN_COVER[(a + d) % PERIOD] and _IN_COVER[(b + d) % PERIOD])
                     for b in range(PERIOD)] for a in range(PERIOD)])


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks by the keys, the first one leading."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_array(text: np.ndarray, at: np.ndarray, bucket: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` at ``at``, sorted within their buckets; and whether each shares ``width`` bytes with the one before.

    Suffixes that share their first ``PERIOD`` bytes with no other of their bucket are left out. The order is that of the
    first ``4 * PERIOD`` bytes at least, which covers ``width``.
    """
    pad = 8 * PERIOD
    words = np.concatenate([text, np.zeros(pad, np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        words = words[:-size] << np.uint64(8 * size) | words[size:]
    head = [words[at + k] for k in range(0, PERIOD, 8)]
    group = _dense(bucket, *head)
    tied = np.bincount(group)[group] > 1
    order = np.flatnonzero(tied)
    order = order[np.argsort(group[order], kind="stable")]
    pos, group, bucket = at[order], group[order], bucket[order]
    # ranks of the sample, by doubling: a sample position plus PERIOD is one too
    sample = np.flatnonzero(_IN_COVER[np.arange(len(text) + 4 * PERIOD) % PERIOD])
    place = np.full(len(text) + pad, len(sample), np.int64)
    place[sample] = np.arange(len(sample))
    inside = np.minimum(sample, len(text))  # beyond the end all is padding
    rank = _dense(*[words[inside + k] for k in range(0, PERIOD, 8)])
    for step in (PERIOD, 2 * PERIOD):
        rank = _dense(rank, np.r_[rank, -1][place[np.minimum(sample + step, len(place) - 1)]])
    rank = np.r_[rank, -1]
    open_ = np.ones(len(pos), bool)
    while open_.any():
        slot = np.flatnonzero(open_)
        g = group[slot]
        edge = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        count = np.diff(np.r_[edge, len(g)])
        pivot = np.repeat(pos[slot[edge + count // 2]], count)
        mine = pos[slot]
        off = _OFFSET[mine % PERIOD, pivot % PERIOD]
        side = np.sign(rank[place[mine + off]] - rank[place[pivot + off]])
        move = np.lexsort((side, g))
        pos[slot], side, g = mine[move], side[move], g[move]
        new = np.r_[True, (g[1:] != g[:-1]) | (side[1:] != side[:-1])]
        size = np.diff(np.r_[np.flatnonzero(new), len(g)])
        group[slot] = group.max() + np.cumsum(new) if len(g) else group[slot]
        open_[slot] = (side != 0) & (np.repeat(size, size) > 1)
    same = np.r_[False, bucket[1:] == bucket[:-1]]
    for k in [*range(0, width - 8, 8), width - 8]:
        w = words[pos + k]
        same &= np.r_[False, w[1:] == w[:-1]]
    return pos, same


def _repeats(rows: list[tuple], width: int) -> tuple[np.ndarray, ...]:
    """``key, start, end`` covered among the runs ``(h, key, lo, bytes)`` of whole buckets."""
    sizes = np.array([len(r[3]) for r in rows])
    base = np.r_[0, np.cumsum(sizes)[:-1]]
    text = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    count = sizes - width + 1
    owner = np.repeat(np.arange(len(rows)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = base[owner] + within
    h = np.array([r[0] for r in rows], np.int64)
    key = np.array([r[1] for r in rows], np.int64)
    lo = np.array([r[2] for r in rows], np.int64)
    pos, same = suffix_array(text, at, h[owner], width)
    if not same.any():
        return (np.empty(0, np.int64),) * 3
    who = np.searchsorted(base, pos, "right") - 1
    k, s = key[who], lo[who] + pos - base[who]
    edge = np.flatnonzero(~same)
    rank = _dense(k, s)  # a run may come twice: its windows are no repeats of themselves
    first = np.repeat(np.minimum.reduceat(rank, edge), np.diff(np.r_[edge, len(pos)]))
    later = rank != first
    return _by_key(k[later], s[later], s[later] + width)


_RANGES = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_RANGES_DDL = "key long, start long, end long"


def _sort_buckets(width):
    def run(it):
        held, size = [], 0

        def flush(rows):
            k, s, e = _repeats(rows, width)
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k, s, e)], schema=_RANGES)

        for batch in it:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= BATCH and held[-1][0] != row[0]:
                    yield from flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from flush(held)
    return run


_CUT = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("lo", pa.int64()), ("bytes", pa.binary())])


def _cut_runs(width):
    """The bytes of the listed runs of each document."""
    def run(it):
        unpack = zstandard.ZstdDecompressor()
        for batch in it:
            for key, packed, listed in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                raw = unpack.decompress(packed)
                h = [r["h"] for r in listed]
                _, lo, hi = _unpack(np.array([r["p"] for r in listed], np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(h, pa.int64()), pa.array([key] * len(h), pa.int64()), pa.array(lo),
                    pa.array([raw[a:b] for a, b in zip(lo.tolist(), (hi + width).tolist())], pa.binary())], schema=_CUT)
    return run


_HASHED = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("key", pa.int64()), ("start", pa.int64())])


def _windows(width):
    """Every window of the runs by a 128-bit hash."""
    def run(it):
        for batch in it:
            key, lo, data = (batch.column(n).to_pylist() for n in ("key", "lo", "bytes"))
            for k, first, raw in zip(key, lo, data):
                n = len(raw) - width + 1
                h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i:i + width]) for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])), pa.array(np.full(n, k, np.int64)),
                    pa.array(np.arange(first, first + n, dtype=np.int64))], schema=_HASHED)
    return run


def _packed(keyed: DataFrame) -> DataFrame:
    """``key`` and the text as one zstandard frame: a third of the bytes to shuffle."""
    schema = pa.schema([("key", pa.int64()), ("packed", pa.binary())])

    def run(it):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack.compress(utf8(t)) for t in batch.column(1).to_pylist()], pa.binary())],
                                             schema=schema)
    return keyed.select("key", "text").mapInArrow(run, "key long, packed binary")


def covered(keyed: DataFrame, width: int = WIDTH, cap: int = CAP, hot: int = HOT) -> DataFrame:
    """``key, start, end`` byte ranges to remove; ``keyed`` has unique ``key`` (in order of precedence) and ``text``."""
    rows = keyed.select("key", "text").mapInArrow(_fold_runs(width, hot), _RUNS_DDL)
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = (F.col("p") >= 0) & (F.col("p").bitwiseAND(F.lit(_SALTED)) != 0)
    ordered = rows.repartition(parts, F.when(salted, F.xxhash64("h", "c")).otherwise(F.col("h"))).sortWithinPartitions("h", "c", "key", "p")
    found = stage(ordered.mapInArrow(_classes(width), _FOUND_DDL), "classes")
    ranges = found.filter("h is null").select("key", "start", "end")
    listed = found.filter("h is not null").select("h", "key", "p")
    crowded = stage(listed.groupBy("h").count().filter(F.col("count") > cap).select("h"), "crowded")
    asked = listed.groupBy("key").agg(F.collect_list(F.struct("h", "p")).alias("listed"))  # as many as a text has runs
    cut = stage(_packed(keyed).join(asked, "key").select("key", "packed", "listed")
                .mapInArrow(_cut_runs(width), "h long, key long, lo long, bytes binary"), "runs")
    sorted_ = cut
    if not crowded.isEmpty():
        sorted_ = cut.join(crowded, "h", "left_anti").select("h", "key", "lo", "bytes")
        each = stage(cut.join(crowded, "h", "left_semi").mapInArrow(_windows(width), "w1 long, w2 long, key long, start long"), "windows")
        first = each.groupBy("w1", "w2").agg(F.min(F.struct("key", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        again = each.join(first, ["w1", "w2"]).filter(F.struct("key", "start") > F.col("first"))
        ranges = ranges.unionByName(again.select("key", "start", (F.col("start") + width).alias("end")))
    sorted_ = sorted_.repartition(parts, "h").sortWithinPartitions("h")
    return ranges.unionByName(stage(sorted_.mapInArrow(_sort_buckets(width), _RANGES_DDL), "repeats"))


def _spans(listed) -> tuple[np.ndarray, np.ndarray]:
    return _merged(np.array([r["start"] for r in listed or ()], np.int64), np.array([r["end"] for r in listed or ()], np.int64))


def _rest(raw: bytes, start, end) -> bytes:
    out, at = [], 0
    for a, b in zip(start.tolist(), end.tolist()):
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out)


def keyed_by_id(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """``docs`` with a unique ``__picsel_key`` in document order: the id, or (then True) a rank if ids repeat or are missing."""
    ids = docs.groupBy(F.col(id_col)).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())
    if ids.isEmpty():
        return docs.withColumn("__picsel_key", F.col(id_col).cast("long")), False
    ordered = docs.orderBy(F.col(id_col).asc_nulls_last(), "text")
    return stage(ordered.withColumn("__picsel_key", F.monotonically_increasing_id()), "keyed"), True


def _range_lists(keyed: DataFrame, width: int, cap: int, hot: int) -> DataFrame:
    """``key`` and its ranges; a list has at most as many ranges as the text has windows."""
    return covered(keyed, width, cap, hot).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))


def removed(docs: DataFrame, width: int = WIDTH, cap: int = CAP, hot: int = HOT) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, spans`` (byte ranges) and ``kept_sha256`` of the remaining bytes."""
    docs, ranked = keyed_by_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    keyed = docs.select(F.col("__picsel_key").alias("key"), "text")
    schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])

    def run(it):
        unpack = zstandard.ZstdDecompressor()
        for batch in it:
            out = []
            for key, packed, listed in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                raw = unpack.decompress(packed)
                s, e = _spans(listed)
                out.append((key, len(raw), int((e - s).sum()), len(s), [{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())],
                            hashlib.sha256(_rest(raw, s, e)).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    got = _packed(keyed).join(_range_lists(keyed, width, cap, hot), "key", "left").select("key", "packed", "ranges").mapInArrow(
        run, "key long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_sha256 string")
    if ranked:
        got = got.join(docs.select(F.col("__picsel_key").alias("key"), "doc_id"), "key")
    else:
        got = got.withColumnRenamed("key", "doc_id")
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")


def _whole_characters(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """The range without the parts of characters that it cuts."""
    while start < end and raw[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def without_repeats(docs: DataFrame, width: int = WIDTH, cap: int = CAP, hot: int = HOT) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (and ``n_chars`` set, if there is such a column).

    A character is cut only if all its bytes are. Documents of which no word is left are dropped, if anything was cut.
    """
    keyed, _ = keyed_by_id(docs)
    lists = _range_lists(keyed.select(F.col("__picsel_key").alias("key"), "text"), width, cap, hot).toDF("__picsel_k", "__picsel_ranges")
    joined = keyed.join(lists, F.col("__picsel_key") == F.col("__picsel_k"), "left").drop("__picsel_key", "__picsel_k")
    at, names = docs.columns.index("text"), docs.columns

    def run(it):
        for batch in it:
            texts, keep = batch.column(at).to_pylist(), []
            for i, listed in enumerate(batch.column(len(names)).to_pylist()):
                if listed:
                    raw = utf8(texts[i])
                    cut = [_whole_characters(raw, a, b) for a, b in zip(*[x.tolist() for x in _spans(listed)])]
                    left = _rest(raw, np.array([a for a, _ in cut], np.int64), np.array([b for _, b in cut], np.int64))
                    texts[i] = left.decode("utf-8")
                    if not left.split():
                        continue
                keep.append(i)
            columns = batch.columns[:len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            if "n_chars" in names:
                k = names.index("n_chars")
                old = columns[k].to_pylist()
                columns[k] = pa.array([len(t) if r and t is not None else n for t, r, n in
                                       zip(texts, batch.column(len(names)).to_pylist(), old)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).take(pa.array(keep, pa.int64()))

    return joined.select(*names, "__picsel_ranges").mapInArrow(run, docs.schema)
