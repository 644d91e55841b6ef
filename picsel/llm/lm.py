"""Interpolated modified Kneser-Ney language model of any order, counted in Spark, kept as sorted hash arrays that workers map.

1. Tasks turn the training documents into n-grams of 64-bit word hashes (a context's hash and the word), count them over blocks
   of tokens, and send each part of the hash space (a range of contexts, cut again by the word, so that a frequent context
   is split) its n-grams as one compressed blob a block.
2. A task a part merges the blobs and writes the part's sorted arrays of n-gram hashes and counts. Each distinct n-gram then counts
   once for the gram without its first word: these go on to the next lower order, which is merged and written in the same way, down
   to pairs. What an order knows of its contexts is summed by context; that of words goes to the word parts.
3. Discounts come from the counts of counts, summed over the parts of an order.
4. Scoring tasks map the arrays into memory and look up the distinct n-grams, contexts and words of a block of documents.

    p(w | u v) = max(c(u v w) - D3(c(u v w)), 0) / c(u v) + gamma(u v) * p(w | v)
    p(w | v)   = max(N(. v w) - D2(N(. v w)), 0) / N(. v .) + gamma(v) * p(w)
    p(w)       = max(N(. w) - E(N(. w)), 0) / N(. .) + gamma * 1 / (V + 1)

The highest order counts occurrences c, the others distinct words before, N; D and E are the modified Kneser-Ney discounts for counts
1, 2 and 3 or more; V is the number of distinct training tokens, and one more stands for all unknown words. An unseen context
leaves the lower order's estimate. A document begins with order - 1 start marks.

The model's folder lies in the cluster's shared folder and must be mounted there, since files are mapped, not read whole.
A worker keeps ``MAPPED`` mappings at most.

Odd rows: a null text is empty (one end token); a null id is a training document (crc32 of no text); repeated rows count
each time; without training documents every token has probability 1 / (V + 1) = 1. A very long text is counted in one block and scored in
one. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections import OrderedDict
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from picsel.llm.common import blocks, stage, stage_path, utf8

END, START = xxhash.xxh3_64_intdigest(b"\n"), xxhash.xxh3_64_intdigest(b"\t")
#: Tokens that a task counts before it sends them (at least, and with very many parts), text of a part, and of a scored block.
BLOCK_TOKENS, BLOCK_MOST, BLOCK_A_PART = 2_000_000, 16_000_000, 64
PART_BYTES = 8 << 20
SCORE_BYTES = 3 << 20
#: Rows of blobs that a merging task holds unmerged, and files that a worker keeps mapped.
MERGE_ROWS, MAPPED = 4_000_000, 4096
#: Each range of contexts is cut into so many parts by the word.
CUTS = 4
_ABOUT = ("total", "n1", "n2", "n3")
_FIELDS = ("c", "cont", *_ABOUT)


def _remainder(id_col: str, mod: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(mod))


class _Hashes:
    """Word hashes; those seen before are remembered, within a bound."""

    def __init__(self, most: int = 400_000):
        self.known, self.most = {}, most

    def __call__(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()
        if len(self.known) > self.most:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        for w in set(words).difference(known):
            known[w] = digest(w)
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        out[-1] = END
        return out


def _grams(tokens: list[np.ndarray], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each token of the documents: the hashes of the 1, 2, ... ``order - 1`` words before it, and its own."""
    word = np.concatenate(tokens)
    starts = np.cumsum([0, *(len(t) for t in tokens[:-1])])
    contexts: list[np.ndarray] = []
    for j in range(1, order):
        before = np.r_[np.full(j, START, np.uint64), word[:-j]][:len(word)]
        for d in range(j):
            before[starts[starts + d < len(word)] + d] = START
        contexts.append(before if j == 1 else _pair_hash(before, contexts[-1]))
    return contexts, word


def _range_of(h: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges a hash is in."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _part_of(context: np.ndarray, word: np.ndarray, ranges: int) -> np.ndarray:
    return _range_of(context, ranges) * CUTS + (word % np.uint64(CUTS)).astype(np.int64)


def _pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (context ^ word * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x = (x + word) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


def _squash(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Sorted distinct grams and their summed counts; columns are the context, its shorter contexts, the word and the count."""
    context, word, n = columns[0], columns[-2], columns[-1]
    order = np.lexsort((word, context))
    columns = [x[order] for x in columns]
    context, word, n = columns[0], columns[-2], columns[-1]
    new = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (word[1:] != word[:-1])]) if len(n) else np.empty(0, np.int64)
    return [x[new] for x in columns[:-1]] + [np.add.reduceat(n, new) if len(new) else n]


def _blob(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers by byte planes, compressed."""
    planes = [np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unblob(data: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(n, 8, -1)
    return [np.ascontiguousarray(x.T).view(np.uint64).reshape(-1) for x in raw]


_BLOBS = pa.schema([("part", pa.int64()), ("blob", pa.binary())])


def _dealt(columns: list[np.ndarray], ranges: int):
    """Squashed grams as ``part, blob`` by their parts, some at a time."""
    part = _part_of(columns[0], columns[-2], ranges)
    order = np.argsort(part, kind="stable")
    columns, part = [x[order] for x in columns], part[order]
    edge = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)] if len(part) else [0]
    for a in range(0, len(edge) - 1, 64):
        cut = [(x, y) for x, y in zip(edge[a:a + 64], edge[a + 1:a + 65])]
        yield [int(part[x]) for x, _ in cut], [_blob(np.diff(columns[0][x:y], prepend=np.uint64(0)), *[c[x:y] for c in columns[1:]]) for x, y in cut]


def _count(ranges: int, order: int):
    most = min(BLOCK_MOST, max(BLOCK_TOKENS, BLOCK_A_PART * ranges * CUTS))

    def run(it):
        hashes, tokens, size = _Hashes(), [], 0

        def flush():
            contexts, word = _grams(tokens, order)
            for parts, data in _dealt(_squash([*contexts[::-1], word, np.ones(len(word), np.int64)]), ranges):
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(data, pa.binary())], schema=_BLOBS)

        for block in blocks(it, "text", 1 << 20):
            for text in block.column("text").to_pylist():
                tokens.append(hashes(utf8(text)))
                size += len(tokens[-1])
                if size >= most:
                    yield from flush()
                    tokens, size = [], 0
        if tokens:
            yield from flush()
    return run


def _local(folder: str) -> str:
    path = folder.removeprefix("file://")
    if "://" in path:
        raise ValueError(f"the model's folder must be mounted on the workers, not {folder}")
    return path


def _save(path: str, array: np.ndarray) -> None:
    """A whole file or none: a repeated task replaces it by the same content."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as f:
        np.save(f, array)
    os.replace(draft, path)


_SUMS = tuple(f"k{i}" for i in range(1, 5))
#: Kinds of rows that a merge sends on: words, the next lower order's grams, contexts of two or more words.
WORDS, LOWER, CONTEXTS = range(3)
_MERGED = pa.schema([("kind", pa.int64()), ("part", pa.int64()), ("blob", pa.binary()), ("size", pa.int64())] + [(k, pa.int64()) for k in _SUMS])
_MERGED_DDL = "kind long, part long, blob binary, size long, " + ", ".join(f"{k} long" for k in _SUMS)


def _counts_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == i).sum()) for i in range(1, 5)]


def _merge(folder: str, k: int, order: int, ranges: int, word_parts: int):
    """Merge and write the grams of ``k`` words, and send on what words, contexts and the next lower order get from them."""
    def add(columns):
        return _squash([*columns[:-1], columns[-1].astype(np.int64)])

    def undo_diff(it):
        """Blobs hold the contexts as differences."""
        for batch in it:
            blobs = [_unblob(b, k + 1) for b in batch.column(1).to_pylist()]
            yield batch.column(0).to_pylist(), [[np.cumsum(b[0], dtype=np.uint64), *b[1:]] for b in blobs]

    def parts(it):
        at, held, rows = None, [], 0
        for part_ids, blobs in undo_diff(it):
            for part, blob in zip(part_ids, blobs):
                if part != at and held:
                    yield at, add([np.concatenate(x) for x in zip(*held)])
                    held, rows = [], 0
                at = part
                held.append(blob)
                rows += len(blob[0])
                if rows > MERGE_ROWS and len(held) > 1:  # what is held unmerged stays bounded
                    held, rows = [add([np.concatenate(x) for x in zip(*held)])], 0
        if held:
            yield at, add([np.concatenate(x) for x in zip(*held)])

    def by_range(kind, rows, head):
        """Summed rows of words or contexts, by the range of their hash."""
        where = _range_of(rows[0], word_parts)
        edge = np.r_[np.flatnonzero(np.r_[True, where[1:] != where[:-1]]), len(where)]
        for a, b in zip(edge[:-1], edge[1:]):
            yield kind, int(where[a]), _blob(*[x[a:b] for x in rows]), head
            head = [0] * 5

    def run(it):
        for part, columns in parts(it):
            context, word, n = columns[0], columns[-2], columns[-1]
            key = _pair_hash(context, word)
            by = np.argsort(key)
            name = f"{folder}/grams{k}/{part}"
            _save(f"{name}.key.npy", key[by])
            _save(f"{name}.n.npy", np.minimum(n[by], 255).astype(np.uint8))
            many = np.flatnonzero(n[by] >= 255)
            _save(f"{name}.many.npy", np.stack([many, n[by][many]]))
            first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            about = [np.add.reduceat(x.astype(np.int64), first) for x in (n, n == 1, n == 2, n > 2)]
            by = np.argsort(word, kind="stable")
            w, m = word[by], n[by]
            start = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            zeros = [np.zeros(len(start), np.int64)] * 4
            c = np.add.reduceat(m, start) if k == order else zeros[0]
            cont = np.diff(np.r_[start, len(w)]) if k == 2 else zeros[0]
            rows = [w[start], c, cont, *zeros]
            if k == 2:  # the contexts are words too
                rows = [np.r_[a, b] for a, b in zip(rows, [context[first], *[np.zeros(len(first), np.int64)] * 2, *about])]
            out = by_range(WORDS, _words(rows), [len(n), *_counts_of_counts(n)])
            if k > 2:
                ones = np.ones(len(n), np.int64)
                lower = ((LOWER, p, b, [0] * 5) for some in _dealt(_squash([*columns[1:-1], ones]), ranges) for p, b in zip(*some))
                out = itertools.chain(out, by_range(CONTEXTS, _words([context[first], *about]), [0] * 5), lower)
            for kind, p, blob, head in out:
                yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int64()), pa.array([p], pa.int64()), pa.array([blob], pa.binary())]
                                                 + [pa.array([x], pa.int64()) for x in head], schema=_MERGED)
    return run


def _words(rows):
    """Sorted distinct words and their summed fields."""
    order = np.argsort(rows[0], kind="stable")
    key = rows[0][order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return [key[new]] + [np.add.reduceat(x[order], new) if len(new) else x for x in rows[1:]]


_WORD_SUMS = ("v", "tokens", *_SUMS, "k3_more")
_STATS = pa.schema([(k, pa.int64()) for k in _WORD_SUMS])


def _summed(it, columns: int):
    """The summed rows of each part of words or contexts; blobs come sorted by part, and are summed as they pass."""
    at, held, rows = None, [], 0

    def total():
        return _words([np.concatenate([h[0] for h in held])] + [np.concatenate([h[i] for h in held]).astype(np.int64) for i in range(1, columns)])
    for batch in it:
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part != at and held:
                yield at, total()
                held, rows = [], 0
            at = part
            held.append(_unblob(blob, columns))
            rows += len(held[-1][0])
            if rows > MERGE_ROWS and len(held) > 1:
                held, rows = [total()], 0
    if held:
        yield at, total()


def _merge_words(folder: str):
    def run(it):
        for part, rows in _summed(it, 1 + len(_FIELDS)):
            _save(f"{folder}/words/{part}.key.npy", rows[0])
            for name, x in zip(_FIELDS, rows[1:]):
                _save(f"{folder}/words/{part}.{name}.npy", x)
            c, cont = rows[1], rows[2]
            # the start mark is a context only
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (
                int((c > 0).sum()), int(c.sum()), *_counts_of_counts(cont), int((cont > 2).sum()))], schema=_STATS)
    return run


def _merge_contexts(folder: str, k: int):
    def run(it):
        for part, rows in _summed(it, 1 + len(_ABOUT)):
            _save(f"{folder}/contexts{k}/{part}.key.npy", rows[0])
            for name, x in zip(_ABOUT, rows[1:]):
                _save(f"{folder}/contexts{k}/{part}.{name}.npy", x)
            yield pa.RecordBatch.from_arrays([pa.array([len(rows[0])], pa.int64())], names=["n"])
    return run


def _discounts(k: list[int]) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more, from the counts of counts 1 to 4."""
    y = k[0] / (k[0] + 2 * k[1]) if k[0] else 0.5
    out = [0.0]
    for i in range(1, 4):
        d = i - (i + 1) * y * k[i] / k[i - 1] if k[i - 1] else y
        out.append(min(max(d, 0.05), i - 0.05))
    return np.array(out)


@dataclass(frozen=True)
class Model:
    """Where a model lies and its few global numbers; ``discounts`` has those of the orders 2, 3, ..."""
    folder: str
    order: int
    ranges: int
    word_parts: int
    tokens: int
    vocabulary: int
    pairs: int
    discounts: tuple
    word_discounts: tuple
    word_gamma: float


def train(docs: DataFrame, part_bytes: int = PART_BYTES, order: int = 2) -> Model:
    """Count the model on all rows of ``text``."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    source = docs.select(F.col("text").cast("string").alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(4, -(-size // (part_bytes * CUTS)))
    word_parts = max(4, -(-size // (4 * part_bytes)))
    folder = _local(stage_path(spark, "model"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df, n: df.select("part", "blob").repartition(n, "part").sortWithinPartitions("part")
    blobs, words, discounts = source.mapInArrow(_count(ranges, order), "part long, blob binary"), [], {}
    for k in range(order, 1, -1):
        merged = dealt(blobs, max(parts, min(ranges * CUTS, 4 * parts))).mapInArrow(_merge(folder, k, order, ranges, word_parts), _MERGED_DDL)
        merged = stage(merged, f"grams{k}")
        counts = merged.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("size", *_SUMS)]).first()
        discounts[k], pairs = tuple(_discounts(list(counts[1:]))), counts[0]
        words.append(merged.where(F.col("kind") == WORDS).select("part", "blob"))
        blobs = merged.where(F.col("kind") == LOWER)
        if k > 2:
            about = dealt(merged.where(F.col("kind") == CONTEXTS), parts).mapInArrow(_merge_contexts(folder, k), "n long")
            stage(about, f"contexts{k}")
    merged_words = dealt(reduce(DataFrame.unionByName, words), parts).mapInArrow(_merge_words(folder), ", ".join(f"{k} long" for k in _WORD_SUMS))
    second = stage(merged_words, "word-stats").agg(*[F.coalesce(F.sum(k), F.lit(0)) for k in _WORD_SUMS]).first()
    word_d = _discounts(list(second[2:6]))
    gamma = (word_d[1] * second[2] + word_d[2] * second[3] + word_d[3] * second[6]) / pairs if pairs else 1.0
    return Model(folder, order, ranges, word_parts, second[1], second[0], pairs, tuple(discounts[k] for k in range(2, order + 1)), tuple(word_d), gamma)


class Arrays:
    """The mapped arrays of a model; one instance a worker and model."""

    _known: dict[str, Arrays] = {}

    def __init__(self, model: Model):
        self.model, self.files = model, OrderedDict()

    @classmethod
    def of(cls, model: Model) -> Arrays:
        if model.folder not in cls._known:
            cls._known.clear()
            cls._known[model.folder] = cls(model)
        return cls._known[model.folder]

    def _map(self, name: str):
        if name not in self.files:
            path = f"{self.model.folder}/{name}.npy"
            # an empty array can't be mapped
            self.files[name] = (np.load(path, mmap_mode="r") if os.path.getsize(path) > 128 else np.load(path)) if os.path.exists(path) else None
            while len(self.files) > MAPPED:
                self.files.popitem(last=False)
        self.files.move_to_end(name)
        return self.files[name]

    def _look(self, kind: str, part: int, key: np.ndarray):
        """Places of the (sorted) keys in a part, and which are there."""
        known = self._map(f"{kind}/{part}.key")
        if known is None or not len(known):
            return None, np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return at, known[at] == key

    def fields(self, kind: str, key: np.ndarray, names: tuple[str, ...]) -> dict[str, np.ndarray]:
        """The fields of sorted distinct words or contexts; 0 if unknown."""
        out = {f: np.zeros(len(key), np.int64) for f in names}
        part = _range_of(key, self.model.word_parts)
        edge = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)] if len(key) else [0]
        for a, b in zip(edge[:-1], edge[1:]):
            at, there = self._look(kind, part[a], key[a:b])
            if there.any():
                for f in names:
                    out[f][a:b][there] = self._map(f"{kind}/{part[a]}.{f}")[at[there]]
        return out

    def grams(self, k: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The counts of grams of ``k`` words."""
        part, key = _part_of(context, word, self.model.ranges), _pair_hash(context, word)
        order = np.lexsort((key, part))
        part, key, n = part[order], key[order], np.zeros(len(key), np.int64)
        edge = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)] if len(key) else [0]
        for a, b in zip(edge[:-1], edge[1:]):
            name = f"grams{k}/{part[a]}"
            at, there = self._look(f"grams{k}", part[a], key[a:b])
            if there.any():
                got = self._map(f"{name}.n")[at[there]].astype(np.int64)
                big = np.flatnonzero(got == 255)
                if len(big):
                    many = self._map(f"{name}.many")
                    got[big] = many[1][np.searchsorted(many[0], at[there][big])]
                n[a:b][there] = got
        out = np.empty(len(n), np.int64)
        out[order] = n
        return out

    def log_probabilities(self, contexts: list[np.ndarray], word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: log10 of the model's probability, log10 of the add-one estimate, and its training count."""
        m = self.model
        key, back = np.unique(np.r_[contexts[0], word], return_inverse=True)
        field = self.fields("words", key, _FIELDS)
        context_at, word_at = back[:len(word)], back[len(word):]
        e, cont = np.array(m.word_discounts), field["cont"]
        p = ((np.maximum(cont - e[np.minimum(cont, 3)], 0) / m.pairs if m.pairs else 0.0) + m.word_gamma / (m.vocabulary + 1))[word_at]
        for k in range(2, m.order + 1):
            if k > 2:
                key, context_at = np.unique(contexts[k - 2], return_inverse=True)
                field_k = self.fields(f"contexts{k}", key, _ABOUT)
            else:
                field_k = field
            d, total = np.array(m.discounts[k - 2]), np.maximum(field_k["total"], 1)
            gamma = np.where(field_k["total"] > 0, (d[1] * field_k["n1"] + d[2] * field_k["n2"] + d[3] * field_k["n3"]) / total, 1.0)
            n = self.grams(k, contexts[k - 2], word)
            p = np.maximum(n - d[np.minimum(n, 3)], 0) / total[context_at] + gamma[context_at] * p
        c = field["c"][word_at]
        return np.log10(p), np.log10((c + 1) / (m.tokens + m.vocabulary + 1)), c


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORES_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out`` and the scores of every row of ``doc_id, held_out, text``; perplexity is 10 ** (-score / n_tokens)."""
    def run(it):
        arrays, hashes = Arrays.of(model), _Hashes()
        for block in blocks(it, "text", SCORE_BYTES):
            tokens = [hashes(utf8(t)) for t in block.column("text").to_pylist()]
            own, base, c = arrays.log_probabilities(*_grams(tokens, model.order))
            size = np.array([len(t) for t in tokens])
            start = np.cumsum(size) - size
            yield pa.RecordBatch.from_arrays([
                block.column(0), block.column(1), pa.array(size.astype(np.int64)), pa.array(np.add.reduceat((c > 0).astype(np.int64), start)),
                pa.array(np.full(len(size), model.tokens, np.int64)), pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(own, start))],
                schema=_SCORES)
    return docs.select(F.col("doc_id").cast("long"), "held_out", F.col("text").cast("string").alias("text")).mapInArrow(run, _SCORES_DDL)


def train_and_score(docs: DataFrame, mod: int = 7, held: int = 2, order: int = 2) -> DataFrame:
    """Learn from the documents whose crc32 of the id has another remainder than ``held``, and score all."""
    marked = docs.select("doc_id", (_remainder("doc_id", mod) == held).alias("held_out"), "text")
    return score(marked, train(marked.filter("not held_out"), order=order))
