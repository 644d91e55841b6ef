"""Periodic runs of words by seed and extend on diagonals.

A run is a stretch with smallest period q and at least ``max(LEAST, TIMES * q)`` words that no neighbour extends: from its
start, words at lag q are equal for its length less q. Periods are taken in classes q = 2**j .. 2**(j+1) - 1; all runs of a class
overlap their own shift by ``overlap(j)`` words at least (5, 6, 12, 24, ...), so grams of just that many words are indexed. As
that is q or more, a gram inside a run occurs next exactly q words later (an earlier occurrence would, by Fine and Wilf, give the
run a smaller period). So of a document's occurrence pairs only neighbours are needed, at most one a position and class, and
no frequent gram makes more. Each pair is a seed on the diagonal of its lag; it is extended both ways
over equal words unless the table of the furthest word covered on that diagonal already contains it.

Gram names are exact: a gram is the rank of the pair of its halves. A 64-bit hash of 5-grams is used only to leave out, for
many documents at once, those without repeated grams in a row.

Spark deals out the documents; nothing is shuffled. A task holds ``BATCH`` bytes of texts or one longer text: its bytes, its
distinct words and some numbers a word.

Odd rows: a null text has no words, so no runs and an empty collapsed text; so has an empty one; rows that share a doc_id, or have
none, are separate; runs of equal start are ordered by period; an empty table gives an empty result. Columns of any name can be
carried: the operator's own are added behind, and :func:`collapse` keeps the table's columns whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from picsel.llm.common import blocks

#: A run has this many words at least, and this many times its period.
LEAST, TIMES = 6, 4
#: Bytes of the texts that are worked on together, and of a piece of a text that is split at once.
BATCH, PIECE = 4 << 20, 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
RUNS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("collapsed", T.StringType()),
                     T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])))])
#: From a document's id and number of words: where its last part starts and how many words of it are repeated to the end.
Tail = Callable[[object, int], "tuple[int, int] | None"]


def overlap(j: int) -> int:
    """Words that any run of the periods 2**j .. 2**(j+1) - 1 has in common with itself shifted by its period."""
    low, high = 1 << j, 2 << j
    return min(max(LEAST, TIMES * q) - q for q in range(low, min(high, max(low + 1, LEAST))))


def word_numbers(text: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers, new ones added to ``numbers``; split piece by piece."""
    out, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.start() if cut else len(text)
        words = text[at:end].split()
        out.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _rank(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact names of the pairs, the positions in order of name (then position), and whether each has the name of the next."""
    pair = left * (int(right.max(initial=0)) + 1) + right
    order = np.argsort(pair, kind="stable")
    same = pair[order[1:]] == pair[order[:-1]]
    names = np.empty(len(pair), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])[:len(pair)]
    return names, order, same


def _right(words: np.ndarray, at: int, lag: int) -> int:
    """The first position from ``at`` on whose word differs from the one ``lag`` further, or has none there."""
    size, end = 64, len(words) - lag
    while at < end:
        stop = min(at + size, end)
        differ = words[at:stop] != words[at + lag:stop + lag]
        if differ.any():
            return at + int(differ.argmax())
        at, size = stop, 4 * size
    return end


def _left(words: np.ndarray, at: int, lag: int) -> int:
    """The first position of the equal words that reach up to ``at``."""
    size = 64
    while at > 0:
        stop = max(at - size, 0)
        differ = words[stop:at] != words[stop + lag:at + lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, size = stop, 4 * size
    return 0


def _smaller_period(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of at least two periods has a smaller one: then (Fine and Wilf) it divides ``period``."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            while rest % factor == 0:
                rest //= factor
            d = period // factor
            if (words[start:start + period] == words[start + d:start + d + period]).all():
                return True
        factor += 1
    return False


def find_runs(words: np.ndarray, most: int | None = None) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs, by start and period; ``most`` bounds the length of a run if that is known."""
    n = len(words)
    most = n if most is None else min(most, n)
    if most < LEAST:
        return []
    two = _rank(words[:-1], words[1:])[0]
    three = _rank(two[:-1], words[2:])[0]
    found, j, grams = [], 0, None
    while max(LEAST, TIMES << j) <= most:
        if j == 0:
            _, order, same = _rank(three[:-2], two[3:])
        else:
            half = three if j == 1 else grams
            grams, order, same = _rank(half[:-overlap(j) // 2], half[overlap(j) // 2:])
        at, lag = order[:-1][same], np.diff(order)[same]
        mine = (lag >= 1 << j) & (lag < 2 << j)
        at, lag = at[mine], lag[mine]
        by = np.lexsort((at, lag))
        at, lag = at[by], lag[by]
        starts = np.flatnonzero(np.diff(lag, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(lag)]):
            period, seeds = int(lag[a]), at[a:b]
            i = 0
            while i < len(seeds):
                start = _left(words, int(seeds[i]), period)
                covered = _right(words, int(seeds[i]) + 1, period)
                length = covered - start + period
                if length >= max(LEAST, TIMES * period) and not _smaller_period(words, start, period):
                    found.append((start, length, period))
                i += int(np.searchsorted(seeds[i:], covered))
        j += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _longest_repeats(docs: list[np.ndarray]) -> np.ndarray:
    """For each document a bound on the length of its runs: its longest stretch of grams that occur again, in words."""
    sizes = np.array([len(d) for d in docs], np.int64)
    out = np.zeros(len(docs), np.int64)
    width = LEAST - 1
    keep = np.flatnonzero(sizes >= LEAST)
    if not len(keep):
        return out
    every, owner = np.concatenate([docs[k] for k in keep]).astype(np.uint64), np.repeat(keep, sizes[keep])
    last = len(every) - width + 1
    h = owner[:last].astype(np.uint64)
    for d in range(width):
        h = (h ^ (h >> np.uint64(29)) ^ every[d:last + d]) * np.uint64(0x9E3779B97F4A7C15)
    inside = owner[:last] == owner[width - 1:]
    where = np.flatnonzero(inside)
    order = where[np.argsort(h[where], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    again = np.zeros(last + 1, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edge = np.diff(again.astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # grams that cross into the next document never repeat, so a stretch has one owner
    np.maximum.at(out, owner[begin], end - begin + width - 1)
    return out


def _collapsed(words: np.ndarray, runs: list[tuple[int, int, int]], names: list[bytes]) -> bytes:
    """The words joined by one space, of each run the first period only."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = words[np.cumsum(gone[:-1]) == 0]
    return b" ".join(map(names.__getitem__, kept.tolist()))


def _texts(batch: pa.RecordBatch, id_at: int, text_at: int, tail: Tail | None):
    """Word numbers of each text of a batch and the words by number."""
    numbers: dict[bytes, int] = {}
    docs = []
    for doc_id, text in zip(batch.column(id_at), batch.column(text_at)):
        text = text.as_buffer()
        words = word_numbers(b"" if text is None else text.to_pybytes(), numbers)
        cut = tail(doc_id.as_py(), len(words)) if tail is not None else None
        if cut is not None:
            words = np.concatenate([words[:cut[0]], words[cut[0] + np.arange(len(words) - cut[0]) % cut[1]]])
        docs.append(words)
    return docs, list(numbers)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), tail: Tail | None = None) -> DataFrame:
    """The columns ``carry`` and ``n_words``, ``collapsed`` (the text without repeated periods) and ``runs`` of every row.

    ``tail(doc_id, n)`` may give ``(a, p)``: then the document's words from ``a`` on are its ``p`` words from there, over and over.
    """
    rows = docs.select(*[F.col(c) for c in carry], F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:len(carry)], *RUNS.fields])
    arrow, at = to_arrow_schema(schema), len(carry)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in blocks(iter([batch]), "_text", BATCH):
                texts, names = _texts(part, at, at + 1, tail)
                runs = [find_runs(w, int(m)) if m >= LEAST else [] for w, m in zip(texts, _longest_repeats(texts))]
                offsets = np.cumsum([0, *map(len, runs)])
                flat = np.array([r for of in runs for r in of], np.int64).reshape(-1, 3)
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(flat[:, c]) for c in range(3)], fields=list(arrow.field("runs").type.value_type)))
                collapsed = pa.array([_collapsed(w, r, names) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array([len(w) for w in texts], pa.int64()), collapsed,
                                                  listed.cast(arrow.field("runs").type)], schema=arrow)
    return rows.mapInArrow(run, schema)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each text's words joined by one space, of each run the first period only."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    found = periodic_runs(docs.toDF(*names), text, text, tuple(n for n in names if n != text))
    return found.select(*[F.col("collapsed" if n == text else n).alias(c) for n, c in zip(names, docs.columns)])
