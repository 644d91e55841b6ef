import hashlib
import random
import zlib

import numpy as np
import pytest

from picsel.llm import periodic_runs
from picsel.llm import queries as Q
from tests.llm import brute
from tests.llm.conftest import SF


def plain_runs(words):
    """All runs by trying each period at each place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            # periods are tried in ascending order: a stretch with a smaller period has been found with it
            if length >= max(6, 4 * q) and not any(s <= start and start + length <= s + m and q % p == 0 for (s, p), m in found.items()):
                found[start, q] = length
    return sorted((s, m, q) for (s, q), m in found.items())


def plain_collapse(words, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbered(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], np.int64)


def test_overlap_is_the_least_of_each_class():
    assert [periodic_runs.overlap(j) for j in range(5)] == [5, 6, 12, 24, 48]
    for j in range(8):
        assert periodic_runs.overlap(j) == min(max(6, 4 * q) - q for q in range(1 << j, 2 << j)) and periodic_runs.overlap(j) >= (2 << j) - 1


@pytest.mark.parametrize("letters", (1, 2, 3, 8))
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    for _ in range(400):
        words = []
        while len(words) < rng.randrange(90):
            unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
            words += (unit * 9)[:rng.randrange(1, 6 * len(unit) + 1)]
        assert periodic_runs.find_runs(numbered(words)) == plain_runs(words), words


def test_grams_that_recur_within_the_period():
    """Periods in which every short gram occurs several times: the nearest equal 5-gram is never a period away."""
    unit = list("aaaaaabaaaaaabaaaaaaabaaaaaaab")
    thue = [bin(i).count("1") % 2 for i in range(64)]
    for u in (unit, thue, thue[:63], list("abcabcabd") * 2 + ["x"]):
        for times in (4, 5, 9):
            words = ["s", *u * times, *u[:len(u) // 2], "e"]
            assert periodic_runs.find_runs(numbered(words)) == plain_runs(words)
            assert max(q for _, _, q in plain_runs(words)) == len(u)


def test_the_filter_bounds_every_run():
    rng = random.Random(9)
    docs = [[rng.randrange(2) for _ in range(rng.randrange(60))] for _ in range(300)] + [[], [1], [1] * 6, [1] * 5]
    bounds = periodic_runs._longest_repeats([np.array(d, np.int64) for d in docs])
    for words, most in zip(docs, bounds):
        runs = plain_runs(words)
        assert max((m for _, m, _ in runs), default=0) <= most
        assert periodic_runs.find_runs(np.array(words, np.int64), int(most)) == runs


def expected(doc_id, text):
    words = brute.WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = (None,) * 4
    if runs:
        s, m, q = next(r for r in runs if all(r[1] * o[2] >= o[1] * r[2] for o in runs))
        best = (s, m, q, 1000 * m // q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(plain_collapse(words, runs)))


def test_query(spark, documents, rows, monkeypatch):
    short = [r for r in rows if len(r[1] or "") < 9000]
    want = sorted(map(str, (expected(*r) for r in short)))
    monkeypatch.setattr(Q, "table", lambda *a: documents)
    for piece in (periodic_runs.PIECE, 5):
        monkeypatch.setattr(periodic_runs, "PIECE", piece)
        got = Q.op12_periodic_runs(spark, SF)
        assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        found = sorted(str(tuple(r)) for r in got.collect())
        assert len(found) == len(rows) and not set(want) - set(found)
    assert sum(", 0, None" not in w for w in want) > 10


def test_collapse_very_long_and_empty(spark, documents, empty):
    kept = periodic_runs.collapse(documents)
    assert kept.columns == documents.columns and kept.count() == documents.count()
    assert periodic_runs.collapse(empty).count() == 0 and periodic_runs.periodic_runs(empty).count() == 0
    unit = [f"w{i % 977}x{i}" for i in range(20_000)]
    words = ["head", *unit * 20, "tail", *["a", "b"] * 100_000]  # 600,002 words
    docs = spark.createDataFrame([(1, " ".join(words)), (2, None), (None, "z " * 7)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 400_000, 20_000), (400_002, 200_000, 2)]
    assert got[1].collapsed == " ".join(["head", *unit, "tail", "a", "b"]) and got[1].n_words == len(words)
    assert (got[2].runs, got[2].collapsed, got[2].n_words) == ([], "", 0)
    assert [tuple(r) for r in got[None].runs] == [(0, 7, 1)] and got[None].collapsed == "z"
