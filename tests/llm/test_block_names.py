import hashlib

import pytest
from pyspark.sql import functions as F

from picsel.llm import block_names
from tests.llm.conftest import DDL
from tests.llm.test_operators import key


def want(rows):
    """Groups of equal texts; in each the largest doc_id is kept, once."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i), reverse=True)
        out += [(i, ids[0], len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(map(key, out))


def got(docs, **kw):
    return sorted(key(tuple(r)) for r in block_names.exact_duplicates(docs, **kw).collect())


@pytest.mark.parametrize("block", (7, 64, 1024))
def test_exact_duplicates(documents, rows, block):
    result = block_names.exact_duplicates(documents, block=block)
    assert result.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(key(tuple(r)) for r in result.collect()) == want(rows)


def test_block_edges_and_near_copies(spark):
    """Texts that differ in length, in one byte, or in the order of their blocks only."""
    a, b, c = "a" * 8, "b" * 8, "é" * 4
    texts = [a, a + b, b + a, a + b + c, a + c + b, a + b + a + b, a + b + a, a + b + a + b + c, a + b + c + "x", a[:7], a + "\x00", a, b + a, "", None]
    rows = [(n, t) for n, t in enumerate(texts)] + [(n + 50, t) for n, t in enumerate(texts[:6])] + [(3, a + b + c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1, 3, 8, 16):
        assert got(docs, block=block) == want(rows)


def test_heavy_blocks_are_spread(spark, monkeypatch):
    """The same result with every block or pair named beforehand as with none."""
    rows = [(n, "same block " * 3 + ("" if n % 3 else f"tail {n % 7}")) for n in range(200)] + [(n, f"text {n}" * 9) for n in range(200, 260)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for heavy in (1 << 40, 40, 0):
        monkeypatch.setattr(block_names, "HEAVY", heavy)
        assert got(docs, block=11) == want(rows)


def test_one_very_long_text(spark):
    long = "".join(chr(97 + n % 26) for n in range(100_000)) * 30
    rows = [(1, long), (2, long), (3, long[:-1]), (4, "x" + long[1:]), (5, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs) == want(rows)


def test_empty_table_and_keep_one(spark, empty, documents, rows):
    assert got(empty) == []
    kept = block_names.keep_one(documents)
    assert kept.columns == documents.columns
    groups = {}
    for i, t in rows:
        groups[t or ""] = max(groups.get(t or "", -1), -1 if i is None else i)
    assert sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == sorted(groups.items())


def test_native_plan(documents):
    """No Python in the plan, and the rows of a block are not joined back."""
    named = block_names.named(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("block")), ["block"], 100)
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortMergeJoin" not in plan
    assert documents.schema.names[:5] == DDL.replace(" long", "").replace(" string", "").split(", ")
