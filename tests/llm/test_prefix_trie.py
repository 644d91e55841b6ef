import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from picsel.llm import list_rank, prefix_trie
from picsel.llm import queries as Q

DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    got = {}
    for c, turn, role, text in rows:
        if c is not None:
            got.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in got.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, of in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(of) - 1) * len(k[-1][1]) if k else 0
    return sorted(str((min(of), len(k), min(members[k[:-1]]) if k else None, len(of), len(children.get(k, [])), leaves[k], saved[k], hashlib.sha256(
        ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(k)))).encode()).hexdigest())) for k, of in members.items())


def found(df):
    assert df.columns == COLUMNS
    return sorted(str(tuple(r)) for r in df.collect())


def some(seed, n=60, words=3):
    rng = random.Random(seed)
    rows = [(rng.choice((rng.randrange(5), 100 + rng.randrange(n), rng.randrange(400, 404))), rng.randrange(7), rng.choice(("user", "assistant")), rng.choice("abc" [:words]) * rng.randrange(3))
            for _ in range(4 * n)]
    return rows + [(7, None, None, None), (7, 0, "user", ""), (None, 1, "user", "left out"), (8, 2, None, "é日😀"), (8, 2, None, "é日😀"), (900, 1, "user", "only"), (955, 1, "user", "alone"),
                   *[(500, i, "user", f"t{i}") for i in range(40)], *[(501, i, "user", f"t{i}") for i in range(40)], (502, 0, "user", "x" * 200_000)]


@pytest.mark.parametrize("setting", ("production", "small"))
def test_trie(spark, monkeypatch, setting):
    if setting == "small":  # all rounds of the ranking, several buckets, several pieces a node
        for module, name, value in ((list_rank, "LINKS", 40), (list_rank, "LAST", 30), (list_rank, "SUMS", 17), (prefix_trie, "PIECE", 2)):
            monkeypatch.setattr(module, name, value)
    rows = some(1)
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 as depth", "2 as place", "3 as part").repartition(6)
    turns = prefix_trie.turns(df)
    convs = conversations(rows)
    assert found(prefix_trie.prefix_trie(turns, turns.select("conv_id").distinct())) == plain_trie(convs)
    assert found(prefix_trie.prefix_trie(*Q.rebuilt(turns))) == plain_trie(rebuild(convs))


def test_equal_conversations_and_one_long_one(spark, monkeypatch):
    """Most members end at one node, and one conversation has most rows."""
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, t, "user", f"say {t}") for c in range(120) for t in range(3)] + [(1000, t, "user", f"long {t % 5}") for t in range(900)] + [(1001, 0, "user", "say 0")] * 200
    turns = prefix_trie.turns(spark.createDataFrame(rows, DDL))
    convs = {c: ts for c, ts in conversations(rows).items()}
    assert found(prefix_trie.prefix_trie(turns, turns.select("conv_id").distinct())) == plain_trie(convs)


def test_empty(spark):
    turns = prefix_trie.turns(spark.createDataFrame([(None, 1, "user", "x")], DDL))
    assert found(prefix_trie.prefix_trie(*Q.rebuilt(turns))) == []


def test_list_ranks(spark, monkeypatch):
    monkeypatch.setattr(list_rank, "LAST", 25)
    rng = random.Random(2)
    order = rng.sample(range(10_000), 400)
    links = [(a, b, rng.randrange(9)) for a, b in zip(order, [*order[1:], -1])]
    for size in (30, 1000):
        monkeypatch.setattr(list_rank, "LINKS", size)
        got = list_rank.list_ranks(spark.createDataFrame(links, "arc long, succ long, place long")).collect()
        assert sorted((r.arc, r.rank) for r in got) == sorted((a, i) for i, a in enumerate(order))


def test_running_sums(spark, monkeypatch):
    monkeypatch.setattr(list_rank, "SUMS", 6)
    rows = [(i, i * 7 % 5 - 2) for i in range(100)]
    got = list_rank.running_sums(spark.createDataFrame(rows, "rank long, w long").orderBy(F.rand(1)), "rank", ["w"]).collect()
    assert {r["rank"]: r.w for r in got} == {i: sum(w for _, w in rows[:i + 1]) for i in range(100)}
