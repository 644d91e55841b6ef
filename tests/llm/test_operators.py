import functools
import hashlib
import io
import json
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from picsel.llm import bpe, chat, components, decontam, langid, lm, quality, sharding, simhash, suffix_dedup, token_store
from picsel.llm import queries as Q
from tests.llm import brute
from tests.llm.conftest import ODD, SF


def key(x):
    return json.dumps(x, default=str)


def test_simhash(documents, rows):
    got = simhash.near_duplicates(documents).collect()
    fps = {}
    for i, t in rows:
        fps.setdefault(brute.simhash(t), []).append(i)
    nodes = sorted(fps)
    group = dict(zip(nodes, brute.components(nodes)))
    least = {}
    for f, ids in fps.items():
        least.setdefault(group[f], []).extend(i for i in ids if i is not None)
    want = sorted(key((i, f, min(least[group[f]], default=None))) for f, ids in fps.items() for i in ids)
    assert sorted(key((r.doc_id, r.fp & (1 << 64) - 1, r.component_id)) for r in got) == want


def test_bk_tree_follows_only_near_edges():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (1 << 64) - 1 for b in base for _ in range(20)})
    tree = simhash.BKTree()
    for f in fps:
        tree.add(f)
    for f in fps[::7]:
        assert sorted(tree.nodes[i] for i in tree.within(f, 3)) == [g for g in sorted(fps) if (f ^ g).bit_count() <= 3]


def test_simhash_splits_crowded_shards(spark):
    rng = random.Random(5)
    near = [0xF0F0F0F0F0F0F0F0 ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(150)]
    fps = sorted({*near, *(rng.getrandbits(64) for _ in range(150))})
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    want = brute.components(fps)
    for cap in (4, 4096):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for r in simhash.links(frame, 3, cap).collect():
            a, b = sorted(find(x & (1 << 64) - 1) for x in r)
            root[b] = a
        assert [find(f) for f in fps] == [fps[i] for i in want]


def test_components_with_heavy_nodes(spark, monkeypatch):
    rng = random.Random(6)
    pairs = [(0, i) for i in range(1, 40)] + [(100 + i, 101 + i) for i in range(30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(35)]
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    edges = spark.createDataFrame(pairs, "src long, dst long")
    for heavy in (components.HEAVY, 2, 0):
        monkeypatch.setattr(components, "HEAVY", heavy)
        got = [tuple(r) for r in components.connected_components(edges).collect()]
        assert sorted(got) == sorted((x, r) for x, r in root.items() if x != r)


def test_simhash_keeps_one_of_each_group(documents, rows):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    fps = [brute.simhash(t) for _, t in rows]
    groups = {}
    for (i, t), g in zip(rows, brute.components(fps)):
        groups.setdefault(g, []).append(i)
    want = sorted(key(min((i for i in ids if i is not None), default=None)) for ids in groups.values())
    assert sorted(key(r.doc_id) for r in kept.collect()) == want


def test_simhash_keeps_no_near_duplicate_of_a_repeated_id(spark):
    text = lambda tag: " ".join(f"{tag}{k}" for k in range(80))
    rows = [(3, text("a")), (5, text("a").upper()), (5, text("b")), (7, text("c"))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2], rows[3]]


def test_quality(documents, rows):
    got = quality.ledger(documents).collect()
    want = sorted(key((i, *brute.quality(t))) for i, t in rows)
    assert sorted(key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == want
    names = [n for n, _ in quality.RULES]
    for r in got:
        bits = [bool(r.failed >> i & 1) for i in range(len(names))]
        assert bits[0] == (r.n_words < 50) and bits[1] == (100 * r.n_repeat_words > 50 * r.n_words)
    kept = quality.keep_good(documents)
    assert kept.columns == documents.columns
    mask = quality.mask(quality.POLICIES[quality.CURRENT])
    assert sorted(key(r.doc_id) for r in kept.collect()) == sorted(key(r.doc_id) for r in got if not r.failed & mask)


def test_quality_ablation(documents):
    book = quality.ledger(documents)
    bits = [r.failed & quality.mask(quality.POLICIES["v2"]) for r in book.collect()]
    for r in quality.ablation(book, "v2").collect():
        b = quality.mask([r.rule])
        assert (r.n_failed, r.n_only_this, r.n_kept_without) == (
            sum(bool(x & b) for x in bits), sum(x == b for x in bits), sum(x & ~b == 0 for x in bits))


def test_quality_follows_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    lexicon = quality.learn(docs, labels)
    assert lexicon.stems == brute.stems([(r.doc_id, r.text, r.lang) for r in docs.collect()], {r.doc_id: r.toxic for r in labels.collect()})
    got = quality.ledger(docs, lexicon=lexicon).withColumn("kept", quality.passes()).join(labels, "doc_id").collect()
    good = [r for r in got if r.quality == 1 and r.toxic == 0 and r.n_words >= 50]
    junk = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) > 0.97 * len(good)
    assert sum(r.kept for r in junk) < 0.1 * len(junk)


def test_quality_judges_duplicate_lines_by_their_text(spark):
    words = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    framed, long = words("f", 4), words("r", 30)
    texts = {1: "\n".join([framed, words("a", 110), framed]),
             2: "\n".join([framed, words("a", 55), framed, framed + "x", words("b", 55), framed + "x"]),
             3: "\n".join([long, words("a", 80), long])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {1, 2}
    assert {r.doc_id for r in quality.keep_good(docs, "v3").collect()} == set()
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    alone = [quality.mask([r]) for r in ("duplicate_lines", "duplicate_text")]
    book = quality.ledger(docs.join(labels.filter("quality = 1"), "doc_id"))
    bits = F.col("failed").bitwiseAND(quality.mask(quality.POLICIES[quality.CURRENT]))
    assert book.filter(bits.isin(alone)).count() == 0


def test_quality_sample_is_that_of_the_smallest_hashes(spark, monkeypatch):
    def first(ids):
        rows = spark.createDataFrame([(i, lang, 1) for lang, own in ids.items() for i in own], "id long, lang string, toxic long").withColumn("hash", F.md5(F.col("id").cast("string")))
        found = {lang: [] for lang in ids}
        for r in quality._smallest(rows).collect():
            found[r.lang].append(r.id)
        return {lang: sorted(own) for lang, own in found.items()}
    smallest = lambda ids, n: sorted(sorted(ids, key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))[:n])
    ids = {"none": [], "few": range(50), "many": range(9000), "one": [7] * 6000 + list(range(100))}
    assert first(ids) == {lang: smallest(own, quality.SAMPLE[1]) for lang, own in ids.items()}
    monkeypatch.setattr(quality, "SAMPLE_ALL", {0: 900, 1: 300})  # three languages have rows
    assert first(ids) == {lang: smallest(own, 100) for lang, own in ids.items()}


def test_quality_sample_is_of_labels_that_meet_a_text(spark, monkeypatch):
    """Labels of unknown documents, of documents without text, and repeated ones do not use up the sample's places."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    want = quality.learn(docs, labels).stems
    foreign = spark.range(1_000_000, 1_060_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    empty = spark.createDataFrame([(i, None, "en") for i in range(-50, 0)], "doc_id long, text string, lang string")
    more = labels.unionByName(foreign).unionByName(empty.select("doc_id", F.lit(1).alias("toxic"))).unionByName(labels.where("toxic = 1"))
    monkeypatch.setattr(quality, "SAMPLE", {0: 8000, 1: labels.where("toxic = 1").count()})
    assert len(want) > 20 and quality.learn(docs.select("doc_id", "text", "lang").unionByName(empty), more).stems == want


def test_quality_learns_stems_of_any_language(spark):
    insults = ["Schufté", "schuftig,", "(SCHUFTEN)"]
    filler = lambda n: " ".join(f"w{n}x{k}" for k in range(60))
    rows = [(i, f"{filler(i)} {insults[i % 3]} {insults[(i + 1) % 3]} -- common", 1) for i in range(12)]
    rows += [(i, f"{filler(i)} common -- schule", 0) for i in range(12, 40)]
    rows += [(40, f"{filler(40)} schuft", 0), (41, None, 1), (42, "", 1), (42, "", 1), (None, f"{filler(43)} schufte schufte", 1), (44, "no label", None)]
    rows += [(200 + i, f"{filler(i + 200)} (Botarate!) botarates", 1) for i in range(8)] + [(210 + i, f"{filler(i + 210)} botas", 0) for i in range(30)]
    lang = lambda i: None if i is None or i < 200 else "es"
    docs = spark.createDataFrame([(i, t, "x", lang(i)) for i, t, _ in rows], "doc_id long, text string, stem string, lang string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(99, 1), (98, 2)], "doc_id long, toxic int")
    lexicon = quality.learn(docs, labels)
    assert {"schuf", "schuft", "botar", "botarate"} <= lexicon.stems and all(s.startswith(("schuf", "bota")) for s in lexicon.stems) and "bota" not in lexicon.stems
    assert lexicon.stems == brute.stems([(i, t, lang(i)) for i, t, _ in rows], {i: t for i, _, t in rows if i is not None and t is not None})
    kept = {r.doc_id for r in quality.keep_good(docs, lexicon=lexicon).collect()}
    assert kept == set(range(12, 41)) | set(range(210, 240))
    for none in (docs.limit(0), labels.limit(0)):
        assert not quality.learn(*((none, labels) if "text" in none.columns else (docs, none))).stems


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))


@pytest.mark.parametrize("cap, hot", [(suffix_dedup.CAP, suffix_dedup.HOT), (3, 256), (20_000, 2), (3, 2)])
def test_suffix_dedup(documents, rows, cap, hot):
    if hot == 2:  # unique ids keep their partitions: many blocks, marked and unmarked runs of one bucket
        documents, rows = documents.where("doc_id < 900").repartition(16), [r for r in rows if r[0] is not None and r[0] < 900]
    rows = ordered(rows)
    raws = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), raw, mask in zip(rows, raws, brute.removed(raws)):
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        left = bytes(b for b, m in zip(raw, mask) if not m)
        want.append(key((i, len(raw), sum(mask), spans, hashlib.sha256(left).hexdigest())))
    got = suffix_dedup.removed(documents, cap=cap, hot=hot).collect()
    assert sorted(key((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == sorted(want)


def test_suffix_array_settles_long_ties():
    rng = random.Random(2)
    base = bytes(rng.choices(b"ab ", k=2000))
    text = base + base[500:1500] + b"a" * 700 + base[3:900]
    at = np.arange(len(text) - 100)
    pos, same = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8), at, np.zeros(len(at), np.int64))
    heads = [text[p:p + 100] for p in pos]
    assert heads == sorted(heads)
    assert same.tolist() == [False] + [a == b for a, b in zip(heads, heads[1:])]


def test_suffix_stage_keeps_columns_and_characters(documents, rows):
    got = suffix_dedup.without_repeats(documents)
    assert got.columns == documents.columns
    rows = ordered(rows)
    raws = [(t or "").encode() for _, t in rows]
    want = []
    for (i, t), raw, mask in zip(rows, raws, brute.removed(raws)):
        if not any(mask):
            want.append(key((i, t)))
            continue
        left, at = [], 0
        for c in t:
            n = len(c.encode())
            if not all(mask[at:at + n]):
                left.append(c)
            at += n
        if brute.WORD.search("".join(left)):
            want.append(key((i, "".join(left))))
    assert sorted(key((r.doc_id, r.text)) for r in got.collect()) == sorted(want)


def test_decontamination(spark, documents, rows):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    extra = [(500, "three little words"), (501, None), (502, ""), (503, "one")]
    bench = bench.select("item_id", "text").unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    some = rows[:60] + rows[200:] + [(990, " ".join(items[0][1].split()[2:])), (991, items[1][1].upper() + " and Three, little words!")]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    want = {}
    for i, t in some:
        for item, text in items + extra:
            if text and (s := brute.best_window(t, text)) >= 0.8:
                want[key((i, item))] = round(s, 9)
    for block_bytes in (decontam.BLOCK_BYTES, 8 * decontam.ITEM_BYTES):
        got = decontam.contaminated(docs, bench, block_bytes=block_bytes).collect()
        assert {key((r.doc_id, r.item_id)): round(r.similarity, 9) for r in got} == want
    assert {key((990, items[0][0])), key((991, items[1][0])), key((991, 500))} <= set(want)
    kept = decontam.clean(documents, bench)
    assert kept.columns == documents.columns
    bad = {i for i, t in rows if any(x and brute.best_window(t, x) >= 0.8 for _, x in extra[:1] + extra[3:])}
    assert not {r.doc_id for r in kept.collect()} & (bad - {None})


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    same = decontam._SameSize([(i, rng.integers(0, 1 << 63, 40).astype(np.uint64)) for i in range(50)])
    prints = np.packbits(np.unpackbits(same.prints, axis=1) ^ (rng.random((50, 64)) < 0.3), axis=1)
    away = np.bitwise_count(prints[:, None] ^ same.prints[None]).sum(axis=2)
    assert (same.candidates(prints) == (away <= decontam.RADIUS)).all()


def test_decontamination_stretches_do_not_matter(monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((5, 9, 20))))) for i in range(30)]
    text = " ".join(" ".join([rng.choice(items)[1], *rng.choices(words, k=rng.randrange(60))]) for _ in range(40))
    index = decontam.Index(items)
    want = index.matches(text)
    assert len(want) > 15
    for stretch, cells in ((7, decontam.CELLS), (decontam.STRETCH, 40)):
        monkeypatch.setattr(decontam, "STRETCH", stretch)
        monkeypatch.setattr(decontam, "CELLS", cells)
        assert index.matches(text) == want


def test_sharding(documents, rows):
    got = sharding.assign(documents, 40).collect()
    assert sorted(key((r.doc_id, r["size"], r.text_crc32)) for r in got) == sorted(
        key((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for i, t in rows)
    slots, where = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40 and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(x) == 1 for x in where.values())


def test_sharding_spreads_the_rows_of_one_key(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7, raising=False)
    rows = [(1, f"text {i}") for i in range(300)] + [(1, "copy")] * 100 + [(None, "copy")] * 3
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 3
    one = sorted((r.slot, r.text_crc32) for r in got if r.doc_id == 1)
    assert len({s for s, _ in one}) == 400
    # a bucket is in the order of crc32: one bucket would have no descent
    assert sum(a[1] > b[1] for a, b in zip(one, one[1:])) > 40


def test_jump_hash():
    rng = random.Random(4)
    keys = [rng.getrandbits(64) for _ in range(3000)]
    for n in (1, 2, 40, 41):
        assert sharding.jump_hash(np.array(keys, np.uint64), n).tolist() == [brute.jump(k, n) for k in keys]
    share = np.bincount(sharding.jump_hash(np.array(keys, np.uint64), 10), minlength=10)
    assert share.min() > 220 and share.max() < 380


def test_write_shards(spark, documents, scratch):
    docs = documents.drop("shard")
    sharding.write_shards(docs, f"{scratch}/shards", 5)
    assert spark.read.parquet(f"{scratch}/shards").count() == docs.count()


@functools.cache
def tokenizer(model_path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(model_path)


def library(model_path, text):
    t = tokenizer(model_path)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="session")
def encoded(model_path, rows):
    return [(i, *library(model_path, t)) for i, t in rows]


@pytest.mark.parametrize("block_bytes", [bpe.BLOCK_BYTES, 5000])
def test_bpe(documents, encoded, model_path, block_bytes):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = bpe.encode_digests(documents, model_path, block_bytes).collect()
    assert sorted(key(tuple(r)) for r in got) == sorted(key((i, len(ids), sha(" ".join(map(str, ids))), sha(text))) for i, ids, text in encoded)


def test_bpe_documents(documents, encoded, model_path):
    got = bpe.encode_documents(documents, model_path).collect()
    assert sorted(key((r.doc_id, list(r.ids), r.decoded)) for r in got) == sorted(key(x) for x in encoded)


def test_token_files(documents, encoded, rows, model_path):
    got = token_store.round_trip(documents, model_path).collect()
    def order(x):
        h = 42 if x[0][1] is None else xxhash.xxh64_intdigest(x[0][1].encode(), 42)
        return x[0][0] is not None, x[0][0] or 0, h - (h >> 63 << 64)
    texts = sorted(zip(rows, encoded), key=order)
    want, at = [], 0
    for (i, _), (_, ids, _) in texts:
        data = np.array(ids + [1], "<u4").tobytes()
        want.append(key((i, at, len(ids) + 1, zlib.crc32(data))))
        at += len(ids) + 1
    assert sorted(key(tuple(r)) for r in got) == sorted(want)


class Counting(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


def test_token_file_reads_only_what_is_asked_and_checks_it():
    rng = np.random.default_rng(2)
    docs = [(i, rng.integers(0, 49000, n).astype("<u4").tobytes()) for i, n in ((3, 5), (4, 100_000), (9, 0), (11, 70_000), (12, 9))]
    out = io.BytesIO()
    w = token_store.Writer(out)
    for d in docs:
        w.add(*d)
    w.close()
    raw = out.getvalue()
    reader = token_store.Reader(Counting(raw), len(raw))
    assert [reader.ids(i) for i in range(5)] == [d for _, d in docs] and reader.find(11) == [3] and reader.find(5) == []
    one = Counting(raw)
    reader = token_store.Reader(one, len(raw))
    reader.ids(0)
    assert one.got < len(raw) / 3
    bad = bytearray(raw)
    bad[100] ^= 1
    with pytest.raises(Exception):  # noqa: B017
        token_store.Reader(io.BytesIO(bytes(bad)), len(bad)).ids(1)
    bad = bytearray(raw)
    bad[-60] ^= 1
    with pytest.raises(ValueError):
        token_store.Reader(io.BytesIO(bytes(bad)), len(bad))


def test_kneser_ney(spark, documents, rows):
    want, p, vocabulary = brute.kneser_ney(rows)
    got = lm.train_and_score(documents).collect()
    same = lambda a: key(tuple(round(x, 6) if isinstance(x, float) else x for x in a))
    assert sorted(same(tuple(r)) for r in got) == sorted(same((i, *w)) for (i, _), w in zip(rows, want))
    for context in ("the", "\t", "never-seen"):
        assert abs(sum(p(context, w) for w in vocabulary) + p(context, "no such word") - 1) < 1e-9


@pytest.mark.parametrize("order", (2, 3, 4))
def test_kneser_ney_of_any_order(spark, documents, rows, order, monkeypatch):
    monkeypatch.setattr(lm, "MAPPED", 5)
    want, p, vocabulary = brute.kneser_ney_of_order(rows, order)
    got = lm.train_and_score(documents, order=order).collect()
    assert sorted(key((r.doc_id, round(r.score, 6))) for r in got) == sorted(key((i, round(s, 6))) for (i, _), s in zip(rows, want))
    for context in (("\t",) * (order - 1), ("never-seen",) * (order - 1), ("of", "the", "of")[:order - 1], ("\t", "never-seen", "the")[4 - order:]):
        assert abs(sum(p(context, w) for w in vocabulary) + p(context, "no such word") - 1) < 1e-9


def test_kneser_ney_merges_blobs_as_they_pass(spark, monkeypatch):
    """Many small blocks, merged a few rows at a time, give the counts of one block."""
    rows = [(i, " ".join(f"w{i * k % 7} the" for k in range(i % 40))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((r.doc_id, round(r.score, 6)) for r in lm.train_and_score(docs, order=3).collect())
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(lm, "BLOCK_A_PART", 1)
    monkeypatch.setattr(lm, "MERGE_ROWS", 20)
    assert sorted((r.doc_id, round(r.score, 6)) for r in lm.train_and_score(docs, order=3).collect()) == want
    assert want == sorted((i, round(s, 6)) for (i, _), s in zip(rows, brute.kneser_ney_of_order(rows, 3)[0]))


def test_kneser_ney_beats_the_base(spark):
    got = lm.train_and_score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.train_and_predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) > 0.97 * len(got)


def test_language_id_sample_is_bounded(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    languages = docs.select("lang").distinct().count()
    for each, all_, size in ((10, 160_000, 10), (800, 5 * languages, 5), (800, 1, 1)):
        monkeypatch.setattr(langid, "SAMPLE", each)
        monkeypatch.setattr(langid, "SAMPLE_ALL", all_)
        got = langid._sample(docs).collect()
        assert len({r.lang for r in got}) == languages and size * languages <= len(got) <= size * languages * langid.PER_DOC


def test_language_id_learns_languages_of_few_ids(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 10)
    last = spark.range(100).orderBy(F.xxhash64("id").desc()).first().id
    rows = [(last, "aa", f"text number {i}") for i in range(300)] + [(i, "bb", f"other {i}") for i in range(1000, 1300)]
    rows += [(None, "cc", f"no id {i}") for i in range(300)]
    got = [r.lang for r in langid._sample(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()]
    assert sorted(got) == ["aa"] * 10 + ["bb"] * 10 + ["cc"] * 10


def test_language_id_knows_letters(spark):
    """Only Unicode's general category L counts: other numbers, marks and symbols that look like words do not."""
    none = ["½ ² ③ 12", "²", "ⅷ Ⅻ", "۳ ३ 7", "_ - 😀 €", "\u0301\u20dd", "\u00a0\u3000", ""]
    some = ["½ a", "ª", "ʰ", "日", "ǅ", "א", "ß"]
    texts = [(i, t, "x" if i % 2 else "y") for i, t in enumerate(none + some)] + [(50 + i, f"word number {i}", "xy"[i % 2]) for i in range(20)]
    got = {r.doc_id: r for r in langid.train_and_predict(spark.createDataFrame(texts, "doc_id long, text string, lang string")).collect()}
    assert [got[i].lang_pred == "und" for i in range(len(none + some))] == [True] * len(none) + [False] * len(some)
    assert all(got[i].score == 0 for i in range(len(none)))


def test_language_id_network_against_plain_loops():
    rng = np.random.default_rng(3)
    windows = rng.integers(0, 256, (90, langid.WINDOW)).astype(np.uint8)
    windows[:45, ::3] = 7
    labels = (np.arange(90) >= 45).astype(np.int64)
    net = langid.fit(windows, labels, ["a", "b"])
    got = net.probabilities(windows)
    for x, p in zip(windows[::11], got[::11]):
        act = [max(float(sum(t[j][x[i + j], f] for j in range(len(t)))) for i in range(langid.WINDOW - len(t) + 1)) for t in net.tables for f in range(langid.FILTERS)]
        hidden = [max(a + float(b), 0) for a, b in zip(act, net.bias)]
        z = [sum(h * float(net.dense[i, c]) for i, h in enumerate(hidden)) + float(net.offset[c]) for c in range(2)]
        want = np.exp(np.array(z) - max(z))
        assert np.allclose(p, want / want.sum(), atol=1e-4)
    assert (got.argmax(axis=1) == labels).mean() > 0.95


def test_language_id_odd_rows(documents, rows):
    got = langid.train_and_predict(documents).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    und = [i for i, t in ODD if t is None or not any(c.isalpha() for c in t)]
    assert sorted(key(r.doc_id) for r in got if r.lang_pred == "und") == sorted(map(key, und))
    assert {r.lang_pred for r in langid.train_and_predict(documents.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_chat_query(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    for c, t, role, text in Q.TRICKY:
        turns.setdefault(c, []).append((t, role, text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for c, t in turns.items():
        t.sort()
        loss = "".join(x for _, r, x in t if r == "assistant")
        chars = sum(len(f"<turn {r}>") + len(x) + x.count("<") + len("</turn>\n") for _, r, x in t)
        want.append(key((c, len(t), sha("".join(f"{r}\n{x}\n" for _, r, x in t)), len(loss), sha(loss), chars)))
    assert sorted(key(tuple(r)) for r in Q.op10_chat(spark, SF).collect()) == sorted(want)


def test_chat_parts_and_escapes(spark):
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    texts = ["<", "/turn>\n<turn user>", "\\", "<\\", "<\\</turn>\n", "", "a<b>c", "<part image 0>"]
    turns = [(1, 0, "user", [part("text", "look: "), part("image", None, "img://1", 4), part("text", "<"), part("text", "/turn>\n"), part("audio", ref="a", units=10)]),
             (1, 1, "assistant", [part("text", "fine")]), (1, 2, "a>b\\<g", [part("document", ref="d"), part("odd", "kept")]), (1, 3, "assistant", None),
             (1, 4, None, [part("text", None)])]
    turns += [(2, i, "assistant", [part("text", t)]) for i, t in enumerate(texts)] + [(None, 0, "user", [part("text", "x")]), (None, 0, "user", [part("text", "x")])]
    frame = spark.createDataFrame(turns, f"conv_id long, turn int, role string, content array<{chat.PART}>")
    got = {r.conv_id: r for r in chat.format_chats(frame).withColumn("read", chat.read_chats(F.col("formatted")))
           .withColumn("masked", chat.masked_text(F.col("formatted"), F.col("loss_mask"))).collect()}
    one = got[1]
    assert [(r.role, r.text) for r in one.read] == [
        ("user", "look: <part image 0></turn>\n<part audio 1>"), ("assistant", "fine"), ("a>b\\<g", "<part document 2>kept"), ("assistant", ""), ("", "")]
    assert [(a.number, a.type, a.ref, a.tokens) for a in one.attachments] == [(0, "image", "img://1", 1026), (1, "audio", "a", 252), (2, "document", "d", 514)]
    assert one.masked == "fine" and one.n_turns == 5
    assert [r.text for r in got[2].read] == texts and got[2].masked == "".join(texts)
    assert got[None].n_turns == 2
    for s in one.spans:
        assert one.formatted[s.start + s.length:].startswith("</turn>\n")
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_empty_tables(spark, empty, model_path):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    for frame in (simhash.near_duplicates(empty), simhash.keep_one(empty), quality.ledger(empty), quality.ablation(quality.ledger(empty)),
                  quality.keep_good(empty), suffix_dedup.removed(empty), suffix_dedup.without_repeats(empty), decontam.contaminated(empty, bench),
                  decontam.contaminated(docs, bench), decontam.clean(empty, bench), sharding.assign(empty), bpe.encode_digests(empty, model_path),
                  lm.train_and_score(empty), langid.train_and_predict(empty), token_store.round_trip(empty, model_path)):
        assert frame.count() == 0
    assert decontam.clean(docs, bench).count() == 1
