"""Texts far beyond the sizes at which the operators cut their work, and columns named like the operators' own."""

import hashlib
import random
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from picsel.llm import bpe, chat, decontam, langid, lm, quality, sharding, simhash, suffix_dedup, token_store
from tests.llm import brute
from tests.llm.test_operators import library

#: Names that the operators use inside, and of their results.
NAMES = ("fp row place part pos name block hash n size total first count key bits mask shard bucket held_out score n_tokens n_words failed kept "
         "text_sha256 start end rank id words ids item_id similarity degree root src dst x y _h _text _id").split()


@pytest.fixture(scope="module")
def long_rows():
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("the", "bridge", "garten", "señor", "été", "Kraft", "x") for b in ("", "s", "ing", "-2", "日")] + ["\n", "idiot!"]
    text = " ".join(rng.choices(words, k=190_000))  # 1.3 MB
    return [(1, text), (2, text[300_000:900_000] + " tail of its own"), (3, "short text of seven words in all"), (4, text), (5, "y" * 700_000)]


@pytest.fixture(scope="module")
def long_docs(spark, long_rows):
    rows = spark.createDataFrame(long_rows, "doc_id long, text string").repartition(2)
    return rows.selectExpr("*", "'en' as lang", *[f"'{n}' as `{n}`" for n in NAMES])


def test_simhash(long_docs, long_rows):
    got = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.near_duplicates(long_docs).collect()}
    assert got == {i: brute.simhash(t) for i, t in long_rows}
    kept = simhash.keep_one(long_docs)
    assert kept.columns == long_docs.columns and 4 not in {r.doc_id for r in kept.select("doc_id").collect()}


def test_quality(long_docs, long_rows):
    book = quality.ledger(long_docs).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in book} == {i: brute.quality(t) for i, t in long_rows}
    assert quality.keep_good(long_docs).columns == long_docs.columns


def test_suffix_dedup(long_docs, long_rows):
    gone = brute.removed([t.encode() for _, t in long_rows])
    want = {i: (len(t.encode()), sum(m), hashlib.sha256(bytes(b for b, x in zip(t.encode(), m) if not x)).hexdigest()) for (i, t), m in zip(long_rows, gone)}
    got = suffix_dedup.removed(long_docs, width=100).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in got} == want
    assert suffix_dedup.without_repeats(long_docs, width=100).columns == long_docs.columns


def test_decontamination(spark, long_docs, long_rows):
    words = brute.WORD.findall(long_rows[0][1])
    item = " ".join(words[150_000:150_030])
    bench = spark.createDataFrame([(7, item), (8, "nothing of this is in any of the long texts at hand")], "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as fp")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(long_docs, bench).collect()}
    assert {(1, 7), (4, 7)} <= got and {d for d, _ in got} <= {1, 2, 4} and {i for _, i in got} == {7}
    kept = decontam.clean(long_docs, bench)
    assert kept.columns == long_docs.columns and {3, 5} <= {r.doc_id for r in kept.select("doc_id").collect()}


def test_sharding_end_to_end(long_docs, long_rows, spark):
    """The shard is the jump hash of the key's XXH64, for any key."""
    more = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.assign(long_docs.select("doc_id", "text", "shard", "size").unionByName(more, allowMissingColumns=True), 40).collect()
    for r in got:
        h = xxhash.xxh64_intdigest(int(r.doc_id).to_bytes(8, "little"), 42)
        assert (r.shard, r.grown_shard) == (brute.jump(h, 40), brute.jump(h, 41))
    assert {(r["size"], r.text_crc32) for r in got} >= {(len(t.encode()) + 16, zlib.crc32(t.encode())) for _, t in long_rows}


def test_bpe_and_token_files(long_docs, long_rows, model_path):
    made = {i: library(model_path, t) for i, t in long_rows}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for block in (bpe.BLOCK_BYTES, 100_000):
        got = bpe.encode_digests(long_docs, model_path, block).collect()
        assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == {
            i: (len(ids), sha(" ".join(map(str, ids))), sha(text)) for i, (ids, text) in made.items()}
    start = 0
    back = {r.doc_id: r for r in token_store.round_trip(long_docs, model_path).collect()}
    for i, (ids, _) in sorted(made.items()):
        data = b"".join(x.to_bytes(4, "little") for x in [*ids, 1])
        assert (back[i].start, back[i].n_tokens, back[i].ids_crc32) == (start, len(ids) + 1, zlib.crc32(data))
        start += len(ids) + 1


def test_bpe_buckets_follow_distinct_words(spark, model_path):
    assert token_store.files_for(0, 50) == 1 and token_store.files_for(3 << 20, 50) == 1 and token_store.files_for(1 << 30, 50) == 50
    assert token_store.files_for(1 << 40, 50) == (1 << 40) // token_store.FILE_BYTES
    rows = [(i, [bpe._hash(b"w%d" % k) for k in range(n)]) for i, n in enumerate((300, 400, 20))]
    least = lambda rows: spark.createDataFrame([(i, sorted(h)[:bpe.SKETCH]) for i, h in rows], "block long, least array<long>")
    assert bpe.distinct_words(least(rows)) == 400 and bpe.distinct_words(least([])) == 0
    many = [(b, [bpe._hash(b"w%d" % k) for k in range(b * 20_000, b * 20_000 + 40_000)]) for b in range(4)]  # 100,000 distinct words
    assert 85_000 < bpe.distinct_words(least(many)) < 115_000


def test_language_and_model(long_docs, long_rows):
    got = {r.doc_id: r for r in langid.train_and_predict(long_docs.withColumn("lang", F.when(F.col("doc_id") == 5, "yy").otherwise("en"))).collect()}
    assert len(got) == 5 and all(r.lang_pred in ("en", "yy", "und") for r in got.values())
    scored = {r.doc_id: r for r in lm.train_and_score(long_docs).collect()}
    assert {i: r.n_tokens for i, r in scored.items()} == {i: len(brute.WORD.findall(t)) + 1 for i, t in long_rows}
    assert scored[1].score == pytest.approx(scored[4].score) and all(r.score < 0 for r in scored.values())


def test_chat(spark, long_rows):
    turns = [(i, n, role, t) for i, t in long_rows for n, role in enumerate(("user", "assistant"))]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    frame = frame.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("content"),
                         *[F.lit(n).alias(n) for n in ("place", "first", "head", "text", "whole", "start", "media", "t", "formatted", "spans", "n_turns")])
    chats = chat.format_chats(frame)
    got = chats.withColumn("read", chat.read_chats(F.col("formatted"))).withColumn("masked", chat.masked_text(F.col("formatted"), F.col("loss_mask"))).collect()
    texts = dict(long_rows)
    assert sorted(r.conv_id for r in got) == sorted(texts)
    for r in got:
        assert [(x.role, x.text) for x in r.read] == [("user", texts[r.conv_id]), ("assistant", texts[r.conv_id])] and r.masked == texts[r.conv_id]
