import hashlib
import json

import corpus_pipeline
from picsel.llm import quality
from tests.llm import brute
from tests.llm.test_operators import library


def test_pipeline_against_brute_force(spark, model_path):
    sf = "/root/testdata/sf0.001"
    every = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    docs = [(r.doc_id, r.text) for r in every]
    mask = quality.mask(quality.POLICIES[quality.CURRENT])

    stems = quality.Lexicon(brute.stems([(r.doc_id, r.text, r.lang) for r in every], {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}))

    def good(text):
        m = dict(zip(quality.MEASURES, quality.measure(text, stems)))
        failed = sum(1 << i for i, c in enumerate(quality.conditions()) if eval(c, {}, m))
        return not failed & mask
    docs = [d for d in docs if good(d[1])]
    roots = brute.components([brute.simhash(t) for _, t in docs])
    docs = [d for i, (d, r) in enumerate(zip(docs, roots)) if i == r]
    cut = []
    for (i, t), gone in zip(docs, brute.removed([t.encode() for _, t in docs])):
        left, at = [], 0
        for c in t:
            n = len(c.encode())
            left += [] if all(gone[at:at + n]) else [c]
            at += n
        if not any(gone) or brute.WORD.search("".join(left)):
            cut.append((i, "".join(left)))
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in cut if not any(brute.best_window(t, x) >= 0.8 for x in items)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in docs:
        ids, text = library(model_path, t)
        want.append(json.dumps((i, len(ids), sha(" ".join(map(str, ids))), sha(text))))
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted(json.dumps(tuple(r)) for r in got) == sorted(want)


def test_stages_keep_the_columns(spark, documents):
    docs = documents
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.toArrow())
    assert docs.count() > 50


def test_stages_take_an_empty_table(spark, empty):
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, "/root/testdata/sf0.001").count() == 0
