import os

import pytest

from picsel.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"

#: Texts that any operator must take: (doc_id, text).
ODD = [
    (900, None), (901, ""), (902, "  \n\t "), (903, "one"), (904, "one two"), (905, "ab " * 400), (906, "x" * 5000),
    (907, "<|endoftext|> don't STOP <|startoftext|>é ß 日本 😀 12"), (908, "a\x1cb ć I'll ’s"),
    (909, "the same line of words here and there\n" * 60), (910, "the same line of words here and there\n" * 60),
    (911, "Only One Row That Repeats Itself"), (911, "Only One Row That Repeats Itself"), (None, "no id at all"), (None, None),
    (912, "word " * 40 + "λόγος " * 40), (913, "\u0000nul \\ back <turn x> </turn>"),
]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest documents table and the odd rows, with columns whose names clash with those of the operators."""
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in ODD], DDL)
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd)
    return docs.selectExpr("*", "'x' as fp", "1 as n_words", "2 as key", "3 as ranges", "4 as block", "5 as shard", "6 as held_out", "7 as count")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def model_path():
    assert os.path.exists(tokenizer_path())
    return tokenizer_path()
