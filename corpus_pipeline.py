"""The corpus pipeline: documents through quality rules, near and exact dedup, decontamination and BPE encoding.

Each stage gets the rows that its predecessor kept, is written as Parquet in the shared folder, and is read again by the next
one. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from picsel.llm import bpe, decontam, quality, simhash, suffix_dedup
from picsel.llm.common import stage, table
from picsel.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger accepts; abusive stems are learned from the labelled ones."""
    return quality.keep_good(docs, lexicon=quality.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of linked SimHash fingerprints."""
    return simhash.keep_one(docs, width=3, radius=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that 100-byte strings of earlier documents, or of earlier places, cover."""
    return suffix_dedup.without_repeats(docs, width=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document that is left, as counts and digests."""
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_duplicates), ("suffix-array dedup", repeated_passages),
          ("benchmark decontamination", decontamination), ("BPE encoding and decoding", encoding)]

#: SQL has neither XXH64 fingerprints nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
