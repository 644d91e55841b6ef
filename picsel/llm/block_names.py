"""Exact dedup by deterministic block naming (Karp, Miller and Rosenberg, 1972), in DataFrame functions only.

Each text is cut into blocks of ``BLOCK`` bytes. Blocks are named by integers: the blocks of one hash bucket are sorted by
their bytes and a block's name is its bucket and its rank there, so equal blocks, and no others, share a name. Then adjacent
names of a text are paired and the pairs named in the same way, until a text has one name: after ``depth`` rounds two texts
have the same name if and only if all their blocks are the same. Nothing is decided by a hash; hashes only deal out the work.

Rows are named where they lie in the sort: one shuffle of the blocks, no join back. A block or pair with more than
one in ``MOST`` of all rows is named beforehand (at most ``MOST`` of them, broadcast) and its rows are spread over all buckets
without their bytes, so no task gathers one. Each round is written to the shared folder; there are log2 of the longest text's
blocks.

Odd rows: a null text counts as empty; an empty text is one empty block; rows that share a doc_id, or have none, are told apart
by a row number; of rows equal in text and doc_id one is kept; a null doc_id counts as the smallest, so such a row is kept
only if its group has no other; an empty table gives an empty result. A very long text is many rows after its first cut. Other
columns are not read, so their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from picsel.llm.common import stage
from picsel.llm.components import with_key_values

#: Bytes of a block.
BLOCK = 1024
#: A block or pair is named beforehand from this many rows on, and if it has more than one in ``MOST`` of all rows.
HEAVY, MOST = 256, 10_000
#: Rows of a bucket, about.
BUCKET_ROWS = 512


def _cut(text: Column, size: int) -> Column:
    """The blocks of a text, as an array of binary; the lambda binds the bytes once, not once a block."""
    starts = F.sequence(F.lit(0), F.greatest(F.octet_length(text) - 1, F.lit(0)), F.lit(size))
    return F.get(F.transform(F.array(text.cast("binary")), lambda b: F.transform(starts, lambda at: F.substr(b, at + 1, F.lit(size)))), F.lit(0))


def named(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with ``keys`` replaced by ``name``, an integer that rows share if and only if their keys are equal.

    ``total`` is the number of rows, about. Keys must not be null.
    """
    spark, others = rows.sparkSession, [c for c in rows.columns if c not in keys]
    rows = rows.withColumn("_h", F.xxhash64(*keys))
    often = rows.groupBy("_h").agg(F.count("*").alias("_n")).where(F.col("_n") > max(HEAVY, total // MOST)).select("_h")
    often = stage(often, "heavy-hashes")
    if often.isEmpty():
        heavy = spark.createDataFrame([], rows.select("_h", *keys).schema)
    else:
        heavy = rows.join(F.broadcast(often), "_h", "left_semi").select("_h", *keys).distinct()
    # at most MOST rows, but for blocks that differ and share a 64-bit hash
    heavy = heavy.withColumn("_heavy", F.row_number().over(Window.orderBy(*keys)).cast("long"))
    rows = rows.join(F.broadcast(heavy), ["_h", *keys], "left")
    buckets, rare = 64 + total // BUCKET_ROWS, F.col("_heavy").isNull()
    rows = rows.withColumns({
        "_bucket": F.when(rare, F.pmod("_h", F.lit(buckets))).otherwise(F.lit(-1) - F.pmod(F.xxhash64(*others), F.lit(buckets))),
        **{k: F.when(rare, F.col(k)) for k in keys}})
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy(*keys)).cast("long")
    name = F.when(rare, (F.col("_bucket") + 1) * F.lit(1 << 32) + rank).otherwise(F.col("_heavy"))
    return rows.select(*others, name.alias("name"))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``row, doc_id, text_sha256, identity`` of every row; texts are equal if and only if their ``identity`` is."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.ceil((F.octet_length(text) + 1) / F.lit(block)))).first()[0] or 0
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("sha"), _cut(text, block).alias("blocks"))
    rows = rows.select("row", "doc_id", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("place", "block"))
    first = F.col("place") == 0  # the first row of a text carries its columns
    rows = rows.select("row", "place", "n", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("sha")).alias("sha"), "block")
    level, depth, found = stage(named(rows, ["block"], int(total)), "named-blocks"), 0, []
    while True:
        identity = F.struct(F.lit(depth).alias("depth"), F.col("name"))
        found.append(level.where("n = 1").select("row", "doc_id", F.col("sha").alias("text_sha256"), identity.alias("identity")))
        left = level.where("n > 1")
        total = left.count()
        if not total:
            break
        side = lambda odd: F.max(F.when(F.col("place") % 2 == odd, F.col("name")))
        pairs = left.groupBy("row", F.floor(F.col("place") / 2).cast("int").alias("place")).agg(
            F.max(F.ceil(F.col("n") / 2)).cast("int").alias("n"), F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"),
            side(0).alias("left"), F.coalesce(side(1), F.lit(0)).alias("right"))  # names start at 1: 0 is no partner
        level, depth = stage(named(pairs, ["left", "right"], total // 2), "named-pairs"), depth + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row; of equal texts the row with the largest doc_id is kept."""
    rows = identities(docs, id_col, text_col, block)
    groups = rows.groupBy("identity").agg(F.count("*").alias("degree"), F.max(F.struct("doc_id", "row")).alias("last"))
    groups = stage(groups, "identities")
    total = groups.agg(F.sum("degree")).first()[0] or 0
    found = with_key_values(rows, groups.withColumn("group_size", F.col("degree")), "identity", total)
    return found.select("doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``docs`` without the rows that are not kept; of rows equal in doc_id and text one stays, whatever their other columns."""
    kept = exact_duplicates(docs, id_col, text_col, block).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    sha = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    same = docs.withColumn("_text_sha", sha).withColumn("_doc_id", F.col(id_col))
    found = same.join(kept, F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_sha") == F.col("_sha")), "left_semi")
    return found.dropDuplicates(["_doc_id", "_text_sha"]).select(*docs.columns)
