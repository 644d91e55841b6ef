"""Sharding by jump consistent hashing (Lamping and Veach, 2014): no ring table; appending a shard moves rows only into it.

The key's XXH64 and the number of shards decide alone (law ``key``). Slots are gapless within a shard: rows are numbered in
fixed hash buckets of the key and the text's crc32, and each bucket starts where the counts of the buckets before it end, so no
task numbers a whole shard, also where one key has most of the rows. Equal rows are numbered as one with a count, and written
out ``COPIES`` at a time, so that no task numbers or writes all copies of a row.

Odd rows: null keys share one hash, hence one shard; rows with equal keys share a shard and get slots of their own; a null
text has size 16 and the crc32 of no bytes; an empty table gives an empty result. A very long text is only measured, where it lies. Other columns are not read, so their names
do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from picsel.llm.common import stage

#: Buckets of a shard that are numbered apart (part of the slot order: not to be changed between runs).
BUCKETS = 64
#: Copies of a row that are written out together.
COPIES = 10_000
#: Bytes of a row besides its text.
ROW_BYTES = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    key = keys.astype(np.uint64).copy()
    out = np.zeros(len(key), np.int64)
    jump = np.zeros(len(key), np.int64)
    todo = np.arange(len(key))
    while len(todo):
        out[todo] = jump[todo]
        key[todo] = key[todo] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[todo] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[todo] = ((out[todo] + 1) * step).astype(np.int64)
        todo = todo[jump[todo] < shards]
    return out


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key column of any type."""
    @F.pandas_udf(T.IntegerType())
    def jump(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy().view(np.uint64), shards).astype(np.int32))
    return jump(F.xxhash64(key))


def assign(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row (``grown_shard``: with one more shard)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        shard_of(F.col(id_col), shards).alias("shard"), shard_of(F.col(id_col), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("slot"), F.col(id_col), F.crc32(text)), F.lit(BUCKETS)).cast("int").alias("bucket"))
    rows = stage(rows, "sharded")
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))  # shards * BUCKETS rows at most
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    same = rows.groupBy("doc_id", "size", "text_crc32", "shard", "grown_shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = same.withColumn("place", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(offsets), ["shard", "bucket"])
    parts = numbered.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    # a fixed number of partitions: few short rows here can be many below
    parts = parts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "bucket", "doc_id", "start")
    copies = parts.withColumn("copy", F.explode(F.sequence(F.col("start"), F.least(F.col("start") + COPIES, F.col("n")) - 1)))
    return copies.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         (F.col("offset") + F.col("place") + F.col("copy")).cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", files: int = 4) -> None:
    """``docs`` as Parquet folders ``shard=N``, each in about ``files`` files, so that no task writes a whole shard."""
    part = F.pmod(F.xxhash64(F.lit("file"), *[F.col(c) for c in docs.columns]), F.lit(files))
    out = docs.withColumn("shard", shard_of(F.col(id_col), shards))
    out.repartition(shards * files, "shard", part).write.partitionBy("shard").parquet(path)
