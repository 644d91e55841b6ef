"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from picsel.llm.common import stage


#: A key with more rows than this, and than one in ``MOST`` of all rows, is heavy; there are at most ``MOST`` such keys.
HEAVY, MOST = 256, 100_000


def with_key_values(rows: DataFrame, values: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined by ``key`` with ``values``: one row a key, whose column ``degree`` counts the key's rows.

    ``total`` is at least the sum of the degrees above ``HEAVY``. The values of heavy keys, ``MOST`` rows at the most, are
    broadcast, so that the rows of such a key stay where they are; all other rows meet their values by a shuffle.
    """
    heavy = F.col("degree") > F.lit(max(HEAVY, total // MOST))
    named = F.broadcast(values.filter(heavy).select(key))
    found = rows.join(F.broadcast(values.filter(heavy).drop("degree")), key)
    return found.unionByName(rows.join(named, key, "left_anti").join(values.filter(~heavy).drop("degree"), key))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"), F.count("*").alias("degree"))
    out = with_key_values(both.filter("dst > src"), stage(least, "least"), "src", 2 * n).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return out.filter("src <> dst").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = stage(down.groupBy("src").agg(F.min("dst").alias("low"), F.count("*").alias("degree")), "least")
    moved = with_key_values(down, least, "src", n).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(least.select("src", F.col("low").alias("dst"))).filter("src <> dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``src, dst`` links to ``node, root`` (the smallest node of its component); nodes that are roots are not listed.

    Each half step is written to the shared folder; the loop ends when the links no longer change.
    """
    edges = stage(edges.filter("src <> dst").distinct(), "edges")
    last = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst"))).first())
        if now[0] == 0 or now == last:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        last = now
        # a large star makes no more links than it gets
        edges = stage(_small_star(stage(_large_star(edges, now[0]), "large-star"), now[0]), "small-star")
