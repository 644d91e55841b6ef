"""Order across partitions: rows in a global order, and the ranks of a linked list, without gathering either in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from picsel.llm.common import stage

#: Links that one task contracts at a time, and that are left to the last step.
LINKS, LAST = 100_000, 50_000
#: Rows whose running sums one task makes.
SUMS = 10_000
_PLACE = (1 << 33) - 1
_BEFORE = (Window.unboundedPreceding, -1)


def in_order(df: DataFrame, by: list[Column | str], keep: list[Column | str], name: str) -> DataFrame:
    """The columns ``keep`` of ``df``, written in the order ``by`` with ``part`` (ascending) and ``pos`` (from 0 in a part).

    Rows are dealt out by ranges of ``by`` and of a row number, so neither a frequent key nor repeated rows fill one part.
    """
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*by, "_row").sortWithinPartitions(*by, "_row")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))
    return stage(rows.select(*keep, F.spark_partition_id().alias("part"), place.alias("pos")), name)


def row_numbers(ordered: DataFrame) -> DataFrame:
    """``in_order`` rows with ``id``: 0, 1, ... over all parts. The offsets have one row a part."""
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n"))
    offsets = offsets.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)).alias("offset"))
    return ordered.join(F.broadcast(offsets), "part").withColumn("id", F.col("offset") + F.col("pos")).drop("offset")


_LOCAL = "arc long, place long, head long, away long, succ long, weight long"
_LOCAL_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _LOCAL.split(", ")])


def _contract(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each link of a partition with the first link of its chain there and the way from it; the first has the chain's end."""
    batches = [b for b in it if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    arc, place, succ, weight = (rows.column(c).to_numpy() for c in ("arc", "place", "succ", "weight"))
    order = np.argsort(arc)
    arc, place, succ, weight = arc[order], place[order], succ[order], weight[order]
    at = np.searchsorted(arc, succ)
    here = arc[np.minimum(at, len(arc) - 1)] == succ
    follows = np.zeros(len(arc), bool)
    follows[at[here]] = True
    head, away = np.empty(len(arc), np.int64), np.zeros(len(arc), np.int64)
    end, total = np.full(len(arc), -1, np.int64), np.zeros(len(arc), np.int64)
    nexts, steps = np.where(here, at, -1).tolist(), weight.tolist()
    for first in np.flatnonzero(~follows).tolist():
        i, way = first, 0
        while True:
            head[i], away[i] = first, way
            way += steps[i]
            if nexts[i] < 0:
                break
            i = nexts[i]
        end[first], total[first] = succ[i], way
    for a in range(0, len(arc), 10_000):
        s = slice(a, a + 10_000)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (arc[s], place[s], arc[head[s]], away[s], end[s], total[s])], schema=_LOCAL_ARROW)


def _local(links: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Links contracted within each partition: those left, and ``arc, head, away`` of the others."""
    done = stage(links.select("arc", "place", "succ", "weight").mapInArrow(_contract, _LOCAL), name)
    return done.where("arc = head").select("arc", "place", "succ", "weight"), done.where("arc <> head").select("arc", "head", "away")


def _mate(links: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Random mates: a link that drew 1 and follows one that drew 0 is taken out (a quarter of them, as expected)."""
    drawn = links.withColumn("coin", F.xxhash64(F.lit(turn), F.col("arc")).bitwiseAND(F.lit(1)))
    u, v = drawn.where("coin = 0").alias("u"), drawn.where("coin = 1").alias("v")
    both = u.join(v, F.col("u.succ") == F.col("v.arc"), "full_outer")
    one = F.col("u.arc").isNotNull()
    merged = one & F.col("v.arc").isNotNull()
    rows = both.select(
        F.coalesce("u.arc", "v.arc").alias("arc"), F.coalesce("u.place", "v.place").alias("place"),
        F.when(one & ~merged, F.col("u.succ")).otherwise(F.col("v.succ")).alias("succ"),
        (F.coalesce("u.weight", F.lit(0)) + F.coalesce("v.weight", F.lit(0))).alias("weight"),
        F.when(merged, F.col("v.arc")).alias("gone"), F.col("u.weight").alias("away"))
    rows = stage(rows, f"mates-{turn}")
    return rows.select("arc", "place", "succ", "weight"), rows.where("gone is not null").select(F.col("gone").alias("arc"), F.col("arc").alias("head"), "away")


def list_ranks(links: DataFrame) -> DataFrame:
    """``arc, rank`` (from 0) of one linked list of ``arc, succ, place``; the last link's ``succ`` is -1.

    ``place`` says which links are likely to follow each other: first each range of it is contracted by itself. While more than
    ``LAST`` links are left, random mates take out a quarter of them a round, so the rounds grow with the logarithm and all work
    in proportion to the list. The last few links are ranked in one task; then the rounds are undone in reverse, a join each.
    """
    links = stage(links.withColumn("weight", F.lit(1).cast("long")), "links")
    n, undo, turn = links.count(), [], 0
    while n > LAST:
        if turn == 0:
            links, gone = _local(links.repartitionByRange(1 + n // LINKS, "place", "arc"), "contracted")
        else:
            links, gone = _mate(links, turn)
        undo.append(gone)
        n, turn = links.count(), turn + 1
    left, inner = _local(links.repartition(1), "last-links")
    ranks = inner.select("arc", F.col("away").alias("rank")).unionByName(left.select("arc", F.lit(0).cast("long").alias("rank")))
    for gone in reversed(undo):
        found = gone.join(ranks.withColumnRenamed("arc", "head"), "head").select("arc", (F.col("rank") + F.col("away")).alias("rank"))
        ranks = stage(ranks.unionByName(found), "ranks")
    return ranks


def running_sums(rows: DataFrame, place: str, columns: list[str]) -> DataFrame:
    """``rows`` with each of ``columns`` (bigint) replaced by its sum up to and with the row, in the order of the gapless ``place``."""
    rows = rows.withColumn("_bucket", F.floor(F.col(place) / F.lit(SUMS)))
    inside = Window.partitionBy("_bucket").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = stage(rows.withColumns({c: F.sum(c).over(inside) for c in columns}), "bucket-sums")
    before = Window.orderBy("_bucket").rowsBetween(*_BEFORE)  # a row for SUMS rows
    totals = rows.groupBy("_bucket").agg(*[F.max_by(c, place).alias(f"_{c}") for c in columns])
    totals = totals.select("_bucket", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in columns])
    return rows.join(totals, "_bucket").withColumns({c: F.col(c) + F.col(f"_{c}") for c in columns}).drop("_bucket", *[f"_{c}" for c in columns])
