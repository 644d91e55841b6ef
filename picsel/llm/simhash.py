"""SimHash near-duplicates: 64-bit fingerprints, linked within a Hamming radius through BK-trees.

A fingerprint's bit is set if it is set in more than half of the XXH64 values (seed 42) of the text's word shingles.
Equal fingerprints are one node, so copies never meet each other again. For the links, two fingerprints within ``radius``
bits agree on at least one of ``radius + 1`` bit blocks (pigeonhole), so every fingerprint is sent to the shard of each of its
block values, and a shard's fingerprints form one BK-tree: children are keyed by their integer Hamming distance to the parent,
and a search follows only the edges within ``radius`` of its own distance to the node. A tree goes only to the task that holds
the queries of its shard; a broadcast of all trees to all executors would grow with the corpus. A shard of more than ``cap``
fingerprints is split by the blocks of the bits it does not agree on yet, as often as needed; no fingerprint is left out.
A shard returns a spanning forest of its links, which connects the same fingerprints as all of its links do.

Nulls and odd rows: a null or blank text has fingerprint 0 and links like any other. Rows with equal or null ``doc_id`` are
kept; a component's id is its smallest non-null ``doc_id``. An empty table gives an empty result. A very long text is
summed up a stretch of shingles at a time. :func:`near_duplicates` reads no other columns; :func:`keep_one` passes them on whatever
their names (but for names that begin with ``__picsel``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from picsel.llm.common import batches, stage, utf8
from picsel.llm.components import connected_components, with_key_values

BITS = 64
#: Most fingerprints of one BK-tree; larger shards are split further.
TREE_CAP = 4096


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text, A-Z lower-cased; 0 without words. Fewer words than ``width`` make one shingle."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(start[:len(words) - width + 1].tolist(), end[width - 1:].tolist())
    h = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(part, axis=1, bitorder="little"), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` is the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def rows(batch):
        fp = np.array([fingerprint(utf8(t), width) for t in batch.column(1).to_pylist()], np.uint64)
        yield [batch.column(0), pa.array(fp.view(np.int64))]

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        batches(schema, rows), "doc_id long, fp long")


class BKTree:
    """Fingerprints in a tree whose edges carry the Hamming distance of child and parent."""

    def __init__(self):
        self.nodes: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, fp: int) -> None:
        at = 0
        while self.nodes:
            d = (fp ^ self.nodes[at]).bit_count()
            if d == 0:
                return
            if d not in self.edges[at]:
                self.edges[at][d] = len(self.nodes)
                break
            at = self.edges[at][d]
        self.nodes.append(fp)
        self.edges.append({})

    def within(self, fp: int, radius: int) -> list[int]:
        """Indexes of the nodes at most ``radius`` bits away."""
        found, todo = [], [0] if self.nodes else []
        while todo:
            at = todo.pop()
            d = (fp ^ self.nodes[at]).bit_count()
            if d <= radius:
                found.append(at)
            edges = self.edges[at]
            if edges:
                todo.extend(edges[k] for k in range(d - radius, d + radius + 1) if k in edges)
        return found


def tree_links(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the distinct fingerprints of one shard."""
    tree, root, out = BKTree(), list(range(len(fps))), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, fp in enumerate(fps):
        for j in tree.within(fp, radius):
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                out.append((fp, fps[j]))
        tree.add(fp)
    return out


def _cuts(free: int, parts: int) -> list[int]:
    """The bits of ``free`` in ``parts`` masks of nearly equal size."""
    bits = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << b for b in bits[len(bits) * k // parts:len(bits) * (k + 1) // parts]) for k in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = 3, cap: int = TREE_CAP) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fp`` within ``radius`` bits of each other."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batch):
        out = []
        for shard in batch.column(0).to_pylist():
            out += tree_links([x & (1 << 64) - 1 for x in shard], radius)
        flat = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        yield [pa.array(np.ascontiguousarray(flat[:, 0])), pa.array(np.ascontiguousarray(flat[:, 1]))]

    spark, parts, found = fps.sparkSession, radius + 1, []
    masks = _cuts((1 << 64) - 1, parts)  # the bits on which the shards of this level agree
    entries = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        entries = entries.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))
        last = all(m.bit_count() >= BITS - 12 for m in masks)  # then a shard holds 2 ** 12 fingerprints at most
        crowded = None
        if not last:
            crowded = stage(entries.groupBy("mask", "bits").count().filter(F.col("count") > cap).select("mask", "bits"), "crowded")
            crowded = None if crowded.isEmpty() else crowded
        cold = entries if crowded is None else entries.join(crowded, ["mask", "bits"], "left_anti")
        shards = cold.groupBy("mask", "bits").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
        found.append(stage(shards.select(F.sort_array("fps").alias("fps")).mapInArrow(batches(schema, search), "a long, b long"), "links"))
        if crowded is None:
            break
        finer = [(m, m | c) for m in masks for c in _cuts(~m & (1 << 64) - 1, parts) if c]
        masks = sorted({c for _, c in finer})
        # a table of masks has at most (radius + 1) ** level rows
        pairs = spark.createDataFrame([(_signed(m), _signed(c)) for m, c in finer], "mask long, finer long")
        hot = entries.join(crowded, ["mask", "bits"], "left_semi")
        entries = stage(hot.join(F.broadcast(pairs), "mask").select("fp", F.col("finer").alias("mask")).distinct(), "split")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out.distinct()


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text",
                    cap: int = TREE_CAP) -> DataFrame:
    """``doc_id, fp, group_fp, component_id`` of every row.

    ``group_fp`` names the connected component (its smallest fingerprint); ``component_id`` is its smallest ``doc_id``.
    """
    rows = stage(fingerprints(docs, width, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    roots = connected_components(links(nodes.select("fp"), radius, cap).toDF("src", "dst"))
    nodes = nodes.join(roots.toDF("fp", "root"), "fp", "left").withColumn("group_fp", F.coalesce("root", "fp"))
    first = stage(nodes.groupBy("group_fp").agg(F.min("first_id").alias("component_id"), F.count("*").alias("degree")), "first")
    # a group has its linked nodes and its root, so linked nodes are at least half of any group's
    groups = stage(with_key_values(nodes.select("fp", "group_fp", "copies"), first, "group_fp", 2 * roots.count()), "groups")
    # a fingerprint of very many rows: they stay where they are and get its group by a bounded broadcast
    found = with_key_values(rows, groups.withColumnRenamed("copies", "degree"), "fp", rows.count())
    return found.select("doc_id", "fp", "group_fp", "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row of each component of ``docs`` (columns ``doc_id``, ``text`` and others): the one with the smallest ``doc_id``.

    Rows that repeat a ``doc_id`` of one component, and components without any ``doc_id``, also keep a single row: the first
    by all columns, in their order.
    """
    found = near_duplicates(docs.select("doc_id", "text"), width, radius)
    # all rows of an id count, also those that represent no component
    ids = found.groupBy(F.col("doc_id").alias("__picsel_id")).agg(
        F.count("*").alias("__picsel_rows"), F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("__picsel_kept"))
    ids = stage(ids.filter("__picsel_kept").select("__picsel_id", "__picsel_rows"), "kept-ids")
    one = ids.filter("__picsel_rows = 1 and __picsel_id is not null").select("__picsel_id")
    kept = docs.join(one, docs["doc_id"] == one["__picsel_id"], "left_semi")
    odd = ids.filter("__picsel_rows > 1 or __picsel_id is null").select("__picsel_id")
    if odd.isEmpty():
        return kept
    # a doc_id on several rows: tell them apart by their fingerprints, then by their columns
    again = docs.join(odd, docs["doc_id"].eqNullSafe(odd["__picsel_id"]), "left_semi")
    schema = pa.schema([("__picsel_doc_id", pa.int64()), ("__picsel_text", pa.string()), ("__picsel_fp", pa.int64())])

    def rows(batch):
        fp = np.array([fingerprint(utf8(t), width) for t in batch.column(1).to_pylist()], np.uint64)
        yield [batch.column(0), batch.column(1), pa.array(fp.view(np.int64))]

    texts = again.select(F.col("doc_id").cast("long"), "text").distinct().mapInArrow(batches(schema, rows), "__picsel_doc_id long, __picsel_text string, __picsel_fp long")
    own = found.select("doc_id", "fp", "group_fp", "component_id").distinct().toDF("__picsel_d", "__picsel_f", "__picsel_group", "__picsel_component")
    marked = again.join(texts, again["doc_id"].eqNullSafe(texts["__picsel_doc_id"]) & again["text"].eqNullSafe(texts["__picsel_text"]))
    marked = marked.join(own, marked["doc_id"].eqNullSafe(own["__picsel_d"]) & (marked["__picsel_fp"] == own["__picsel_f"]) & marked["doc_id"].eqNullSafe(own["__picsel_component"]))
    first = marked.groupBy("__picsel_group").agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("__picsel_row"))
    return kept.unionByName(first.select(*[F.col("__picsel_row").getField(c).alias(c) for c in docs.columns]))
