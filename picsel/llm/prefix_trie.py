"""The trie of conversation prefixes by the Euler-tour technique.

Each distinct sequence of first turns is a node. The nodes are found by a running fingerprint of 128 bits (XOR of the SHA-256 of
each turn with its depth; n nodes collide with a chance of about n * n / 2**129), the trie's tour by an enter and an exit arc
for each node: a node's first arc leads to its first child or to its own exit, the exit to the next sibling's enter or
the parent's exit. The tour is ranked as a linked list (:mod:`list_rank`); the sums over a node's subtree are then the running sums at
its exit less those before its enter, however deep or wide the trie is.

Nothing is gathered by conversation or by parent: turns, siblings and members are put in a global order dealt out by ranges, so a
conversation, a parent or a node that holds a third of all rows lies in many parts, and running values pass from part
to part as one row a part. A parent with very many children meets them by a bounded broadcast. A node's digest is made by one
task, as SHA-256 must be, but from pieces of up to ``PIECE`` joined ids that are read as a stream.

Odd rows: rows without conv_id belong to no conversation and are left out; a null role or text counts as empty; a null turn comes first;
rows of equal turn are in the order of role, then text, and repeated rows are turns of their own; an empty table gives an empty result.
A very long text is hashed once and not carried on. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from picsel.llm.common import stage
from picsel.llm.components import with_key_values
from picsel.llm.list_rank import in_order, list_ranks, row_numbers, running_sums

#: Member ids that are joined at once.
PIECE = 10_000
#: Hexadecimal digits of a turn's fingerprint.
DIGITS = 32
_KEY = ["depth", "x", "y"]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, content, chars`` of the rows ``conv_id, turn, role, text``: places count from 1 in each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    content = F.substring(F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256), 1, DIGITS)
    ordered = in_order(rows.where("conv_id is not null"), ["conv_id", "turn", "role", "text"],
                       ["conv_id", content.alias("content"), F.length("text").cast("long").alias("chars")], "turns")
    return _places(ordered).select("conv_id", "place", "content", "chars")


def _places(ordered: DataFrame) -> DataFrame:
    """Ordered turns with ``place`` (from 1) in their conversation and the conversation's number of turns, ``size``."""
    spans = ordered.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    mine = Window.partitionBy("conv_id")  # a row for each part that a conversation lies in
    spans = spans.select("conv_id", "part", "first", F.sum("n").over(mine).alias("size"),
                         (F.sum("n").over(mine.orderBy("part")) - F.col("n")).alias("before"))
    rows = ordered.join(spans, ["conv_id", "part"])
    return rows.withColumn("place", F.col("before") + F.col("pos") - F.col("first") + 1).drop("before", "first")


def _half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def _prefixes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conversation and prefix: its key, its parent's (``px, py``), its last turn's ``chars``, whether it is whole."""
    ordered = _places(in_order(rows, ["conv_id", "place"], ["conv_id", "content", "chars"], "ordered-turns")).withColumnRenamed("place", "depth")
    digest = F.sha2(F.concat_ws(":", "depth", "content"), 256)
    parts = ordered.withColumn("digest", digest).withColumns({"ex": _half(F.col("digest"), 1), "ey": _half(F.col("digest"), 17)})
    inside = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumns({"x": F.bit_xor("ex").over(inside), "y": F.bit_xor("ey").over(inside)})
    parts = stage(parts.select("conv_id", "part", "depth", "size", "chars", "ex", "ey", "x", "y"), "part-prefixes")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = parts.groupBy("conv_id", "part").agg(F.bit_xor("ex").alias("sx"), F.bit_xor("ey").alias("sy"))
    spans = spans.select("conv_id", "part", F.coalesce(F.bit_xor("sx").over(earlier), F.lit(0)).alias("bx"),
                         F.coalesce(F.bit_xor("sy").over(earlier), F.lit(0)).alias("by"))
    full = parts.join(spans, ["conv_id", "part"]).withColumns({"x": F.col("x").bitwiseXOR(F.col("bx")), "y": F.col("y").bitwiseXOR(F.col("by"))})
    found = full.select("conv_id", F.col("depth").cast("long").alias("depth"), "x", "y", F.col("x").bitwiseXOR(F.col("ex")).alias("px"),
                        F.col("y").bitwiseXOR(F.col("ey")).alias("py"), "chars", (F.col("depth") == F.col("size")).alias("whole"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    spoken = found.where("depth = 1").select("conv_id", F.lit(True).alias("spoken"))
    roots = convs.join(spoken, "conv_id", "left").select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y"), none.alias("px"),
                                                         none.alias("py"), zero.alias("chars"), F.col("spoken").isNull().alias("whole"))
    return stage(found.unionByName(roots), "prefixes")


_DIGEST = "depth long, x long, y long, ends_sha256 string"
_DIGEST_ARROW = pa.schema([("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])


def _stream_digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node from its pieces in order; only the running state is held."""
    now, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in now], pa.array([state.hexdigest()])], schema=_DIGEST_ARROW)
    for batch in it:
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "x", "y", "ids")]):
            if key != now:
                if now is not None:
                    yield row()
                now, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if now is not None:
        yield row()


def _ends(prefixes: DataFrame) -> DataFrame:
    """The digest of each node's whole conversations: their ids in decimal, ascending, joined by commas."""
    ordered = in_order(prefixes.where("whole"), [*_KEY, "conv_id"], [*_KEY, "conv_id"], "ends")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    pieces = stage(ordered.groupBy(*_KEY, "part", F.floor(F.col("pos") / F.lit(PIECE)).alias("piece")).agg(ids.alias("ids")), "pieces")
    nodes = pieces.groupBy(*_KEY).agg(F.count("*").alias("n"), F.first("ids").alias("ids"))
    single = nodes.where("n = 1").select(*_KEY, F.sha2("ids", 256).alias("ends_sha256"))
    many = pieces.join(nodes.where("n > 1").select(*_KEY), _KEY, "left_semi").repartition(*_KEY).sortWithinPartitions(*_KEY, "part", "piece")
    return single.unionByName(many.select(*_KEY, "ids").mapInArrow(_stream_digests, _DIGEST))


def _tour(nodes: DataFrame) -> DataFrame:
    """``arc, succ, place``: node ``id`` is entered by arc ``2 * id`` and left by ``2 * id + 1``. Children of a node have
    consecutive ids, so a sibling's id is the next one."""
    last = nodes.where("last is not null").select(F.col("last").alias("id"), F.col("id").alias("parent"))
    both = nodes.select("id", "conv_id", "first").join(last, "id", "left")
    enter = F.coalesce(2 * F.col("first"), 2 * F.col("id") + 1)
    leave = F.when(F.col("parent").isNotNull(), 2 * F.col("parent") + 1).when(F.col("id") == 0, F.lit(-1)).otherwise(2 * (F.col("id") + 1))
    arcs = F.array(F.struct((2 * F.col("id")).alias("arc"), enter.alias("succ")), F.struct((2 * F.col("id") + 1).alias("arc"), leave.alias("succ")))
    return both.select(F.coalesce("conv_id", F.lit(0)).alias("place"), F.explode(arcs).alias("a")).select("place", "a.arc", "a.succ")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the conversations ``convs`` (distinct ``conv_id``) with the turns ``rows`` (see :func:`turns`; places may have gaps).

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    prefixes = _prefixes(rows.select("conv_id", "place", "content", "chars"), convs)
    found = prefixes.groupBy(*_KEY).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
                                        F.max("px").alias("px"), F.max("py").alias("py"))
    # by depth first: the root's id is 0
    nodes = row_numbers(in_order(found, ["depth", "px", "py", "conv_id", "x", "y"], found.columns, "nodes")).drop("part", "pos")
    families = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_children"))
    nodes = stage(nodes.join(families, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "families")
    ranks = list_ranks(_tour(nodes))
    arcs = ranks.withColumns({"id": F.shiftright("arc", 1), "leaves": F.col("arc") % 2 == 1}).join(nodes.select("id", "n_children", "n_convs", "chars"), "id")
    weigh = lambda w: F.when(~F.col("leaves"), w).otherwise(F.lit(0)).cast("long")
    arcs = arcs.select("id", "rank", "leaves", weigh((F.col("n_children") == 0).cast("long")).alias("n_leaves"),
                       weigh((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    arcs = arcs.withColumns({"own_leaf": F.col("n_leaves"), "own_saved": F.col("saved_tokens")})
    sums = running_sums(arcs, "rank", ["n_leaves", "saved_tokens"])
    change = lambda total, own: F.sum(F.when(F.col("leaves"), F.col(total)).otherwise(F.col(own) - F.col(total))).alias(total)
    below = sums.groupBy("id").agg(change("n_leaves", "own_leaf"), change("saved_tokens", "own_saved"))
    out = nodes.join(below, "id").withColumn("parent", F.struct((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")))
    parents = nodes.where("n_children > 0").select(F.struct(*_KEY).alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("degree"))
    out = stage(out.select(*_KEY, "parent", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "trie")
    children = with_key_values(out.where("depth > 0"), parents, "parent", out.count())
    every = children.unionByName(out.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    every = every.join(_ends(prefixes), _KEY, "left")
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
