"""Chat formatting from typed content parts, in DataFrame functions only.

A turn's content is a list of parts ``struct<type, text, ref, units>``. A visitor flattens the parts in order: text is
escaped and kept, each image, audio or document part becomes a placeholder ``<part TYPE NUMBER>`` that counts through the
conversation, and its attachment is recorded with its reference and expanded token count (units of the part times ``TOKENS`` of
its type, plus the placeholder's ``MARKS``). Parts of an unknown type are kept as text.

The template is ``<turn ROLE>TEXT</turn>`` and a line break for each turn. In texts a backslash is put after every ``<``, so no text holds
a control string, not even where two parts meet; taking these backslashes away restores the text. Roles are escaped likewise.

Odd rows: a null text or content counts as empty, a null role as an empty role; turns with the same number are ordered by role
and content; repeated rows are repeated turns; rows without a conv_id form one conversation; an empty table gives none. A very long text is
part of its conversation's string like any other. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of one unit of a part: an image tile, a second of audio, a page.
TOKENS = {"image": 256, "audio": 25, "document": 512}
MARKS = 2
PART = "struct<type:string,text:string,ref:string,units:long>"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


_ROLE = (("\\", "\\b"), (">", "\\g"), ("<", "\\l"))


def _escape_role(role: Column) -> Column:
    for char, code in _ROLE:
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def _unescape_role(role: Column) -> Column:
    for char, code in reversed(_ROLE):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("long").alias("units")).cast(PART))


def _is_media(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*TOKENS), F.lit(False))


def _expanded(part: Column) -> Column:
    per_unit = F.coalesce(*[F.when(part["type"] == k, F.lit(n)) for k, n in TOKENS.items()])
    return (F.coalesce(part["units"], F.lit(1)) * per_unit + MARKS).cast("long")


def _visit(content: Column, before: Column) -> Column:
    """The text of a turn; ``before`` media parts stand in the turns before it."""
    def piece(part, i):
        number = before + F.size(F.filter(F.slice(content, F.lit(1), i), _is_media))
        mark = F.concat(F.lit("<part "), part["type"], F.lit(" "), number.cast("string"), F.lit(">"))
        return F.when(_is_media(part), mark).otherwise(escape(F.coalesce(part["text"], F.lit(""))))
    return F.array_join(F.transform(content, piece), "")


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, content``.

    ``n_turns``; ``formatted``; ``spans``: for each turn its role and the code points ``start`` and ``length`` of its text in
    ``formatted``; ``loss_mask``: the spans of the assistant's texts; ``attachments``: ``number, type, ref, tokens`` in order.
    A single shuffle by conversation serves the running counts and the grouping.
    """
    content = F.coalesce(F.col("content"), F.array().cast(f"array<{PART}>"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), content.alias("content"))
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "content")))
    rows = rows.withColumn("media", F.filter("content", _is_media))
    rows = rows.withColumn("first", F.coalesce(F.sum(F.size("media")).over(before), F.lit(0)))
    rows = rows.withColumn("head", F.concat(F.lit("<turn "), _escape_role(F.col("role")), F.lit(">")))
    rows = rows.withColumn("text", _visit(F.col("content"), F.col("first")))
    rows = rows.withColumn("whole", F.concat("head", "text", F.lit("</turn>\n")))
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("whole")).over(before), F.lit(0)) + F.length("head"))
    found = F.transform("media", lambda p, i: F.struct((F.col("first") + i).cast("long").alias("number"), p["type"].alias("type"),
                                                       p["ref"].alias("ref"), _expanded(p).alias("tokens")))
    turn = F.struct("place", "whole", F.struct("role", F.col("start").cast("long").alias("start"),
                                               F.length("text").cast("long").alias("length")).alias("span"), found.alias("found"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    spans = F.transform("t", lambda t: t["span"])
    return chats.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                        F.array_join(F.transform("t", lambda t: t["whole"]), "").alias("formatted"), spans.alias("spans"),
                        F.filter(spans, lambda s: s["role"] == "assistant").alias("loss_mask"),
                        F.flatten(F.transform("t", lambda t: t["found"])).alias("attachments"))


_HEAD = r"(?s)^<turn ([^>]*)>"


def read_chats(formatted: Column) -> Column:
    """The turns ``struct<role, text>`` of a formatted conversation, from its string alone; placeholders stay in the text."""
    turns = F.split(formatted, "</turn>\n", -1)
    return F.transform(F.slice(turns, F.lit(1), F.size(turns) - 1), lambda t: F.struct(
        _unescape_role(F.regexp_extract(t, _HEAD, 1)).alias("role"), unescape(F.regexp_replace(t, _HEAD, "")).alias("text")))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    part = lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
    return F.array_join(F.transform(mask, lambda s: unescape(part(s))), "")
