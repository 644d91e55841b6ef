"""Image-page metadata (F1-F9): sample candidates, locate their Commons pages, extract descriptive fields.

Pages arrive as a table (url, html); the only Python is the per-page HTML extraction, run in Arrow-batched
pandas UDFs on the executors after Spark has joined pages to candidate images.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from picsel import constants as K
from picsel.functions import html_extract as H
from picsel.functions.columns import image_extension, image_page_url, wiki_direction
from picsel.schemas import TOP_CANDIDATES_DDL


def sample_pages(raw: DataFrame, n: int = K.METADATA_SAMPLE_SIZE, seed: str = K.DEFAULT_DRAW_SEED) -> DataFrame:
    """at most n candidate rows per wiki, in a seeded hash order.

    ``row_number <= n`` lets Spark put a partial WindowGroupLimit before the shuffle, so a wiki holding a
    third of all rows still ships at most n rows per task to the final window.
    """
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col("page_id").cast("string")))
    w = Window.partitionBy("wiki_db").orderBy(order, F.col("page_id"))
    return raw.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def distinct_candidate_images(raw: DataFrame) -> DataFrame:
    """distinct (wiki_db, image) over parsed candidates; NULL images dropped."""
    return (
        raw.where(F.col("top_candidates").isNotNull())
        .select("wiki_db", F.explode(F.from_json("top_candidates", TOP_CANDIDATES_DDL)).alias("c"))
        .select("wiki_db", F.col("c.image").alias("image"))
        .where(F.col("image").isNotNull())
        .distinct()
    )


def page_language(wiki_db) -> F.Column:
    """Interface language of a wiki's pages: the wiki name with 'wiki' removed."""
    return F.replace(F.col(wiki_db) if isinstance(wiki_db, str) else wiki_db, F.lit("wiki"), F.lit(""))


def candidate_image_pages(images: DataFrame) -> DataFrame:
    """F3 + F7 + F8: Commons URL in the wiki's language, file extension, text direction."""
    lang = page_language("wiki_db")
    return images.select(
        "wiki_db", "image", lang.alias("language"),
        image_page_url("image", lang).alias("url"),
        image_extension("image").alias("extension"),
        wiki_direction("wiki_db").alias("direction"),
    )


_FIELDS = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("caption", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("property", T.StringType()), T.StructField("value", T.StringType())]))),
])


@F.pandas_udf(_FIELDS)
def _extract(html: pd.Series, language: pd.Series, direction: pd.Series) -> pd.DataFrame:
    rows = []
    for h, lang, d in zip(html, language, direction):
        doc = H.parse(h)
        rows.append((H.description(doc, lang, d), H.caption(doc, lang), [{"property": p, "value": v} for p, v in H.format_values(doc)]))
    return pd.DataFrame(rows, columns=["description", "caption", "blocks"])


#: A JSON object opened by one level: each value stays the JSON text it was, whatever its shape, and the order stays the text's.
#: (VARIANT would take any shape too, but it sorts the keys of an object, and the first entry is told by its place.)
OBJECT_DDL = "map<string, string>"
PROP_DEPICTS, PROP_LICENCE = "P180", "P275"


def _opened(json_text) -> F.Column:
    return F.from_json(json_text, OBJECT_DDL)


def block_values(blocks, language, prop: str) -> F.Column:
    """the values of ``prop`` in the given language; the first entry of each block, of whatever shape, is not one of them.

    An entry is ``{"text/plain": {language: {property: value}}}`` and its first property counts. Malformed blocks, entries of
    another shape and entries without the language give none; the entries beside them count.
    """
    own = F.filter(blocks, lambda b: b["property"].isin(PROP_DEPICTS, PROP_LICENCE))
    entries = F.flatten(F.transform(own, lambda b: F.coalesce(
        F.slice(F.map_values(_opened(b["value"])), F.lit(2), F.lit(1 << 30)), F.array())))
    plain = F.transform(entries, lambda e: _opened(F.try_element_at(_opened(e), F.lit("text/plain"))))
    first = F.transform(plain, lambda t: F.get(F.map_entries(_opened(F.try_element_at(t, language))), F.lit(0)))
    return F.transform(F.filter(first, lambda x: x["key"] == prop), lambda x: x["value"])


def page_fields(pages: DataFrame) -> DataFrame:
    """F4-F6 of ``html, language, direction`` rows with html: description, caption, depicts, licence (the last one)."""
    got = pages.where(F.col("html").isNotNull()).withColumn("m", _extract("html", "language", "direction"))
    licences = block_values(F.col("m.blocks"), F.col("language"), PROP_LICENCE)
    return got.withColumns({
        "description": F.col("m.description"), "caption": F.col("m.caption"),
        "depicts": block_values(F.col("m.blocks"), F.col("language"), PROP_DEPICTS), "licence": F.try_element_at(licences, F.lit(-1)),
    }).drop("m", "html")


def image_metadata(image_pages: DataFrame, pages: DataFrame) -> DataFrame:
    """candidate image pages and the fetched pages of their urls -> description, caption, depicts, licence.

    Only pages that were fetched reach Python; an image without one gets NULL fields. Pages, and their urls, are as many as the
    input has, whatever a plan's estimate of them says (built or packed text is estimated far too small), so neither side is ever
    broadcast: both meet the images by sorted shuffles.
    """
    fetched = pages.where(F.col("html").isNotNull()).select("url", "html")
    found = page_fields(image_pages.join(fetched.hint("merge"), "url")).select("wiki_db", "image", "description", "caption", "depicts", "licence")
    missing = image_pages.join(fetched.select("url").hint("merge"), "url", "left_anti").select("wiki_db", "image")
    return found.unionByName(missing, allowMissingColumns=True)
