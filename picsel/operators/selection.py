"""Selection and rating (C1-C9) as DataFrame expressions and windows over the long-form pool.

Replaces the original driver-side pandas loops. Every window is partitioned by page (bounded: at most a
few hundred candidate rows per page), and the per-page top-k filters let Spark insert a partial
WindowGroupLimit before the shuffle. Draws are hash-seeded, ties broken by a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.functions.columns import is_valid_image_name, item_image_name, md5_bigint, numeric_instance_id
from picsel.operators.pool import PAGE_KEYS, Pool, category_stats, numbered_category_images
from picsel.session import materialize

CANDIDATE_COLUMNS = PAGE_KEYS + ["image", "rating", "note"]


def excluded_instance(instanceof="instanceof") -> Column:
    """The item is a disambiguation page, a year or a list (numeric-id of the P31 JSON)."""
    return F.coalesce(numeric_instance_id(instanceof).isin(*K.EXCLUDED_INSTANCE_NUMERIC_IDS), F.lit(False))


def eligible_pages(pages: DataFrame) -> DataFrame:
    """Pages that may receive candidates (C6 applied)."""
    return pages.where(~excluded_instance("instanceof"))


def images_by_wiki(lead_images: DataFrame) -> DataFrame:
    """Per page and image, the wikis using it as lead image (duplicates kept) and their number.

    An entry whose image name contains a space (or is empty) does not split into exactly two fields and
    is dropped; invalid names (C1) are dropped.
    """
    img = F.col("image")
    return (
        lead_images.where(~img.contains(" ") & (F.length(img) > 0) & is_valid_image_name(img))
        .groupBy(*PAGE_KEYS, "image")
        .agg(F.count(F.lit(1)).alias("n_wikis"), F.array_sort(F.collect_list("src_wiki")).alias("wikis"))
    )


def rank_lead_images(by_wiki: DataFrame, k: int = K.TOP_K) -> DataFrame:
    """Top-k images per page by number of wikis (desc), image ascending on ties.

    The i-th (0-based) gets rating 2 + i/10 and a note listing the wikis.
    """
    w = Window.partitionBy(*PAGE_KEYS).orderBy(F.col("n_wikis").desc(), F.col("image").asc())
    return (
        by_wiki.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k)
        .select(
            *PAGE_KEYS, "image",
            (F.lit(K.RATING_WIKIS_BASE) + (F.col("rn") - 1).cast("double") / F.lit(10.0)).alias("rating"),
            F.concat(F.lit(K.NOTE_WIKIPEDIA_PREFIX), F.concat_ws(", ", "wikis")).alias("note"),
        )
    )


def item_image_candidates(pages: DataFrame) -> DataFrame:
    """The item's P18 image unless it mentions 'flag'; quotes stripped by position; rating 1."""
    h = F.col("hasimage")
    return pages.where(h.isNotNull() & ~F.lower(h).contains("flag")).select(
        *PAGE_KEYS, item_image_name(h).alias("image"), F.lit(K.RATING_ITEM).alias("rating"),
        F.lit(K.NOTE_WIKIDATA).alias("note"))


#: Wikis in one bitmap word (the sign bit stays free).
WORD_BITS = 63


def image_bitmaps(lead_images: DataFrame, wikis: list[str]) -> DataFrame:
    """C2 in fixed space: per page and image ``n_wikis`` and bitmaps over ``wikis`` (sorted, one number each) instead of a list.

    ``seen_J`` has the bit of each wiki that uses the image and ``odd_J`` of those that use it an odd number of times, both by word ``J``
    of ``WORD_BITS`` wikis. So an image used once or twice by a wiki (its two lead-image properties) is told apart, with two words a
    group that any map task can combine. ``exact`` is false where a wiki uses it more often, as with several pages of one item.
    """
    number = F.broadcast(lead_images.sparkSession.createDataFrame([(w, i // WORD_BITS, 1 << i % WORD_BITS) for i, w in enumerate(wikis)], "src_wiki string, word int, bit bigint"))
    img = F.col("image")
    rows = lead_images.where(~img.contains(" ") & (F.length(img) > 0) & is_valid_image_name(img)).join(number, "src_wiki")
    words = range(-(-len(wikis) // WORD_BITS))
    own = lambda j: F.when(F.col("word") == j, F.col("bit")).otherwise(F.lit(0).cast("bigint"))
    out = rows.groupBy(*PAGE_KEYS, "image").agg(
        F.count(F.lit(1)).alias("n_wikis"), *[F.bit_or(own(j)).alias(f"seen_{j}") for j in words], *[F.bit_xor(own(j)).alias(f"odd_{j}") for j in words])
    counted = sum((F.bit_count(f"seen_{j}") + F.bit_count(F.col(f"seen_{j}").bitwiseXOR(F.col(f"odd_{j}"))) for j in words), F.lit(0))
    return out.withColumn("exact", F.col("n_wikis") == counted)


def _unfolded(wikis: list[str]) -> Column:
    """The wikis of a row of :func:`image_bitmaps`, sorted, those with an even count twice."""
    names = []
    for j in range(-(-len(wikis) // WORD_BITS)):
        part = F.array(*[F.lit(w) for w in wikis[j * WORD_BITS:(j + 1) * WORD_BITS]])
        times = lambda i, j=j: F.getbit(F.col(f"seen_{j}"), i) + F.getbit(F.col(f"seen_{j}").bitwiseXOR(F.col(f"odd_{j}")), i)
        names.append(F.flatten(F.transform(part, lambda w, i: F.array_repeat(w, times(i).cast("int")))))
    return F.concat(*names) if names else F.array().cast("array<string>")


def rank_lead_images_by_bitmap(lead_images: DataFrame, wikis: list[str], k: int = K.TOP_K, listed: DataFrame | None = None) -> DataFrame:
    """C2 and C3 without a list before the ranking: images are ranked by their bitmaps' counts, and only the ``k`` best of a page have their
    wikis unfolded. The best images whose bitmaps do not tell all repetitions get their lists from the leads themselves: from ``listed``,
    where that has all rows of the pages of ``lead_images`` and is cheaper to read. The best are staged, as both kinds are taken from them.

    ``wikis`` are those of ``lead_images``, sorted: one entry a wiki, held by the driver.
    """
    best = image_bitmaps(lead_images, wikis)
    order = Window.partitionBy(*PAGE_KEYS).orderBy(F.col("n_wikis").desc(), F.col("image").asc())
    best = materialize(best.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k), name="best-leads")
    columns = [*PAGE_KEYS, "image", "rn"]
    told = best.where("exact").select(*columns, _unfolded(wikis).alias("wikis"))
    rest = best.where("not exact").select(*columns)
    if not rest.isEmpty():
        rest = materialize(rest, name="listed-leads")
        leads = lead_images if listed is None else listed
        told = told.unionByName(leads.join(rest, [*PAGE_KEYS, "image"]).groupBy(*columns).agg(F.array_sort(F.collect_list("src_wiki")).alias("wikis")))
    return told.select(
        *PAGE_KEYS, "image", (F.lit(K.RATING_WIKIS_BASE) + (F.col("rn") - 1).cast("double") / F.lit(10.0)).alias("rating"),
        F.concat(F.lit(K.NOTE_WIKIPEDIA_PREFIX), F.concat_ws(", ", "wikis")).alias("note"))


def draw_category_images(pages: DataFrame, category_files: DataFrame, seed: str = K.DEFAULT_DRAW_SEED,
                         numbered: DataFrame | None = None) -> DataFrame:
    """C4: min(n_listed, 3) seeded draws with replacement among the category's dotted titles; distinct
    results rated 3.

    Each draw is an md5 value of (wiki, page, draw, seed) modulo the number of dotted titles, looked up by
    an equi-join on (category, index) -- no list is ever materialised. A category without dotted titles
    gives no candidate.
    """
    numbered = numbered if numbered is not None else numbered_category_images(category_files)
    stats = category_stats(category_files)
    draws = (
        pages.where(F.col("commonscategory").isNotNull())
        .select(*PAGE_KEYS, F.col("commonscategory").alias("cl_to"))
        .join(stats, "cl_to")
        .where(F.col("n_dotted_images") > 0)
        .select(*PAGE_KEYS, "cl_to", "n_dotted_images",
                F.explode(F.sequence(F.lit(0), F.least(F.col("n_category_images"), F.lit(K.TOP_K)).cast("int")
                                     - F.lit(1))).alias("draw"))
        .select(*PAGE_KEYS, "cl_to",
                F.pmod(md5_bigint("wiki_db", "page_id", "draw", F.lit(seed)), F.col("n_dotted_images"))
                .alias("idx"))
    )
    return (
        draws.join(numbered, ["cl_to", "idx"])
        .select(*PAGE_KEYS, F.col("page_title").alias("image"))
        .distinct()
        .select(*PAGE_KEYS, "image", F.lit(K.RATING_CATEGORY).alias("rating"), F.lit(K.NOTE_COMMONS).alias("note"))
    )


def merge_sources(*candidate_sets: DataFrame) -> DataFrame:
    """One row per (page, image); the lowest rating wins together with its own note.

    Equivalent to the original overwrite order (category -> wikis -> item) because the sources' rating
    ranges 3 > 2.x > 1 are disjoint. A page has a few rows at most, so they are dealt out by page at once: the ranking of a page's images
    and the list of its best need no further shuffle.
    """
    allc = candidate_sets[0].select(*CANDIDATE_COLUMNS)
    for c in candidate_sets[1:]:
        allc = allc.unionByName(c.select(*CANDIDATE_COLUMNS))
    return allc.repartition(*PAGE_KEYS).groupBy(*PAGE_KEYS, "image").agg(
        F.min("rating").alias("rating"), F.min_by("note", "rating").alias("note"))


def top_candidates(merged: DataFrame, k: int = K.TOP_K) -> DataFrame:
    """C8 (long form): k lowest ratings per page, image ascending on ties; with their 0-based rank."""
    w = Window.partitionBy(*PAGE_KEYS).orderBy(F.col("rating").asc(), F.col("image").asc())
    return (
        merged.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k)
        .select(*PAGE_KEYS, (F.col("rn") - 1).alias("rank"), "image", "rating", "note")
    )


def candidates_table(pool: Pool, top: DataFrame, keep_unmatched: bool = True,
                     with_instanceof: bool = True) -> DataFrame:
    """item_id, page_id, page_title, top_candidates (array, NULL when none), instanceof.

    ``keep_unmatched=False`` and ``with_instanceof=False`` give the earlier variant.
    """
    arr = top.groupBy(*PAGE_KEYS).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "image", "note", "rating"))),
            lambda s: F.struct(s["image"].alias("image"), s["note"].alias("note"), s["rating"].alias("rating")),
        ).alias("top_candidates"))
    cols = ["wiki_db", "item_id", "page_id", "page_title", "top_candidates"]
    if with_instanceof:
        cols.append("instanceof")
    return pool.pages.join(arr, PAGE_KEYS, "left" if keep_unmatched else "inner").select(*cols)


def raw_rows(cands: DataFrame, snapshot: str) -> DataFrame:
    """The candidates table in the raw (imagerec) shape: all strings, top_candidates as JSON text."""
    return cands.select(
        F.col("page_id").cast("string").alias("pandas_idx"),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("page_id").cast("string").alias("page_id"),
        F.col("page_title").cast("string").alias("page_title"),
        F.when(F.col("top_candidates").isNotNull(), F.to_json("top_candidates")).alias("top_candidates"),
        F.col("instanceof").cast("string").alias("instance_of"),
        F.col("wiki_db").cast("string").alias("wiki_db"),
        F.lit(snapshot).alias("snapshot"),
    )
