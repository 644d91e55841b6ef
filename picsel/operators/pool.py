"""Candidate pool (B1-B15): unillustrated articles of every wiki and their three candidate sources.

All wikis are processed in one plan; ``wiki_db`` is part of every key. Only per-wiki dimension frames
(one row per wiki, so bounded by the number of wikis) are broadcast explicitly; every other join is left to
Catalyst / AQE, which turns a side into a broadcast only after measuring it at runtime.
Long rows replace the original collected lists, so no group is ever gathered into one value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.functions.columns import icon_threshold, label_language
from picsel.session import materialize

PAGE_KEYS = ["wiki_db", "page_id"]


# --------------------------------------------------------------------------------------------------
# Which articles are unillustrated
# --------------------------------------------------------------------------------------------------

def articles(page: DataFrame) -> DataFrame:
    """Namespace-0, non-redirect pages (Commons files are namespace 6, so they drop out here)."""
    return page.where((F.col("page_namespace") == 0) & (F.col("page_is_redirect") == 0))


def wiki_size(page: DataFrame) -> DataFrame:
    """B1: number of articles per wiki."""
    return articles(page).groupBy("wiki_db").agg(F.count(F.lit(1)).alias("wiki_size"))


def icon_thresholds(sizes: DataFrame) -> DataFrame:
    """B2 applied to B1: one threshold per wiki."""
    return sizes.withColumn("threshold", icon_threshold("wiki_size"))


def icon_images(imagelinks: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Images linked from strictly more than the wiki's threshold of namespace-0 pages.

    Names containing a double quote or a comma are never icons. The count is a partial (map-side)
    aggregation, so a very popular image costs one row per task before the shuffle.
    """
    counts = (
        imagelinks.where(
            (F.col("il_from_namespace") == 0)
            & ~F.col("il_to").contains('"') & ~F.col("il_to").contains(","))
        .groupBy("wiki_db", "il_to").agg(F.count("il_to").alias("n_links"))
    )
    # one row per wiki: bounded by the number of wikis
    th = F.broadcast(thresholds.select("wiki_db", "threshold"))
    return counts.join(th, "wiki_db").where(F.col("n_links") > F.col("threshold"))


#: So many icons are broadcast: all, or of more those with over one in so many of all icon links.
HEAVY_ICONS = 200_000


def pages_with_images(imagelinks: DataFrame, icons: DataFrame, heavy_icons: int = HEAVY_ICONS, repeats: bool = False) -> DataFrame:
    """Distinct pages having at least one non-icon image link. ``icons`` has B3's counts and is counted here, so it should be staged.

    Up to ``heavy_icons`` icons are broadcast, and no link is shuffled by its image. Of more, the links of the icons with most links are
    dropped where they lie, by a broadcast of those icons, before any other link is shuffled by its image: no task gets the links of
    such an icon, whether or not AQE would have split it. With ``repeats`` a page comes once a link, for a caller that makes the set.
    """
    keys = ["wiki_db", "il_to"]
    links = imagelinks.where(F.col("il_from_namespace") == 0).select(*keys, "il_from")
    if icons.limit(heavy_icons + 1).count() <= heavy_icons:
        links = links.join(F.broadcast(icons.select(*keys)), keys, "left_anti")
    else:
        share = icons.agg(F.sum("n_links") / F.lit(float(heavy_icons))).scalar()
        heavy = icons.where(F.col("n_links") > share).select(*keys)
        light = icons.where(F.col("n_links") <= share).select(*keys)
        links = links.join(F.broadcast(heavy), keys, "left_anti").join(light, keys, "left_anti")
    out = links.select("wiki_db", F.col("il_from").alias("page_id"))
    return out if repeats else out.distinct()


def pages_with_lead_image(page_props: DataFrame, repeats: bool = False) -> DataFrame:
    """Distinct pages carrying a lead-image property; with ``repeats`` once a property."""
    out = (
        page_props.where(F.col("pp_propname").isin(*K.LEAD_IMAGE_PROPS))
        .select("wiki_db", F.col("pp_page").alias("page_id"))
    )
    return out if repeats else out.distinct()


def illustrated_pages(with_images: DataFrame, with_lead: DataFrame) -> DataFrame:
    """Set union of B4 and B5."""
    return with_images.union(with_lead).distinct()


def unillustrated_pages(page: DataFrame, item_page_link: DataFrame, illustrated: DataFrame) -> DataFrame:
    """Articles linked to an item and not illustrated -> wiki_db, item_id, page_id, page_title, page_len."""
    links = item_page_link.where(F.col("page_namespace") == 0).select("wiki_db", "page_id", "item_id")
    return (
        articles(page).select("wiki_db", "page_id", "page_title", "page_len")
        .join(links, PAGE_KEYS)
        .join(illustrated, PAGE_KEYS, "left_anti")
        .select("wiki_db", "item_id", "page_id", "page_title", "page_len")
    )


# --------------------------------------------------------------------------------------------------
# Item properties and Commons category files
# --------------------------------------------------------------------------------------------------

def item_properties_flat(claims: DataFrame) -> DataFrame:
    """Per item: the largest P18, P373 and P31 values of flattened claims (id or item_id, property, value)."""
    if "id" not in claims.columns:
        claims = claims.withColumnRenamed("item_id", "id")
    p, v = F.col("property"), F.col("value")
    return (
        claims.where(p.isin(K.PROP_IMAGE, K.PROP_INSTANCE_OF, K.PROP_COMMONS_CATEGORY))
        .groupBy("id").agg(
            F.max(F.when(p == K.PROP_IMAGE, v)).alias("hasimage"),
            F.max(F.when(p == K.PROP_COMMONS_CATEGORY, category_name(v))).alias("commonscategory"),
            F.max(F.when(p == K.PROP_INSTANCE_OF, v)).alias("instanceof"),
        )
    )


def item_claims(entity: DataFrame, pages: DataFrame) -> DataFrame:
    """Per (wiki_db, item) of ``pages``: label in the wiki's language and the three properties.

    An item without a label in that language, or without any of the three properties, has no row. The entity table is read
    once; labels and claims are looked up inside their map and array, so nothing is exploded, and the needed items meet
    the entities in one join. They are dealt out by item once, for their set and the join.
    """
    needed = pages.select("wiki_db", "item_id").repartition("item_id").distinct().withColumn("lang", label_language("wiki_db"))
    snak = lambda c: c["mainSnak"]

    def largest(prop, clean=lambda v: v):
        own = F.filter("claims", lambda c: snak(c)["property"] == prop)
        return F.array_max(F.transform(own, lambda c: clean(snak(c)["datavalue"]["value"])))

    wanted = [K.PROP_IMAGE, K.PROP_INSTANCE_OF, K.PROP_COMMONS_CATEGORY]
    items = entity.where((F.col("typ") == "item") & F.arrays_overlap("claims.mainSnak.property", F.array(*map(F.lit, wanted)))).select(
        "id", "labels", largest(K.PROP_IMAGE).alias("hasimage"), largest(K.PROP_COMMONS_CATEGORY, category_name).alias("commonscategory"),
        largest(K.PROP_INSTANCE_OF).alias("instanceof"))
    return (
        needed.join(items, needed.item_id == items.id).where(F.map_contains_key("labels", F.col("lang")))
        .select("wiki_db", "id", F.try_element_at("labels", F.col("lang")).alias("label_val"), "hasimage", "commonscategory", "instanceof")
    )


def category_name(value):
    """A P373 value as a category title: quotes removed, spaces to underscores."""
    return F.replace(F.replace(value, F.lit('"'), F.lit("")), F.lit(" "), F.lit("_"))


def item_claims_flat(claims: DataFrame, labels: DataFrame, pages: DataFrame) -> DataFrame:
    """B8 over flattened claims (item_id, property, value) and labels (item_id, lang, label)."""
    needed = pages.select("wiki_db", "item_id").distinct().withColumn("lang", label_language("wiki_db"))
    lab = labels.select(F.col("item_id").alias("id"), "lang", F.col("label").alias("label_val"))
    return _claims_rows(needed, lab, item_properties_flat(claims))


def _claims_rows(needed: DataFrame, labels: DataFrame, props: DataFrame) -> DataFrame:
    return (
        needed.join(labels, (needed.item_id == labels.id) & (needed.lang == labels.lang))
        .join(props, "id")
        .select("wiki_db", "id", "label_val", "hasimage", "commonscategory", "instanceof")
    )


def commons_files(page: DataFrame) -> DataFrame:
    """Non-redirect namespace-6 pages of Commons (page_id, page_title)."""
    return page.where(
        (F.col("wiki_db") == K.COMMONS_WIKI) & (F.col("page_namespace") == 6)
        & (F.col("page_is_redirect") == 0)
    ).select("page_id", "page_title")


def placeholder_images(categorylinks: DataFrame, page: DataFrame, placeholder_category: DataFrame) -> DataFrame:
    """Commons files in a placeholder category (no cl_type filter, no dedupe)."""
    cl = categorylinks.where(F.col("wiki_db") == K.COMMONS_WIKI)
    cats = placeholder_category.select(F.col("title").alias("cl_to"))
    return (
        cl.join(commons_files(page), cl.cl_from == F.col("page_id"))
        .join(cats, "cl_to")
        .select("cl_from", "cl_to", "cl_type", "page_title")
    )


def category_images(claims: DataFrame, categorylinks: DataFrame, page: DataFrame,
                    placeholders: DataFrame | None) -> DataFrame:
    """B10 in long form: (cl_to, page_title) for each Commons category named by a candidate item.

    Files are non-redirect namespace-6 pages linked with cl_type='file', minus placeholder titles.
    Categories are taken once each, so a category shared by many items does not repeat its files.
    """
    cl = categorylinks.where((F.col("wiki_db") == K.COMMONS_WIKI) & (F.col("cl_type") == "file"))
    wanted = claims.where(F.col("commonscategory").isNotNull()).select(F.col("commonscategory").alias("cl_to"))
    out = (
        cl.join(wanted, "cl_to", "left_semi")
        .join(commons_files(page), cl.cl_from == F.col("page_id"))
        .select("cl_to", "page_title")
    )
    if placeholders is not None:
        out = out.join(placeholders.select("page_title"), "page_title", "left_anti")
    return out.select("cl_to", "page_title")


def category_stats(cat_files: DataFrame) -> DataFrame:
    """Per category: number of listed files and of titles containing a dot."""
    return cat_files.groupBy("cl_to").agg(
        F.count(F.lit(1)).alias("n_category_images"),
        F.count(F.when(F.col("page_title").contains("."), 1)).alias("n_dotted_images"),
    )


def with_category_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """``df`` left-joined to its category's counts; rows without a category, mostly a majority, bypass the join."""
    known = df.where(F.col("commonscategory").isNotNull()).join(stats, F.col("commonscategory") == F.col("cl_to"), "left").drop("cl_to")
    rest = df.where(F.col("commonscategory").isNull())
    return known.unionByName(rest, allowMissingColumns=True)


def items_with_category_images(claims: DataFrame, cat_files: DataFrame) -> DataFrame:
    """B8 left-joined to its category's file counts (the list itself stays in long form)."""
    return with_category_stats(claims, category_stats(cat_files))


def numbered_category_images(cat_files: DataFrame) -> DataFrame:
    """Dotted titles of each category numbered 0..n-1 in title order.

    A category may hold a third of all files; numbering it in one window would put it in one task. The rows are
    range-partitioned by (category, title) and staged, so the ranges are fixed; each range of a category is numbered on its
    own and starts where the counts of the category's earlier ranges end. The ranges do not change the numbers.
    """
    dotted = cat_files.where(F.col("page_title").contains("."))
    ranged = materialize(dotted.repartitionByRange("cl_to", "page_title").withColumn("part", F.spark_partition_id()), name="category-ranges")
    local = ranged.withColumn("local_idx", F.row_number().over(Window.partitionBy("cl_to", "part").orderBy("page_title")) - 1)
    counts = ranged.groupBy("cl_to", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("cl_to").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (
        local.join(offsets, ["cl_to", "part"])
        .select("cl_to", (F.col("start") + F.col("local_idx")).cast("bigint").alias("idx"), "page_title")
    )


# --------------------------------------------------------------------------------------------------
# Lead images in other wikis and the pool
# --------------------------------------------------------------------------------------------------

def item_lead_images(item_page_link: DataFrame, page_props: DataFrame, page: DataFrame,
                     placeholders: DataFrame | None, items: DataFrame | None = None) -> DataFrame:
    """Lead images of every namespace-0 page linked to an item: (item_id, src_wiki, image).

    ``items`` (item_id) cuts the links to the needed items before anything is joined to them. Kept only when the title is a non-redirect Commons
    file and not a placeholder. A page with both lead-image properties contributes twice, as in the original.
    """
    lead = (
        page_props.where(F.col("pp_propname").isin(*K.LEAD_IMAGE_PROPS))
        .select(F.col("wiki_db").alias("src_wiki"), F.col("pp_page").alias("page_id"),
                F.col("pp_value").alias("image"))
    )
    # each title once, in an inner join: Spark would move a semi-join below that of links and properties, to all properties
    titles = commons_files(page).select(F.col("page_title").alias("image"))
    if placeholders is not None:
        titles = titles.join(placeholders.select(F.col("page_title").alias("image")), "image", "left_anti")
    links = item_page_link.where(F.col("page_namespace") == 0).select(
        "item_id", F.col("wiki_db").alias("src_wiki"), "page_id")
    if items is not None:
        links = links.join(items.select("item_id").distinct(), "item_id", "left_semi")
    return links.join(lead, ["src_wiki", "page_id"]).join(titles.distinct(), "image").select("item_id", "src_wiki", "image")


def lead_images_elsewhere(pages: DataFrame, item_leads: DataFrame) -> DataFrame:
    """B12 in long form: for each page, the lead images of its item's pages in *other* wikis.

    Output: the columns of ``pages`` plus src_wiki, image. The wikis of an (item, image) are gathered first, a list bounded
    by the number of wikis, so the join brings a page one row per image; its own wiki is left out as the list is unfolded.
    """
    images = item_leads.groupBy("item_id", "image").agg(F.collect_list("src_wiki").alias("wikis"))
    others = F.filter("wikis", lambda w: w != F.col("wiki_db"))
    return pages.join(images, "item_id").select(*pages.columns, F.explode(others).alias("src_wiki"), "image")


@dataclass
class Pool:
    """The candidate pool in long form.

    ``pages``: one row per unillustrated page with its item properties (B7 left join B8);
    ``lead_images``: B12 rows; ``category_files``: B10 rows.
    """
    pages: DataFrame
    lead_images: DataFrame
    category_files: DataFrame


def candidate_pool(pool: Pool) -> DataFrame:
    """One row per unillustrated page with its sources summarised.

    lan_images are rendered as a sorted ';'-joined list of ``"<wiki>: <image>"`` (bounded per page);
    the category list stays long and is summarised by its file count.
    """
    lan = pool.lead_images.groupBy(*PAGE_KEYS).agg(
        F.count(F.lit(1)).alias("n_lan_images"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "src_wiki", "image"))), ";")
        .alias("lan_images"),
    )
    stats = category_stats(pool.category_files)
    return (
        with_category_stats(pool.pages.join(lan, PAGE_KEYS, "left"), stats)
        .select("wiki_db", "item_id", "page_id", "page_title", "page_len", "lan_images", "n_lan_images",
                "label_val", "hasimage", "commonscategory", "instanceof", "n_category_images")
    )


def pool_coverage(pool_rows: DataFrame) -> DataFrame:
    """Per wiki, unillustrated articles and how many have each source."""
    return pool_rows.groupBy("wiki_db").agg(
        F.count(F.lit(1)).alias("n_unillustrated"),
        F.count("hasimage").alias("n_with_item_image"),
        F.count(F.when(F.col("n_category_images") > 0, 1)).alias("n_with_category_images"),
        F.count("lan_images").alias("n_with_lead_images"),
    )


def with_any_source(pool_rows: DataFrame) -> DataFrame:
    """Rows having at least one of the three sources."""
    return pool_rows.where(
        F.col("hasimage").isNotNull() | (F.col("n_category_images") > 0) | F.col("lan_images").isNotNull())
