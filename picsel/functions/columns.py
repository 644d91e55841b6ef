"""Column expressions (JVM-side, codegen-friendly). No Python UDFs here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.schemas import INSTANCE_OF_DDL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of(snapshot) -> Column:
    """A2: ``YYYY-MM-DD`` -> ``YYYY-MM`` (leading ``word-word``)."""
    return F.regexp_extract(_c(snapshot), r"^(\w+-\w+)", 1)


def month_of_str(snapshot: str) -> str:
    """A2 for a literal parameter (job arguments are plain strings)."""
    parts = snapshot.split("-")
    return "-".join(parts[:2])


def label_language(wiki_db) -> Column:
    """A3: shortest prefix before ``wiki`` (``zh_min_nanwiki`` -> ``zh_min_nan``)."""
    return F.regexp_extract(_c(wiki_db), r"^(.+?)(?=wiki)", 1)


def icon_threshold(size) -> Column:
    """B2: per-wiki icon threshold from the number of articles."""
    size = _c(size).cast("double")
    base, th, lim = float(K.ICON_BASE_SIZE), float(K.ICON_THRESHOLD), float(K.ICON_LIMIT)
    return (
        F.when(size >= F.lit(base), (F.log10(size / F.lit(base)) + F.lit(1.0)) * F.lit(th))
        .otherwise(F.greatest(size / F.lit(base) * F.lit(th), F.lit(th / lim)))
    )


def is_valid_image_name(name) -> Column:
    """Lower-cased name contains none of the blocked substrings."""
    low = F.lower(_c(name))
    hits = [low.contains(s) for s in dict.fromkeys(K.INVALID_IMAGE_SUBSTRINGS)]
    return ~reduce(lambda a, b: a | b, hits)


def numeric_instance_id(instanceof) -> Column:
    """``numeric-id`` of the P31 JSON value (NULL when absent or malformed)."""
    return F.from_json(_c(instanceof), INSTANCE_OF_DDL).getField("numeric-id")


def item_image_name(hasimage) -> Column:
    """The P18 JSON string with its outer quotes removed by position."""
    v = _c(hasimage)
    return F.substring(v, F.lit(2), F.greatest(F.length(v) - F.lit(2), F.lit(0)))


def confidence_rating(rating="rating") -> Column:
    """Integer part of the rating -> high / medium / low, else NULL."""
    r = _c(rating).cast("int")
    expr = None
    for value, label in K.CONFIDENCE_BY_INT_RATING:
        expr = F.when(r == value, F.lit(label)) if expr is None else expr.when(r == value, F.lit(label))
    return expr


def source_of(note="note") -> Column:
    """Source name by note prefix, else NULL."""
    n = _c(note)
    expr = None
    for prefix, label in K.SOURCE_PREFIXES:
        cond = n.startswith(prefix)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def instance_of_id(instance_of="instance_of") -> Column:
    """``id`` field of the P31 JSON; NULL for NULL or malformed input."""
    return F.get_json_object(_c(instance_of), "$.id")


def found_on(note="note") -> Column:
    """Wikis listed in a note; a note without a list, or with a line break within it, gives [''] (size 1), NULL stays NULL."""
    listed = F.regexp_extract(_c(note), K.FOUND_ON_REGEX, 1)
    return F.split(F.translate(listed, " \t\n\u000b\f\r", ""), ",")


def is_article_page(instance_id="instance_of") -> Column:
    """FALSE iff the parsed instance id is a non-article class; NULL -> TRUE."""
    return F.when(_c(instance_id).isin(*K.NON_ARTICLE_QIDS), F.lit(False)).otherwise(F.lit(True))


def md5_bigint(*parts) -> Column:
    """Deterministic 60-bit draw value from an md5 prefix (same value in Spark and DuckDB)."""
    s = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")


def image_page_url(image, language) -> Column:
    """Commons file page URL in the given interface language."""
    return F.concat(F.lit(K.COMMONS_FILE_URL), F.regexp_replace(_c(image), " ", "_"),
                    F.lit("?uselang="), _c(language))


def image_extension(name) -> Column:
    """text after the last dot; the whole name when there is none."""
    return F.substring_index(_c(name), ".", -1)


def wiki_direction(wiki_db) -> Column:
    """F8: rtl for the right-to-left wikis, else ltr."""
    return F.when(_c(wiki_db).isin(*K.RTL_WIKIS), F.lit("rtl")).otherwise(F.lit("ltr"))
