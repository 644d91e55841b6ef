"""Dataset metrics and validation checks (E1-E22) as typed DataFrames.

Statistics that the original computed in pandas on the driver are aggregations here. Exact quantiles go
through ``percentile`` with a frequency column over a value histogram, so the aggregation buffer is bounded
by the number of distinct values, not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from picsel.constants import TOP_K
from picsel.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def _snap(df: DataFrame, snapshot: str | None) -> DataFrame:
    return df if snapshot is None else df.where(F.col("snapshot") == snapshot)


def records_per_wiki(prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Production rows per wiki and snapshot."""
    return _snap(prod, snapshot).groupBy("wiki", "snapshot").agg(F.count(F.lit(1)).alias("n_records"))


def _histogram(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("f"))


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max of a column.

    One partial aggregation; the quantile buffer holds one entry per distinct value.
    """
    q = F.percentile(F.col(value), F.array(*[F.lit(x) for x in QUARTILES]))
    return df.where(F.col(value).isNotNull()).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
        F.max(value).cast("double").alias("max"))


def median(df: DataFrame, value: str) -> DataFrame:
    """E3 / E17 (exact): the median of a column."""
    h = _histogram(df.where(F.col(value).isNotNull()), value)
    return h.agg(F.percentile(F.col("v"), F.lit(0.5), F.col("f")).alias("median"))


#: Size k of a quantile sketch, and a rank error it keeps with 99 % probability (2.296 / k ** 0.9723 = 0.0035 by DataSketches' estimate).
SKETCH_SIZE, SKETCH_ERROR = 800, 0.004


def quantile_sketches(df: DataFrame, value: str, by: tuple[str, ...]) -> DataFrame:
    """E17 (approximate), stored part: a mergeable quantile sketch of a bigint column for each group of ``by`` (a few KB each)."""
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), SKETCH_SIZE).alias("sketch"))


def merged_quantile(sketches: DataFrame, q: float, by: tuple[str, ...] = ()) -> DataFrame:
    """E17 (approximate): the ``q`` quantile over all rows of the merged sketches, per group of ``by``; no data is read again."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return merged.where(F.kll_sketch_get_n_bigint("sketch") > 0).select(*by, F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias("approx"), F.lit(q).alias("q"))


def checked_quantile(approx: DataFrame, df: DataFrame, value: str, error: float) -> DataFrame:
    """The approximate quantile with its exact rank interval over ``df`` (share of smaller rows, share of rows up to it) and
    whether the interval comes within ``error`` of the wanted rank. ``approx`` is one row."""
    h = _histogram(df.where(F.col(value).isNotNull()), value).join(F.broadcast(approx), F.lit(True))
    weigh = lambda cond: F.sum(F.when(cond, F.col("f")).otherwise(0))
    out = h.groupBy("approx", "q").agg(weigh(F.col("v") < F.col("approx")).alias("less"), weigh(F.col("v") <= F.col("approx")).alias("to"), F.sum("f").alias("n"))
    below, to = F.col("less") / F.col("n"), F.col("to") / F.col("n")
    return out.select("approx", below.alias("rank_below"), to.alias("rank_to"), "n", ((below <= F.col("q") + error) & (to >= F.col("q") - error)).alias("within_bound"))


def approx_median(df: DataFrame, value: str, relative_error: float = 0.25) -> DataFrame:
    """E17 as written originally: an approximate median with the given relative rank error."""
    accuracy = max(1, int(round(1.0 / relative_error))) if relative_error > 0 else 10000
    return df.agg(F.percentile_approx(value, 0.5, accuracy).alias("approx_median"))


def modes(df: DataFrame, value: str) -> DataFrame:
    """Every most frequent value (all ties), ascending."""
    h = _histogram(df.where(F.col(value).isNotNull()), value)
    top = h.agg(F.max("f").alias("f"))
    return h.join(top, "f").select(F.col("v").alias("mode")).orderBy("mode")


def images_per_page(prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """E5: rows per page (a page without suggestions counts 1)."""
    return _snap(prod, snapshot).groupBy("wiki", "page_id").agg(F.count(F.lit(1)).alias("n_images"))


def suggestion_histogram(prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Number of pages by number of rows."""
    return images_per_page(prod, snapshot).groupBy("n_images").agg(F.count(F.lit(1)).alias("n_pages"))


def suggestion_histogram_pct(prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """E6p: share of pages per bucket in percent, two decimals (the histogram has at most k+1 rows)."""
    h = suggestion_histogram(prod, snapshot)
    return h.withColumn("pct", F.round(F.lit(100.0) * F.col("n_pages") / F.sum("n_pages").over(Window.partitionBy()), 2))


def suggestions_by_confidence(prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Rows per wiki and confidence rating (NULL = no suggestion)."""
    return _snap(prod, snapshot).groupBy("wiki", "confidence_rating").agg(F.count(F.lit(1)).alias("n_suggestions"))


def oversuggested_pages(prod: DataFrame, snapshot: str | None = None, k: int = TOP_K) -> DataFrame:
    """All rows of pages with more than k rows (expected empty). Window per page: bounded."""
    p = _snap(prod, snapshot)
    return (
        p.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("wiki", "page_id")))
        .where(F.col("_n") > k).drop("_n")
    )


def raw_records_per_wiki(raw: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Raw rows per wiki and snapshot."""
    return _snap(raw, snapshot).groupBy("wiki_db", "snapshot").agg(F.count(F.lit(1)).alias("n_raw_records"))


def raw_vs_final(raw: DataFrame, prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """E9 inner join E1 on (wiki, snapshot)."""
    r = raw_records_per_wiki(raw, snapshot).withColumnRenamed("wiki_db", "wiki")
    return r.join(records_per_wiki(prod, snapshot), ["wiki", "snapshot"])


def instance_of_coverage(raw: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Per wiki and snapshot, rows with and without instance_of."""
    return _snap(raw, snapshot).groupBy("wiki_db", "snapshot").agg(
        F.count("instance_of").alias("with_instance_of"),
        F.count(F.when(F.col("instance_of").isNull(), 1)).alias("without_instance_of"),
    )


def redirects_in_dataset(raw: DataFrame, page: DataFrame, since: str) -> DataFrame:
    """Per snapshot, raw rows whose page is a redirect (expected none)."""
    r = raw.where((F.col("wiki_db") != "") & (F.col("snapshot") >= since)).select(
        "wiki_db", F.col("page_id").cast("string").alias("pid"), "snapshot")
    p = page.where(F.col("page_is_redirect") == 1).select(
        "wiki_db", F.col("page_id").cast("string").alias("pid"), "snapshot")
    return r.join(p, ["wiki_db", "pid", "snapshot"]).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("page_redirect"))


def filtered_out_records(prod: DataFrame) -> DataFrame:
    """Per wiki and snapshot, article rows and rows filtered out as non-articles."""
    a = F.col("is_article_page")
    return prod.groupBy("wiki", "snapshot").agg(
        F.sum(F.when(a == F.lit(True), 1).otherwise(0)).cast("bigint").alias("n_final"),
        F.sum(F.when(a == F.lit(False), 1).otherwise(0)).cast("bigint").alias("n_filtered_out"),
    )


def found_on_sizes(prod: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Distinct (wiki, page, found_on) of wikipedia-sourced rows with the number of wikis."""
    p = _snap(prod, snapshot).where((F.col("wiki") != "") & (F.col("source") == "wikipedia"))
    return p.groupBy("wiki", "page_id", "found_on").agg(F.size("found_on").alias("num_languages"))


def found_on_histogram(sizes: DataFrame) -> DataFrame:
    """E14 rows per number of wikis."""
    return sizes.groupBy("num_languages").agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Quartiles, IQR, 1.5 IQR whiskers (most extreme values inside the fences), outlier count; per group of ``by``."""
    keys = list(by) or ["_all"]
    rows = df.where(F.col(value).isNotNull()).withColumn("_all", F.lit(1))
    h = rows.groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("f"))
    q = h.groupBy(*keys).agg(F.percentile(F.col("v"), F.array(*[F.lit(x) for x in QUARTILES]), F.col("f")).alias("q"))
    q = q.select(*keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi = F.col("q3") + F.lit(1.5) * F.col("iqr")
    v = F.col("v").cast("double")
    # histograms and quartiles have a row per group (and value), far fewer than the data
    out = h.join(q, keys).groupBy(*keys, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= lo, v)).alias("lower_whisker"),
        F.max(F.when(v <= hi, v)).alias("upper_whisker"),
        F.coalesce(F.sum(F.when((v < lo) | (v > hi), F.col("f"))), F.lit(0)).cast("bigint").alias("n_outliers"),
    )
    return out if by else out.drop("_all")


def snapshot_counts(prod: DataFrame) -> DataFrame:
    """Rows per snapshot and wiki, latest snapshot first."""
    return prod.groupBy("snapshot", "wiki").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("snapshot"), "wiki")


def column_frequencies(df: DataFrame) -> DataFrame:
    """Value counts of every column in one pass, most frequent first within a column.

    Values are kept apart exactly: NULL stays NULL, an array is its JSON text, a double its shortest exact text.
    """
    return _long(df, df.columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")).orderBy("column", F.desc("count"), "value")


CONFIDENCE_BY_SOURCE = (("wikidata", "high"), ("wikipedia", "medium"), ("commons", "low"))


def confidence_source_matrix(prod: DataFrame) -> DataFrame:
    """Rows per (confidence_rating, source)."""
    return prod.groupBy("confidence_rating", "source").agg(F.count(F.lit(1)).alias("n"))


def confidence_violations(prod: DataFrame) -> DataFrame:
    """E21 rule: rows whose confidence does not match their source (expected 0)."""
    ok = None
    for src, conf in CONFIDENCE_BY_SOURCE:
        cond = (F.col("source") == src) & (F.col("confidence_rating") == conf)
        ok = cond if ok is None else ok | cond
    ok = ok | (F.col("source").isNull() & F.col("confidence_rating").isNull())
    return prod.agg(F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias("n_violations"))


def no_recommendation_check(prod: DataFrame) -> DataFrame:
    """Pages without recommendation, and such rows that wrongly carry a confidence (expected 0)."""
    no_src = F.col("source").isNull()
    return prod.agg(
        F.count(F.when(F.col("image_id").isNull(), 1)).alias("n_no_recommendation"),
        F.count(F.when(no_src & F.col("confidence_rating").isNotNull(), 1)).alias("n_bad_confidence"),
    )


# --------------------------------------------------------------------------------------------------
# E20 for near-unique columns: the most frequent values by a sketch and an exact second pass
# --------------------------------------------------------------------------------------------------

#: Values of a column that a sketch tracks. It finds every value with more than ``2 * 3.5 / MAP`` of the rows, where ``MAP`` is the
#: power of two from ``TRACKED / 0.75`` on (DataSketches' a-priori error, once for the estimate and once for what it lists).
TRACKED = 3072
MISSED = 2 * 3.5 / 4096


def _as_text(df: DataFrame) -> dict[str, F.Column]:
    """Each column as exact text: an array is its JSON text, a double its shortest exact text, NULL stays NULL."""
    nested = ("array", "map", "struct")
    return {f.name: F.to_json(F.col(f"`{f.name}`")) if f.dataType.typeName() in nested else F.col(f"`{f.name}`").cast("string") for f in df.schema.fields}


def value_sketches(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A mergeable sketch of the frequent values of each column (columns named like those of ``df``) and the rows ``_n``, per group of ``by``.

    A value carries a letter in front, so that NULL is counted like any other.
    """
    marked = [F.coalesce(F.concat(F.lit("v"), c), F.lit("n")).alias(n) for n, c in _as_text(df).items()]
    rows = df.select(*[F.col(b).alias(f"_by_{b}") for b in by], *marked)
    sketches = [F.call_function("approx_top_k_accumulate", F.col(f"`{n}`"), F.lit(TRACKED)).alias(n) for n in df.columns]
    # grouped even without ``by``: Spark can't merge the sketch of a task that had no row, and a group has one
    return rows.groupBy(F.lit(0).alias("_all"), *[f"_by_{b}" for b in by]).agg(*sketches, F.count(F.lit(1)).alias("_n"))


def likely_values(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value`` of the values that the merged sketches list: at most ``TRACKED`` a column."""
    merged = sketches.groupBy("_all").agg(*[F.call_function("approx_top_k_combine", F.col(f"`{n}`"), F.lit(TRACKED)).alias(n) for n in columns])
    listed = F.array(*[F.struct(F.lit(n).alias("column"), F.transform(F.call_function("approx_top_k_estimate", F.col(f"`{n}`"), F.lit(TRACKED)), lambda x: x["item"]).alias("items"))
                       for n in columns])
    rows = merged.select(F.explode(listed).alias("c")).select("c.column", F.explode("c.items").alias("item"))
    return rows.select("column", F.when(F.col("item") != "n", F.substring("item", 2, 1 << 30)).alias("value"))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    text = _as_text(df)
    return df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column"), text[n].alias("value")) for n in columns])).alias("c")).select("c.*")


def top_values(df: DataFrame, k: int = 10, by: tuple[str, ...] = ()) -> DataFrame:
    """E20 as a report: the ``k`` most frequent values of each column with exact counts (ties by value, NULL first).

    A sketch pass names the likely values, a second pass counts just those, without a shuffle of the data. Where the k-th count is
    above what the sketch can have missed, or the sketch holds all values of the column, that is the answer. The other columns, near-unique ones, are counted whole
    by a group-by; their rows are never sorted. Sketches are kept per group of ``by`` and merged.
    """
    sketches = materialize(value_sketches(df, by), name="value-sketches")
    likely = materialize(likely_values(sketches, df.columns), name="likely-values")  # TRACKED rows a column at most
    same = (F.col("l.column") == F.col("r.column")) & F.col("l.value").eqNullSafe(F.col("r.value"))
    counted = _long(df, df.columns).alias("l").join(F.broadcast(likely.alias("r")), same, "left_semi").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    counted = materialize(counted, name="counted-values")
    rows = sketches.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.col("value").asc_nulls_first())
    first = lambda c: c.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    kth = F.max(F.when(F.col("place") == k, F.col("count"))).alias("kth")
    checks = counted.withColumn("place", F.row_number().over(order)).groupBy("column").agg(F.sum("count").alias("covered"), kth)
    proven = [r["column"] for r in checks.collect() if r["covered"] == rows or (r["kth"] or 0) > MISSED * rows]  # a row a column
    out = first(counted.where(F.col("column").isin(proven)))
    rest = [c for c in df.columns if c not in proven]
    if rest and rows:
        out = out.unionByName(first(_long(df, rest).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))))
    return out
