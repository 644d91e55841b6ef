"""Query registry: one Spark query per operator and the matching DuckDB SQL oracle.

Every query reads the supplied tables through the stand-in views, over whole tables. Results are made
comparable: arrays become JSON text, doubles are rounded to 6 digits, integer columns are bigint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from picsel import constants as K
from picsel.functions import columns as C
from picsel.operators import manifest as Mf
from picsel.operators import metric_state as Ms
from picsel.operators import metrics as E
from picsel.operators import page_metadata as M
from picsel.operators import pool as P
from picsel.operators import publish as D
from picsel.operators import rejects as R
from picsel.operators import selection as S
from picsel.operators import serving as V
from picsel.plans import oracle as O
from picsel.plans.recommend import RecommendationRun
from picsel.schemas import TOP_CANDIDATES_DDL
from picsel.session import application_id, materialize, stage_root
from picsel.sources.readers import (read_partitioned_tsv, read_raw_parquet, read_snapshot_table, scan_for_wikis, snapshot_scan, target_wikis,
                                    wiki_table, write_snapshot_table)
from picsel.sources.standins import MONTH, StandIns

_RUNS: dict[tuple[str, str], RecommendationRun] = {}


def run_for(spark: SparkSession, sf_dir: str) -> RecommendationRun:
    """One staged run per (application, data folder); its checkpoints are shared by all queries."""
    key = (application_id(spark), sf_dir)
    if key not in _RUNS:
        _RUNS[key] = RecommendationRun.standin(spark, sf_dir)
    return _RUNS[key]


def comparable(df: DataFrame) -> DataFrame:
    """Arrays -> JSON text, doubles rounded to 6 digits, integers -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.ArrayType):
            c = F.to_json(c)
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_PRODUCTION: dict[int, DataFrame] = {}


def _prod(run: RecommendationRun) -> DataFrame:
    """The run's production table, staged once for all metrics."""
    if id(run) not in _PRODUCTION:
        _PRODUCTION[id(run)] = materialize(run.production_table(O.DATASET_ID, O.INSERTION_TS), name="production")
    return _PRODUCTION[id(run)]


def _docs_prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.production_rows(StandIns(spark, sf_dir).raw_from_documents)
    return D.production_table(rows, MONTH, O.DATASET_ID, O.INSERTION_TS)


def _with_found_on_size(df: DataFrame) -> DataFrame:
    return df.withColumn("n_found_on", F.size("found_on"))


# ------------------------------------------------------------------------------------------------------
# Spark queries
# ------------------------------------------------------------------------------------------------------

def _q_snapshot_scan(spark, sf):
    src = StandIns(spark, sf)
    return snapshot_scan(src.page, MONTH, ["enwiki", "arwiki"]).select(
        "wiki_db", "page_id", "page_title", "page_namespace", "page_is_redirect")


def _q_snapshot_scan_pruned(spark, sf):
    """Two snapshots of the page table written by partition; one is read, for the target wikis that are written left to right."""
    path, page = _out(spark, "page"), StandIns(spark, sf).page
    write_snapshot_table(page.unionByName(page.withColumn("snapshot", F.lit("2020-12"))), path)
    ltr = wiki_table(spark).where(F.col("direction") == "ltr")
    return scan_for_wikis(read_snapshot_table(spark, path, page.schema), MONTH, ltr)


def _q_month_of(spark, sf):
    dates = StandIns(spark, sf).table("orders").select(F.col("o_orderdate").cast("date").cast("string").alias("snapshot")).distinct()
    return dates.select("snapshot", C.month_of("snapshot").alias("month"))


def _q_label_language(spark, sf):
    src = StandIns(spark, sf)
    return src.page.select("wiki_db").distinct().select(
        "wiki_db", C.label_language("wiki_db").alias("lang"), C.wiki_direction("wiki_db").alias("direction"))


def _q_target_wikis(spark, sf):
    return target_wikis(_with_found_on_size(run_for(spark, sf).production_rows()), col="wiki")


def _t(run):
    return run.tables


def _q_wiki_size(spark, sf):
    return P.wiki_size(_t(run_for(spark, sf)).page)


def _q_icon_thresholds(spark, sf):
    return P.icon_thresholds(P.wiki_size(_t(run_for(spark, sf)).page))


def _q_icon_images(spark, sf):
    return run_for(spark, sf).icons.select("wiki_db", "il_to", "n_links")


def _q_pages_with_images(spark, sf):
    run = run_for(spark, sf)
    return P.pages_with_images(_t(run).imagelinks, run.icons)


def _q_pages_with_lead_image(spark, sf):
    return P.pages_with_lead_image(_t(run_for(spark, sf)).page_props)


def _q_illustrated_pages(spark, sf):
    return run_for(spark, sf).illustrated


def _q_unillustrated_pages(spark, sf):
    return run_for(spark, sf).unillustrated


def _q_item_claims(spark, sf):
    return run_for(spark, sf).claims


def _q_item_claims_flat(spark, sf):
    run = run_for(spark, sf)
    t = _t(run)
    return P.item_claims_flat(t.claims_flat, t.labels_flat, run.unillustrated)


def _q_placeholder_images(spark, sf):
    t = _t(run_for(spark, sf))
    return P.placeholder_images(t.categorylinks, t.page, t.placeholder_category)


def _q_category_images(spark, sf):
    return run_for(spark, sf).pool.category_files


def _q_items_with_category_images(spark, sf):
    run = run_for(spark, sf)
    return P.items_with_category_images(run.claims, run.pool.category_files)


def _q_numbered_category_images(spark, sf):
    return run_for(spark, sf).numbered_category_images


def _q_lead_images_elsewhere(spark, sf):
    return run_for(spark, sf).pool.lead_images.select("wiki_db", "item_id", "page_id", "src_wiki", "image")


def _q_candidate_pool(spark, sf):
    return run_for(spark, sf).pool_rows()


def _q_pool_coverage(spark, sf):
    return P.pool_coverage(run_for(spark, sf).pool_rows())


def _q_with_any_source(spark, sf):
    return P.with_any_source(run_for(spark, sf).pool_rows())


def _eligible_leads(run):
    return run.eligible_leads


def _q_is_valid_image_name(spark, sf):
    run = run_for(spark, sf)
    return run.pool.lead_images.select("image").distinct().select(
        "image", C.is_valid_image_name("image").alias("is_valid"))


def _q_excluded_pages(spark, sf):
    run = run_for(spark, sf)
    return run.pool.pages.where(S.excluded_instance("instanceof")).select("wiki_db", "page_id", "instanceof")


def _q_images_by_wiki(spark, sf):
    return S.images_by_wiki(_eligible_leads(run_for(spark, sf)))


def _q_rank_lead_images(spark, sf):
    return run_for(spark, sf).ranked_leads


def _q_draw_category_images(spark, sf):
    run = run_for(spark, sf)
    return S.draw_category_images(S.eligible_pages(run.pool.pages), run.pool.category_files, K.DEFAULT_DRAW_SEED,
                                  run.numbered_category_images)


def _q_item_image_candidates(spark, sf):
    return S.item_image_candidates(S.eligible_pages(run_for(spark, sf).pool.pages))


def _q_merge_sources(spark, sf):
    return run_for(spark, sf).merged()


def _q_top_candidates(spark, sf):
    return run_for(spark, sf).top_candidates()


def _q_candidates_table(spark, sf):
    c = run_for(spark, sf).candidates
    return c.select(
        "wiki_db", "item_id", "page_id", "page_title", "instanceof",
        F.size("top_candidates").alias("n_candidates"),
        F.when(F.col("top_candidates").isNotNull(),
               F.concat_ws(",", F.transform("top_candidates", lambda s: s["image"]))).alias("images"),
    )


def _q_explode_candidates(spark, sf):
    raw = StandIns(spark, sf).raw_from_documents
    return D.explode_candidates(raw).select("wiki_db", "page_id", "image", "rating", "note")


def _q_production_rows(spark, sf):
    return _with_found_on_size(run_for(spark, sf).production_rows())


def _q_production_rows_docs(spark, sf):
    return _with_found_on_size(D.production_rows(StandIns(spark, sf).raw_from_documents))


def _q_candidate_note_fields(spark, sf):
    top = run_for(spark, sf).top_candidates()
    return top.select("rating", "note").distinct().select(
        "rating", "note", C.confidence_rating("rating").alias("confidence_rating"),
        C.source_of("note").alias("source"), C.found_on("note").alias("found_on"),
        F.size(C.found_on("note")).alias("n_found_on"))


def _q_production_table(spark, sf):
    return _prod(run_for(spark, sf))


def _q_search_table(spark, sf):
    return D.search_table(_prod(run_for(spark, sf)), O.SEARCH_DATE, MONTH)


def _q_export_canonical(spark, sf):
    return D.export_rows(_prod(run_for(spark, sf)), MONTH)


def _q_export_android(spark, sf):
    return D.export_rows(_prod(run_for(spark, sf)), MONTH, android=True)


def _q_export_summary(spark, sf):
    return D.export_summary(D.export_rows(_prod(run_for(spark, sf)), MONTH))


def _q_serving_table(spark, sf):
    return D.serving_table(D.export_rows(_prod(run_for(spark, sf)), MONTH))


def _p(spark, sf):
    return _prod(run_for(spark, sf))


def _q_records_per_wiki(spark, sf):
    return E.records_per_wiki(_p(spark, sf), MONTH)


def _q_population_stats(spark, sf):
    return E.describe(E.records_per_wiki(_p(spark, sf), MONTH), "n_records")


def _q_population_median(spark, sf):
    return E.median(E.records_per_wiki(_p(spark, sf), MONTH), "n_records")


def _q_population_modes(spark, sf):
    return E.modes(E.images_per_page(_p(spark, sf), MONTH), "n_images")


def _q_population_modes_docs(spark, sf):
    return E.modes(E.records_per_wiki(_docs_prod(spark, sf), MONTH), "n_records")


def _q_images_per_page(spark, sf):
    return E.images_per_page(_p(spark, sf), MONTH)


def _q_suggestion_histogram(spark, sf):
    return E.suggestion_histogram(_p(spark, sf), MONTH)


def _q_suggestion_histogram_pct(spark, sf):
    return E.suggestion_histogram_pct(_p(spark, sf), MONTH)


def _q_suggestions_by_confidence(spark, sf):
    return E.suggestions_by_confidence(_p(spark, sf), MONTH)


def _q_oversuggested_pages(spark, sf):
    return E.oversuggested_pages(_p(spark, sf), MONTH)


def _q_oversuggested_pages_k1(spark, sf):
    return E.oversuggested_pages(_p(spark, sf), MONTH, k=1)


def _q_raw_records_per_wiki(spark, sf):
    return E.raw_records_per_wiki(run_for(spark, sf).raw, MONTH)


def _q_raw_vs_final(spark, sf):
    run = run_for(spark, sf)
    return E.raw_vs_final(run.raw, _prod(run), MONTH)


def _q_instance_of_coverage(spark, sf):
    return E.instance_of_coverage(run_for(spark, sf).raw, MONTH)


def _q_redirects_in_dataset(spark, sf):
    run = run_for(spark, sf)
    return E.redirects_in_dataset(run.raw, run.tables.page, MONTH)


def _q_redirects_in_pages(spark, sf):
    """E12 over a raw table of all pages, redirects included."""
    page = run_for(spark, sf).tables.page
    return E.redirects_in_dataset(page.select("wiki_db", F.col("page_id").cast("string").alias("page_id"), "snapshot"), page, MONTH)


def _q_filtered_out_records(spark, sf):
    return E.filtered_out_records(_p(spark, sf))


def _q_found_on_sizes(spark, sf):
    return E.found_on_sizes(_p(spark, sf), MONTH)


def _q_found_on_histogram(spark, sf):
    return E.found_on_histogram(E.found_on_sizes(_p(spark, sf), MONTH))


def _q_found_on_describe(spark, sf):
    d = E.describe(E.found_on_sizes(_p(spark, sf), MONTH), "num_languages")
    return d.select("count", "mean", "std", "min", "max")


def _q_found_on_median(spark, sf):
    return E.median(E.found_on_sizes(_p(spark, sf), MONTH), "num_languages")


def _q_found_on_approx_median(spark, sf):
    """The approximate median by sketches kept per wiki and snapshot, its exact rank interval, and whether that is within the bound."""
    sizes = E.found_on_sizes(_p(spark, sf), MONTH)
    parts = materialize(E.quantile_sketches(sizes.withColumn("snapshot", F.lit(MONTH)), "num_languages", ("wiki", "snapshot")), name="sketches")
    return E.checked_quantile(E.merged_quantile(parts, 0.5), sizes, "num_languages", E.SKETCH_ERROR)


def _q_box_stats_records(spark, sf):
    return E.box_stats(E.images_per_page(_p(spark, sf), MONTH), "n_images")


def _q_box_stats_population(spark, sf):
    return E.box_stats(E.records_per_wiki(_p(spark, sf), MONTH), "n_records")


def _q_box_stats_found_on(spark, sf):
    return E.box_stats(E.found_on_sizes(_p(spark, sf), MONTH), "num_languages", by=("wiki",))


def _q_snapshot_counts(spark, sf):
    return E.snapshot_counts(_p(spark, sf))


def _q_column_frequencies(spark, sf):
    return E.column_frequencies(_p(spark, sf))


def _q_top_values(spark, sf):
    """The ten most frequent values of each production column, by sketches kept per snapshot."""
    return E.top_values(_p(spark, sf), 10, ("snapshot",))


def _q_confidence_source_matrix(spark, sf):
    return E.confidence_source_matrix(_p(spark, sf))


def _q_confidence_violations(spark, sf):
    return E.confidence_violations(_p(spark, sf))


def _q_no_recommendation_check(spark, sf):
    return E.no_recommendation_check(_p(spark, sf))


def _q_sample_pages(spark, sf):
    return M.sample_pages(run_for(spark, sf).raw, n=K.METADATA_SAMPLE_SIZE, seed=K.DEFAULT_DRAW_SEED).select(
        "wiki_db", "page_id", "item_id")


def _q_distinct_candidate_images(spark, sf):
    return M.distinct_candidate_images(run_for(spark, sf).raw)


def _q_candidate_image_pages(spark, sf):
    return M.candidate_image_pages(M.distinct_candidate_images(run_for(spark, sf).raw))


def _q_image_metadata(spark, sf):
    run = run_for(spark, sf)
    return M.image_metadata(M.candidate_image_pages(M.distinct_candidate_images(run.raw)), StandIns(spark, sf).file_pages)


def _fields(spark, sf):
    pages = StandIns(spark, sf).file_pages
    return M.page_fields(pages.withColumnsRenamed({"lang": "language", "dir": "direction"}))


def _q_page_description(spark, sf):
    return _fields(spark, sf).select("file_key", "language", "description")


def _q_page_caption(spark, sf):
    return _fields(spark, sf).select("file_key", "language", "caption")


def _q_page_depicts(spark, sf):
    return _fields(spark, sf).select("file_key", "language", "depicts", "licence")


# -- sinks, read back ------------------------------------------------------------------------------------

def _out(spark, name):
    return f"{stage_root(spark)}/published-{name}-{uuid.uuid4().hex}"


def _listed_candidates(raw):
    """The rows of a raw table with one row for each candidate in their text, in its order; one without for the others."""
    rows = raw.select(*[c for c in raw.columns if c != "top_candidates"], F.posexplode_outer(F.from_json("top_candidates", TOP_CANDIDATES_DDL)).alias("place", "c"))
    return rows.select(*rows.columns[:-1], "c.image", "c.rating", "c.note")


def _q_published_candidates(spark, sf):
    path, raw = _out(spark, "candidates"), run_for(spark, sf).raw
    D.write_candidates(raw, path)
    return _listed_candidates(read_partitioned_tsv(spark, path, MONTH))


def _q_published_raw(spark, sf):
    path, raw = _out(spark, "raw"), run_for(spark, sf).raw
    D.publish_raw(raw, path)
    return _listed_candidates(read_raw_parquet(spark, path))


def _q_published_production(spark, sf):
    path, prod = _out(spark, "production"), _p(spark, sf)
    D.publish_production(prod, path)
    return spark.read.schema(prod.schema).parquet(path)


def _q_published_search(spark, sf):
    path = _out(spark, "search")
    search = D.search_table(_p(spark, sf), O.SEARCH_DATE, MONTH)
    D.publish_search(search, path)
    return spark.read.schema(search.schema).parquet(path)


def _read_exports(spark, path, exports):
    back = spark.read.schema(exports.schema).options(sep="\t", header="true", quote="\u0000", nullValue="\\N", emptyValue="").csv(path)
    return back.fillna("", subset=["image_id", "confidence_rating", "source", "found_on"]).select(*exports.columns)


def _q_published_canonical(spark, sf):
    path, exports = _out(spark, "canonical"), D.export_rows(_p(spark, sf), MONTH)
    D.write_exports(exports, path)
    return _read_exports(spark, path, exports)


def _q_published_android(spark, sf):
    path, exports = _out(spark, "android"), D.export_rows(_p(spark, sf), MONTH, android=True)
    D.write_exports(exports, path)
    return _read_exports(spark, path, exports)


def _q_published_serving(spark, sf):
    path, serving = _out(spark, "serving"), D.serving_table(D.export_rows(_p(spark, sf), MONTH))
    V.write_serving(serving, path)
    return spark.read.schema(serving.schema).parquet(path)


def _q_published_manifest(spark, sf):
    """The production table published whole, then one wiki again with its images only; read through the manifest."""
    path, prod = _out(spark, "committed"), _p(spark, sf)
    title = [F.col("page_title").desc()]
    Mf.publish(prod, path, ["wiki", "snapshot"], ["page_id"], title)
    Mf.publish(prod.where((F.col("wiki") == "enwiki") & F.col("image_id").isNotNull()), path, ["wiki", "snapshot"], ["page_id"], title)
    return Mf.read(spark, path, prod.schema)


def _q_candidate_rejects(spark, sf):
    """Every line of candidate files with good and bad lines: accepted, or rejected with a reason."""
    path = _out(spark, "lines")
    StandIns(spark, sf).candidate_lines.write.partitionBy("wiki_db").text(path)
    rows = R.read_judged_tsv(spark, path, MONTH, header=False)
    columns = ["wiki_db", "page_id", "page_title", "top_candidates"]
    good = R.accepted(rows).select(*columns, F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(R.rejected(rows).select(*columns, "line", "reason"))


def _q_metric_state(spark, sf):
    """Reports of two snapshots from the state kept for each; the older one holds the rows that have an image."""
    path, table = _out(spark, "state"), _out(spark, "production")
    prod = _p(spark, sf)
    D.publish_production(prod.unionByName(prod.where(F.col("image_id").isNotNull()).withColumn("snapshot", F.lit("2020-12"))), table)
    back = spark.read.schema(prod.schema).parquet(table)
    for snapshot in ("2020-12", MONTH):
        Ms.update(back, path, snapshot)
    report = lambda name, df, key, n: df.select(F.lit(name).alias("report"), "snapshot", F.col("wiki") if "wiki" in df.columns else F.lit(None).cast("string").alias("wiki"),
                                                F.col(key).cast("string").alias("key") if key else F.lit(None).cast("string").alias("key"), F.col(n).alias("n"))
    reports = [report("records", Ms.snapshot_counts(spark, path), None, "n"), report("histogram", Ms.suggestion_histogram(spark, path), "n_images", "n_pages"),
               report("confidence", Ms.suggestions_by_confidence(spark, path), "confidence_rating", "n_suggestions"),
               report("found_on", Ms.found_on_histogram(spark, path), "num_languages", "n")]
    return reduce(DataFrame.unionByName, reports)


def _q_serving_lookup(spark, sf):
    """Every 50th page, looked up in the written serving table."""
    path, page = _out(spark, "serving"), run_for(spark, sf).tables.page
    V.write_serving(D.serving_table(D.export_rows(_p(spark, sf), MONTH)), path)
    keys = page.where(F.col("page_id") % 50 == 0).select(F.col("wiki_db").alias("wiki"), "page_id")
    return V.lookup(V.read_serving(spark, path), keys)


def _q_registered_tables(spark, sf):
    run, prod = run_for(spark, sf), _p(spark, sf)
    raw, production, search, db = _out(spark, "raw"), _out(spark, "production"), _out(spark, "search"), f"picsel_{uuid.uuid4().hex}"
    D.publish_raw(run.raw, raw)
    D.publish_production(prod, production)
    D.publish_search(D.search_table(prod, O.SEARCH_DATE, MONTH), search)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{_out(spark, 'database')}'")
    D.register_tables(spark, raw, production, search, database=db)
    columns = {"imagerec": ("wiki_db", "page_id", "page_title", "instance_of"), "imagerec_prod": ("wiki", "page_id", "page_title", "image_id"),
               "search_imagerec": ("wikiid", "page_id", F.lit(None), "recommendation_type")}
    rows = [spark.table(f"{db}.{t}").select(F.lit(t), *c).toDF("table_name", "wiki", "page_id", "page_title", "value").withColumn("page_id", F.col("page_id").cast("string"))
            for t, c in columns.items()]
    out = materialize(reduce(DataFrame.unionByName, rows), name="registered")
    spark.sql(f"DROP DATABASE {db} CASCADE")  # the tables are external: their files stay
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "snapshot_scan": _q_snapshot_scan,
    "snapshot_scan_pruned": _q_snapshot_scan_pruned,
    "month_of": _q_month_of,
    "label_language": _q_label_language,
    "target_wikis": _q_target_wikis,
    "wiki_size": _q_wiki_size,
    "icon_thresholds": _q_icon_thresholds,
    "icon_images": _q_icon_images,
    "pages_with_images": _q_pages_with_images,
    "pages_with_lead_image": _q_pages_with_lead_image,
    "illustrated_pages": _q_illustrated_pages,
    "unillustrated_pages": _q_unillustrated_pages,
    "item_claims": _q_item_claims,
    "item_claims_flat": _q_item_claims_flat,
    "placeholder_images": _q_placeholder_images,
    "category_images": _q_category_images,
    "items_with_category_images": _q_items_with_category_images,
    "numbered_category_images": _q_numbered_category_images,
    "lead_images_elsewhere": _q_lead_images_elsewhere,
    "candidate_pool": _q_candidate_pool,
    "pool_coverage": _q_pool_coverage,
    "with_any_source": _q_with_any_source,
    "is_valid_image_name": _q_is_valid_image_name,
    "images_by_wiki": _q_images_by_wiki,
    "rank_lead_images": _q_rank_lead_images,
    "draw_category_images": _q_draw_category_images,
    "item_image_candidates": _q_item_image_candidates,
    "excluded_pages": _q_excluded_pages,
    "merge_sources": _q_merge_sources,
    "top_candidates": _q_top_candidates,
    "candidates_table": _q_candidates_table,
    "explode_candidates": _q_explode_candidates,
    "candidate_note_fields": _q_candidate_note_fields,
    "production_rows": _q_production_rows,
    "production_rows_docs": _q_production_rows_docs,
    "production_table": _q_production_table,
    "search_table": _q_search_table,
    "export_canonical": _q_export_canonical,
    "export_android": _q_export_android,
    "export_summary": _q_export_summary,
    "serving_table": _q_serving_table,
    "records_per_wiki": _q_records_per_wiki,
    "population_stats": _q_population_stats,
    "population_median": _q_population_median,
    "population_modes": _q_population_modes,
    "population_modes_docs": _q_population_modes_docs,
    "images_per_page": _q_images_per_page,
    "suggestion_histogram": _q_suggestion_histogram,
    "suggestion_histogram_pct": _q_suggestion_histogram_pct,
    "suggestions_by_confidence": _q_suggestions_by_confidence,
    "oversuggested_pages": _q_oversuggested_pages,
    "oversuggested_pages_k1": _q_oversuggested_pages_k1,
    "raw_records_per_wiki": _q_raw_records_per_wiki,
    "raw_vs_final": _q_raw_vs_final,
    "instance_of_coverage": _q_instance_of_coverage,
    "redirects_in_dataset": _q_redirects_in_dataset,
    "redirects_in_pages": _q_redirects_in_pages,
    "filtered_out_records": _q_filtered_out_records,
    "found_on_sizes": _q_found_on_sizes,
    "found_on_histogram": _q_found_on_histogram,
    "found_on_describe": _q_found_on_describe,
    "found_on_median": _q_found_on_median,
    "found_on_approx_median": _q_found_on_approx_median,
    "box_stats_records": _q_box_stats_records,
    "box_stats_population": _q_box_stats_population,
    "box_stats_found_on": _q_box_stats_found_on,
    "snapshot_counts": _q_snapshot_counts,
    "column_frequencies": _q_column_frequencies,
    "top_values": _q_top_values,
    "confidence_source_matrix": _q_confidence_source_matrix,
    "confidence_violations": _q_confidence_violations,
    "no_recommendation_check": _q_no_recommendation_check,
    "sample_pages": _q_sample_pages,
    "distinct_candidate_images": _q_distinct_candidate_images,
    "candidate_image_pages": _q_candidate_image_pages,
    "image_metadata": _q_image_metadata,
    "page_description": _q_page_description,
    "page_caption": _q_page_caption,
    "page_depicts": _q_page_depicts,
    "published_candidates": _q_published_candidates,
    "published_raw": _q_published_raw,
    "published_production": _q_published_production,
    "published_search": _q_published_search,
    "published_canonical": _q_published_canonical,
    "published_android": _q_published_android,
    "published_serving": _q_published_serving,
    "registered_tables": _q_registered_tables,
    "serving_lookup": _q_serving_lookup,
    "published_manifest": _q_published_manifest,
    "candidate_rejects": _q_candidate_rejects,
    "metric_state": _q_metric_state,
}


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        return lambda spark, sf_dir: comparable(fn(spark, sf_dir))
    return {name: wrap(fn) for name, fn in QUERIES.items()}
