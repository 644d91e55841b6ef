"""The end-to-end production job: one snapshot, all wikis, every output written by Spark.

    python -m picsel.plans.job --tables /shared/snapshots --out /shared/imagerec --snapshot 2021-01-25

``--snapshot`` is the one date that decides what is read (MediaWiki tables by its month, Wikidata tables by the date) and how the
outputs are named. Sources are Parquet folders (``--tables``), tables of the catalog (``--catalog``), or the stand-ins over the
supplied tables (``--sf-dir``).

Stages (each a Spark job, no driver-side data): placeholders and pool (stage tables under
``spark.checkpoint.dir``) -> placeholder list -> selection -> candidates TSV and raw table -> production table -> search
feed -> exports (canonical and android) -> serving table -> registered tables -> metric state and reports. Outputs go under ``out`` with dynamic partition overwrite, so
re-running a snapshot replaces only its partitions. With ``--commit`` the raw and the production table are published by manifest
instead: readers see a publication whole or not at all.

    python -m picsel.plans.job --out /shared/imagerec --snapshot 2021-01-25 --lookup enwiki 4711 4712

looks pages up in a written serving table and prints their rows as JSON lines.
"""

from __future__ import annotations

import argparse
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.functions.columns import month_of_str
from picsel.operators import manifest as Mf
from picsel.operators import metric_state as Ms
from picsel.operators import metrics as E
from picsel.operators import publish as D
from picsel.operators import rejects as R
from picsel.operators import serving as V
from picsel.plans.recommend import RecommendationRun
from picsel.session import ship_package
from picsel.sources.readers import read_raw_parquet


def write_report(df: DataFrame, path: str) -> None:
    """Metric output as CSV with a header (the original wrote one CSV per metric); arrays as JSON text."""
    cols = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", "true").csv(path)


def run_job(spark: SparkSession, run: RecommendationRun, out: str, date: str, dataset_id: str | None = None,
            insertion_ts: float | None = None, database: str | None = None, commit: bool = False) -> dict[str, float]:
    """Run every stage for ``run`` and write all outputs under ``out``; returns seconds per stage.

    ``commit`` publishes the raw and production tables by manifest; such tables are not folders of partitions, so they can't be
    registered in a catalog.
    """
    if commit and database:
        raise ValueError("tables published by manifest can't be registered")
    dataset_id = dataset_id or str(uuid.uuid4())
    insertion_ts = time.time() if insertion_ts is None else insertion_ts
    month = run.snapshot
    timings: dict[str, float] = {}

    def stage(name, fn):
        t = time.perf_counter()
        result = fn()
        timings[name] = round(time.perf_counter() - t, 3)
        return result

    stage("pool", lambda: (run.pool, run.numbered_category_images))
    stage("placeholders", lambda: run.placeholders.write.mode("overwrite").parquet(f"{out}/placeholders/{month}"))
    stage("candidates", lambda: D.write_candidates(run.raw, f"{out}/candidates/{month}"))
    if commit:
        stage("raw", lambda: Mf.publish(run.raw, f"{out}/imagerec", ["wiki_db", "snapshot"], ["page_id"]))
        raw = Mf.read(spark, f"{out}/imagerec", run.raw.schema).where(f"snapshot = '{month}'").select(*run.raw.columns)
        made = D.production_table(D.production_rows(raw), month, dataset_id, insertion_ts)
        title = [F.col("page_title").desc()]
        stage("production", lambda: Mf.publish(made, f"{out}/imagerec_prod", ["wiki", "snapshot"], ["page_id"], title))
        prod = Mf.read(spark, f"{out}/imagerec_prod", made.schema).where(f"snapshot = '{month}'")
    else:
        stage("raw", lambda: D.publish_raw(run.raw, f"{out}/imagerec"))
        raw = read_raw_parquet(spark, f"{out}/imagerec").where(f"snapshot = '{month}'")
        made = D.production_table(D.production_rows(raw), month, dataset_id, insertion_ts)
        stage("production", lambda: D.publish_production(made, f"{out}/imagerec_prod"))
        prod = spark.read.parquet(f"{out}/imagerec_prod").where(f"snapshot = '{month}'")
    stage("search", lambda: D.publish_search(D.search_table(prod, date), f"{out}/search_imagerec"))
    stage("exports", lambda: (
        D.write_exports(D.export_rows(prod, month, K.TARGET_WIKIS), f"{out}/exports/{month}"),
        D.write_exports(D.export_rows(prod, month, K.TARGET_WIKIS, android=True), f"{out}/exports_android/{month}"),
    ))
    exports = D.export_rows(prod, month, K.TARGET_WIKIS)
    stage("serving", lambda: V.write_serving(D.serving_table(exports), f"{out}/serving/{month}"))
    if database:
        stage("register", lambda: D.register_tables(spark, f"{out}/imagerec", f"{out}/imagerec_prod", f"{out}/search_imagerec", database))
    state = f"{out}/metric_state"
    stage("metric_state", lambda: Ms.update(prod, state, month))
    reports = {
        "rejected_candidates": R.rejected(R.judged(raw)),
        "top_values": E.top_values(prod),
        "snapshot_counts_all": Ms.snapshot_counts(spark, state),
        "suggestion_histogram_all": Ms.suggestion_histogram(spark, state),
        "found_on_median_all": Ms.found_on_median(spark, state),
        "records_per_wiki": E.records_per_wiki(prod, month),
        "population_statistics": E.describe(E.records_per_wiki(prod, month), "n_records"),
        "population_median": E.median(E.records_per_wiki(prod, month), "n_records"),
        "box_stats_per_wiki": E.box_stats(E.images_per_page(prod, month), "n_images", by=("wiki",)),
        "snapshot_counts": E.snapshot_counts(prod),
        "column_frequencies": E.column_frequencies(prod),
        "unserved_page_ids": D.unserved_page_ids(prod),
        "population_modes": E.modes(E.records_per_wiki(prod, month), "n_records"),
        "images_per_page": E.images_per_page(prod, month),
        "suggestion_histogram": E.suggestion_histogram_pct(prod, month),
        "suggestions_by_confidence": E.suggestions_by_confidence(prod, month),
        "oversuggested_pages": E.oversuggested_pages(prod, month),
        "raw_vs_final": E.raw_vs_final(raw, prod, month),
        "instance_of_coverage": E.instance_of_coverage(raw, month),
        "redirects": E.redirects_in_dataset(raw, run.tables.page, month),
        "filtered_out_records": E.filtered_out_records(prod),
        "found_on_histogram": E.found_on_histogram(E.found_on_sizes(prod, month)),
        "confidence_source_matrix": E.confidence_source_matrix(prod),
        "confidence_violations": E.confidence_violations(prod),
        "export_summary": D.export_summary(exports),
    }
    for name, df in reports.items():
        stage(f"report:{name}", lambda df=df, name=name: write_report(df, f"{out}/reports/{month}/{name}"))
    return timings


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="All-wikis image recommendation run")
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--lookup", nargs="+", metavar=("WIKI", "PAGE_ID"), help="look pages up in the serving table instead of running")
    source.add_argument("--tables", help="root of the source tables as parquet folders, partitioned by snapshot")
    source.add_argument("--catalog", nargs="*", metavar="FIELD=TABLE", help="read the catalog's tables, named like the fields unless given")
    source.add_argument("--sf-dir", help="folder of the supplied parquet tables (stand-in sources)")
    ap.add_argument("--out", required=True, help="output root (a shared folder on a cluster)")
    ap.add_argument("--snapshot", default="2021-01-25", help="full snapshot date YYYY-MM-DD")
    ap.add_argument("--dataset-id", default=None)
    ap.add_argument("--database", default=None, help="register the outputs as tables of this database")
    ap.add_argument("--commit", action="store_true", help="publish the raw and production tables by manifest")
    ap.add_argument("--seed", default=K.DEFAULT_DRAW_SEED)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    ship_package(spark)
    if args.lookup:
        served = V.read_serving(spark, f"{args.out}/serving/{month_of_str(args.snapshot)}")
        found = V.lookup_pages(served, args.lookup[0], map(int, args.lookup[1:]))
        for row in found.select(F.to_json(F.struct("*")).alias("row")).collect():  # the asked pages' rows only
            print(row["row"])
        return
    if args.tables:
        run = RecommendationRun.from_parquet(spark, args.tables, args.snapshot, seed=args.seed)
    elif args.sf_dir:
        run = RecommendationRun.standin(spark, args.sf_dir, args.snapshot, seed=args.seed)
    else:
        run = RecommendationRun.from_catalog(spark, args.snapshot, dict(x.split("=", 1) for x in args.catalog), seed=args.seed)
    print(run_job(spark, run, args.out, args.snapshot, args.dataset_id, database=args.database, commit=args.commit))


if __name__ == "__main__":
    main()

