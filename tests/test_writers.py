"""Sinks: candidates TSV round trip, dynamic partition overwrite, table registration, the whole job."""

import glob
import os

from pyspark.sql import functions as F

from picsel.operators import publish as D
from picsel.operators import serving as V
from picsel.plans.registry import run_for
from picsel.sources.readers import read_candidates_tsv, read_partitioned_tsv, read_raw_parquet
from conftest import SF_SMALL, same_rows


def test_candidates_tsv_round_trip(spark, scratch):
    raw = run_for(spark, SF_SMALL).raw
    D.write_candidates(raw, scratch + "/tsv")
    back = read_partitioned_tsv(spark, scratch + "/tsv", "2021-01")
    assert same_rows(back, raw)
    # the original reader (no header) turns each file's header line into a data row
    one = glob.glob(scratch + "/tsv/wiki_db=enwiki/*.csv")[0]
    legacy = read_candidates_tsv(spark, one, "enwiki", "2021-01", header=False)
    assert legacy.where(F.col("item_id") == "item_id").count() == 1


def test_publish_raw_dynamic_overwrite(spark, scratch):
    raw = run_for(spark, SF_SMALL).raw
    path = scratch + "/raw"
    D.publish_raw(raw, path)
    before = read_raw_parquet(spark, path).count()
    # rewriting one wiki replaces only that partition
    D.publish_raw(raw.where(F.col("wiki_db") == "enwiki").limit(5), path)
    after = read_raw_parquet(spark, path)
    assert after.where(F.col("wiki_db") == "enwiki").count() == 5
    assert after.where(F.col("wiki_db") != "enwiki").count() == before - raw.where(
        F.col("wiki_db") == "enwiki").count()


def test_production_and_search_writes_and_tables(spark, scratch):
    run = run_for(spark, SF_SMALL)
    prod = run.production_table("ds", 1.0)
    D.publish_production(prod, scratch + "/prod")
    D.publish_raw(run.raw, scratch + "/raw")
    search = D.search_table(prod, "2021-01-25", "2021-01")
    D.publish_search(search, scratch + "/search")
    db = "picsel_test_" + os.path.basename(scratch).replace("-", "_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    D.register_tables(spark, scratch + "/raw", scratch + "/prod", scratch + "/search", database=db)
    assert spark.table(f"{db}.imagerec_prod").count() == prod.count()
    assert spark.table(f"{db}.search_imagerec").count() == search.count()
    assert spark.table(f"{db}.imagerec").count() == run.raw.count()
    # one file per (wiki, snapshot) partition
    for part in glob.glob(scratch + "/prod/wiki=*/snapshot=*"):
        assert len(glob.glob(part + "/*.parquet")) == 1


def test_serving_table_layout(spark, scratch):
    run = run_for(spark, SF_SMALL)
    serving = D.serving_table(D.export_rows(run.production_table("ds", 1.0)))
    V.write_serving(serving, scratch + "/serving")
    back = spark.read.parquet(scratch + "/serving")
    assert back.count() == serving.count()
    assert dict(back.dtypes)["page_id"] == "bigint"


def test_full_job_writes_every_output(spark, scratch):
    import os as _os
    from picsel.plans.job import run_job
    from picsel.plans.recommend import RecommendationRun
    run = RecommendationRun.standin(spark, SF_SMALL)
    timings = run_job(spark, run, scratch + "/out", "2021-01-25", "ds", 1.0)
    assert "production" in timings and "report:export_summary" in timings
    for sub in ("imagerec", "imagerec_prod", "search_imagerec", "exports/2021-01", "exports_android/2021-01",
                "serving/2021-01", "reports/2021-01/records_per_wiki"):
        assert _os.path.isdir(f"{scratch}/out/{sub}"), sub
    prod = spark.read.parquet(scratch + "/out/imagerec_prod")
    assert same_rows(prod.select(*run.production_table("ds", 1.0).columns), run.production_table("ds", 1.0))
    for report in ("rejected_candidates", "top_values", "snapshot_counts_all", "suggestion_histogram_all", "found_on_median_all"):
        assert spark.read.csv(f"{scratch}/out/reports/2021-01/{report}", header=True).columns
    search = spark.read.parquet(scratch + "/out/search_imagerec")
    assert sorted(r.wikiid for r in search.select("wikiid").distinct().collect()) == [
        "arwiki", "enwiki", "frwiki", "kowiki"]


def test_job_with_commits_and_lookup(spark, scratch, capsys):
    import json

    import pytest
    from picsel.operators import manifest as Mf
    from picsel.plans.job import main, run_job
    from picsel.plans.recommend import RecommendationRun
    run = RecommendationRun.standin(spark, SF_SMALL)
    out = scratch + "/out"
    run_job(spark, run, out, "2021-01-25", "ds", 1.0, commit=True)
    want = run.production_table("ds", 1.0)
    assert same_rows(Mf.read(spark, out + "/imagerec_prod", want.schema), want) and same_rows(Mf.read(spark, out + "/imagerec", run.raw.schema), run.raw)
    assert Mf.damaged(spark, out + "/imagerec_prod", want.schema, ["wiki", "snapshot"]).count() == 0
    page = want.where("wiki = 'enwiki' and image_id is not null and is_article_page").first().page_id
    capsys.readouterr()
    main(["--out", out, "--snapshot", "2021-01-25", "--lookup", "enwiki", page])
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert rows and {(r["wiki"], str(r["page_id"])) for r in rows} == {("enwiki", page)}
    with pytest.raises(ValueError, match="registered"):
        run_job(spark, run, out, "2021-01-25", database="x", commit=True)


def test_large_partitions_are_spread_and_sorted(spark, scratch):
    run = run_for(spark, SF_SMALL)
    prod = run.production_table("ds", 1.0)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        D.publish_production(prod, scratch + "/prod", rows_per_file=20)
        D.publish_search(D.search_table(prod, "2021-01-25"), scratch + "/search", rows_per_file=20)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = glob.glob(scratch + "/prod/wiki=*/snapshot=*/*.parquet")
    assert len(files) > len(glob.glob(scratch + "/prod/wiki=*/snapshot=*"))
    assert len(glob.glob(scratch + "/search/*/*/*/*.parquet")) > 1
    for f in files:
        titles = [r.page_title for r in spark.read.parquet(f).collect()]
        assert titles == sorted(titles, reverse=True)
    assert same_rows(spark.read.parquet(scratch + "/prod").select(*prod.columns), prod)


def test_spread_names_missing_columns(spark):
    import pytest
    with pytest.raises(ValueError, match="page_id"):
        D.spread(spark.range(3), ["id"], ["page_id"])


def test_runs_read_only_their_snapshot(spark, scratch):
    """Two snapshots of every source table: a run for the second reads only it, by partition pruning."""
    from picsel.plans.recommend import RecommendationRun
    from picsel.sources.standins import StandIns
    src = StandIns(spark, SF_SMALL)
    for name in ("page", "imagelinks", "page_props", "categorylinks", "item_page_link", "entity", "placeholder_category"):
        df = getattr(src, name)
        if name == "placeholder_category":
            df.write.parquet(f"{scratch}/{name}")
            continue
        first, second = ("2021-01", "2021-02") if name not in ("item_page_link", "entity") else ("2021-01-25", "2021-02-22")
        thin = df.where("wiki_db <> 'frwiki'") if "wiki_db" in df.columns else df
        both = df.withColumn("snapshot", F.lit(first)).unionByName(thin.withColumn("snapshot", F.lit(second)))
        both.write.partitionBy(*[c for c in ("snapshot", "wiki_db") if c in df.columns]).parquet(f"{scratch}/{name}")
    run = RecommendationRun.from_parquet(spark, scratch, "2021-02-22")
    plan = run.tables.page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan and "2021-02" in plan
    rows = run.raw.select("wiki_db", "snapshot").distinct().collect()
    assert {r.snapshot for r in rows} == {"2021-02"} and "frwiki" not in {r.wiki_db for r in rows}
    old = RecommendationRun.from_parquet(spark, scratch, "2021-01-25")
    assert same_rows(old.raw, run_for(spark, SF_SMALL).raw)
