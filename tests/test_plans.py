"""Plan shape: pruning and pushdown reach the scans, top-k windows get a partial limit, hot groups are split."""

from pyspark.sql import functions as F

from picsel.operators import pool as P
from picsel.operators.page_metadata import sample_pages
from picsel.plans.registry import run_for
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    run = run_for(spark, SF_SMALL)
    t = run.tables
    plan = _plan(P.unillustrated_pages(t.page, t.item_page_link, run.illustrated))
    assert "o_custkey" not in plan and "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert "EqualTo(o_orderpriority" in plan or "PushedFilters: [IsNotNull" in plan


def test_top_k_windows_get_a_partial_limit(spark):
    run = run_for(spark, SF_SMALL)
    assert "WindowGroupLimit" in _plan(run.top_candidates())
    assert "WindowGroupLimit" in _plan(sample_pages(run.raw, 500))


def test_hot_category_is_numbered_by_ranges(spark):
    n = 6400
    files = spark.createDataFrame([("Hot", f"F{i}.jpg") for i in range(n)] + [("Cold", "c.jpg")], "cl_to string, page_title string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        num = P.numbered_category_images(files)
        parts = num.where("cl_to = 'Hot'")
        assert "part" in _plan(num) and sorted(r.idx for r in parts.collect()) == list(range(n))
        ranged = files.repartitionByRange("cl_to", "page_title").withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
        assert len(sizes) > 4 and max(sizes) < n / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_item_claims_read_entities_once_without_unfolding(spark):
    run = run_for(spark, SF_SMALL)
    cols = "id string, typ string, labels map<string,string>, claims array<struct<mainSnak:struct<property:string,datavalue:struct<value:string>>>>"
    entity = spark.createDataFrame([], cols)
    plan = P.item_claims(entity, run.unillustrated)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 1


def test_rows_without_a_category_bypass_the_join(spark):
    rows = spark.createDataFrame([("a", None), ("b", "C")], "id string, commonscategory string")
    stats = spark.createDataFrame([("C", 2, 1)], "cl_to string, n_category_images bigint, n_dotted_images bigint")
    out = P.with_category_stats(rows, stats)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnull(commonscategory" in plan and "isnotnull(commonscategory" in plan
    assert sorted(tuple(r) for r in out.collect()) == [("a", None, None, None), ("b", "C", 2, 1)]


def test_the_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    import pytest
    from types import SimpleNamespace
    from picsel import session
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=sc)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)
