"""Keyed lookups and runtime pruning: what is read, counted by the scans' own metrics."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from picsel.operators import publish as D
from picsel.operators import serving as V
from picsel.plans.registry import run_for
from picsel.sources import readers as R
from picsel.sources.standins import MONTH, StandIns
from conftest import SF_SMALL, same_rows
from scans import nodes, scans

GROUP = 100


def _served(spark, scratch, n=2000):
    """Even page ids below 2 * n in each of three wikis, in row groups of GROUP rows."""
    rows = spark.range(n).select((F.col("id") * 2).alias("page_id"), F.explode(F.array(*[F.lit(w) for w in ("enwiki", "frwiki", "kowiki")])).alias("wiki"))
    rows = rows.select("page_id", F.concat(F.lit("T"), "page_id").alias("page_title"), F.lit("I.jpg").alias("image_id"), F.lit("high").alias("confidence_rating"),
                       F.lit("wikidata").alias("source"), F.lit("ds").alias("dataset_id"), F.lit(1.0).alias("insertion_ts"), "wiki", F.lit("").alias("found_on"))
    V.write_serving(rows, scratch, rows_per_group=GROUP)
    return rows, V.read_serving(spark, scratch)


def _read(df, path):
    df = df.select("*")  # a run of its own: metrics that the driver sends are sent once a plan
    df.collect()
    return sum(s["numOutputRows"] for s in scans(df, path)), sum(s["numFiles"] for s in scans(df, path))


def test_files_have_row_groups_with_disjoint_ids(spark, scratch):
    rows, served = _served(spark, scratch)
    assert same_rows(served, rows)
    ranges = []
    for name in glob.glob(scratch + "/wiki=enwiki/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        column = meta.schema.names.index("page_id")
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        assert all(g.num_rows <= GROUP for g in groups)
        ranges += [(g.column(column).statistics.min, g.column(column).statistics.max) for g in groups]
    ranges.sort()
    assert len(ranges) >= 20 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_page_costs_one_row_group(spark, scratch):
    _, served = _served(spark, scratch)
    found = V.lookup_pages(served, "enwiki", [1234])
    assert [(r.wiki, r.page_id) for r in found.collect()] == [("enwiki", 1234)]
    read, files = _read(found, scratch)
    assert 0 < read <= GROUP and files == len(glob.glob(scratch + "/wiki=enwiki/*.parquet"))
    found = V.lookup_pages(served, "frwiki", [0, 2000, 3998])
    assert found.count() == 3 and _read(found, scratch)[0] <= 3 * GROUP


def test_bloom_filter_rules_out_absent_pages(spark, scratch):
    """Odd ids lie within the ranges of the row groups; only the Bloom filters know that they are absent."""
    _, served = _served(spark, scratch)
    assert _read(V.lookup_pages(served, "enwiki", [1235]), scratch)[0] == 0
    # without Bloom filters, page statistics still keep the scan within a row group
    blind = spark.read.schema(V.SERVING_DDL).option("parquet.filter.bloom.enabled", "false").option("parquet.filter.columnindex.enabled", "false").parquet(scratch)
    assert _read(V.lookup_pages(blind, "enwiki", [1235]), scratch)[0] == GROUP


def test_lookup_by_a_key_table(spark, scratch):
    rows, served = _served(spark, scratch)
    keys = spark.createDataFrame([("frwiki", 700), ("frwiki", 702), ("frwiki", 701), ("frwiki", 700), (None, 5), ("frwiki", None)], "wiki string, page_id int")
    found = V.lookup(served, keys)
    assert sorted((r.wiki, r.page_id) for r in found.collect()) == [("frwiki", 700), ("frwiki", 702)]
    read, files = _read(found, scratch)
    assert files == len(glob.glob(scratch + "/wiki=frwiki/*.parquet")) and 0 < read <= 2 * GROUP  # of 6000 rows in three folders
    every = V.lookup(served, rows.select("wiki", "page_id").where(F.col("page_id") % 50 == 0))
    assert same_rows(every, rows.where(F.col("page_id") % 50 == 0))
    assert V.lookup(served, keys.limit(0)).count() == 0


def test_partitions_are_pruned_by_the_wiki_table(spark, scratch):
    page = StandIns(spark, SF_SMALL).page
    R.write_snapshot_table(page.unionByName(page.withColumn("snapshot", F.lit("2020-12"))), scratch)
    table = R.read_snapshot_table(spark, scratch, page.schema)
    wanted = R.wiki_table(spark).where(F.col("direction") == "rtl")
    found = R.scan_for_wikis(table, MONTH, wanted)
    rows = found.collect()
    assert {r.wiki_db for r in rows} == {"arwiki"} and len(rows) == page.where("wiki_db = 'arwiki'").count()
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    (scan,) = scans(found, scratch)
    assert scan["numPartitions"] == 1 and scan["numOutputRows"] == len(rows)  # of ten folders
    assert R.scan_for_wikis(table, "2020-11", wanted).count() == 0


def test_heavy_icons_never_meet_a_shuffle(spark):
    from picsel.operators import pool as P
    hot = [("enwiki", i, "Hot.jpg", 0) for i in range(3000)] + [("enwiki", i, f"I{i % 40}.jpg", 0) for i in range(400)] + [("frwiki", 1, "Hot.jpg", 0)]
    links = spark.createDataFrame([*hot, ("enwiki", 9999, "Rare.jpg", 0), ("enwiki", 9998, "Hot.jpg", 1)], "wiki_db string, il_from bigint, il_to string, il_from_namespace int").repartition(4)
    icons = P.icon_images(links, spark.createDataFrame([("enwiki", 5.0), ("frwiki", 5.0)], "wiki_db string, threshold double"))
    want = links.where("il_from_namespace = 0").join(icons, ["wiki_db", "il_to"], "left_anti").select("wiki_db", F.col("il_from").alias("page_id")).distinct()
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("false", "-1")):
            spark.conf.set(k, v)
        found = P.pages_with_images(links, icons, heavy_icons=10)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) == [("enwiki", 9999), ("frwiki", 1)]
        joins = [(name, n.metrics().apply("numOutputRows").value()) for name, n in nodes(found) if name.endswith("JoinExec")]
        # the 3000 links of Hot.jpg end in the broadcast join; what is left goes on to the shuffled one
        assert ("BroadcastHashJoinExec", 402) in joins and ("SortMergeJoinExec", 2) in joins
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_serving_of_a_run(spark, scratch):
    run = run_for(spark, SF_SMALL)
    serving = D.serving_table(D.export_rows(run.production_table("ds", 1.0)))
    V.write_serving(serving, scratch)
    assert same_rows(V.read_serving(spark, scratch), serving)
