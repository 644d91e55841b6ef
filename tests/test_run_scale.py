"""The run up to the raw table: each source is read once a step, and rows are shuffled once where one key serves several steps."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, same_rows
from picsel.operators import pool as P
from picsel.operators import selection as S
from picsel.plans.registry import run_for
from picsel.sources.standins import StandIns


def _plan(df, kind="executedPlan") -> str:
    return getattr(df._jdf.queryExecution(), kind)().toString()


class _NoBroadcast:
    """Static plans without broadcasts by size."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.old.items():
            self.spark.conf.set(k, v)


def test_entities_are_built_from_one_scan(spark, scratch):
    keys = [(k,) for k in [*range(0, 600, 7), 40, 41, 140, 140, -1, -35]] + [(None,)]
    spark.createDataFrame(keys, "o_orderkey bigint").write.parquet(f"{scratch}/orders.parquet")
    src = StandIns(spark, scratch)
    assert _plan(src.entity).count("FileScan parquet") == 1
    labels = src.labels.groupBy("item_id").agg(F.sort_array(F.collect_list(F.concat_ws("=", "lang", "label"))).alias("labels"))
    claims = src.claims.groupBy("item_id").agg(F.sort_array(F.collect_list(F.concat_ws("=", "property", "value"))).alias("claims"))
    want = labels.join(claims, "item_id", "left")
    found = src.entity.select(
        F.col("id").alias("item_id"), F.sort_array(F.transform(F.map_entries("labels"), lambda e: F.concat_ws("=", e["key"], e["value"]))).alias("labels"),
        F.sort_array(F.transform("claims", lambda c: F.concat_ws("=", c["mainSnak"]["property"], c["mainSnak"]["datavalue"]["value"]))).alias("claims"))
    assert same_rows(found, want) and found.where("claims is null").count() == 1


def test_needed_items_are_dealt_out_by_item_once(spark):
    pages = spark.createDataFrame([("enwiki", "Q1"), ("enwiki", "Q1"), ("frwiki", "Q1"), ("enwiki", "Q2"), ("enwiki", None)], "wiki_db string, item_id string")
    snak = "array(named_struct('mainSnak', named_struct('property', {}, 'datavalue', named_struct('value', '\"v\"'))))"
    entity = spark.sql(f"select id, 'item' typ, map('en', 'E') labels, {snak.format('p')} claims from values ('Q1', 'P31'), ('Q2', 'P1'), ('Q3', 'P31'), ('Q2', null) t(id, p)")
    with _NoBroadcast(spark):
        out = P.item_claims(entity, pages)
        assert "hashpartitioning(wiki_db" not in _plan(out)
        assert [tuple(r) for r in out.collect()] == [("enwiki", "Q1", "E", None, None, '"v"')]


def test_few_icons_leave_no_shuffle_by_image(spark):
    links = spark.createDataFrame([("w", 1, "a", 0), ("w", 1, "b", 0), ("w", 1, "c", 0), ("w", 2, "a", 0), ("w", 3, "b", 1), ("v", 2, "a", 0)],
                                  "wiki_db string, il_from bigint, il_to string, il_from_namespace int")
    icons = spark.createDataFrame([("w", "a", 9)], "wiki_db string, il_to string, n_links bigint")
    with _NoBroadcast(spark):
        out = P.pages_with_images(links, icons)
        assert "SortMergeJoin" not in _plan(out) and "hashpartitioning(wiki_db#" in _plan(out) and "il_to" not in _plan(out).split("Exchange")[0]
        assert sorted(map(tuple, out.collect())) == [("v", 2), ("w", 1)]
        all_links = P.pages_with_images(links, icons, repeats=True)
        assert "hashpartitioning" not in _plan(all_links) and sorted(map(tuple, all_links.collect())) == [("v", 2), ("w", 1), ("w", 1)]
        assert sorted(map(tuple, P.illustrated_pages(all_links, out).collect())) == [("v", 2), ("w", 1)]


def test_links_meet_lead_properties_once(spark):
    t = run_for(spark, SF_SMALL).tables
    items = spark.createDataFrame([("Q1",)], "item_id string")
    plan = _plan(P.item_lead_images(t.item_page_link, t.page_props, t.page, None, items), "optimizedPlan")
    assert plan.count("Relation [o_orderkey") == 1


def test_lead_images_of_titles_that_repeat(spark):
    page = spark.createDataFrame([("commonswiki", i, t, 6, 0) for i, t in enumerate(["A", "A", "B", "C"])],
                                 "wiki_db string, page_id bigint, page_title string, page_namespace int, page_is_redirect int")
    props = spark.createDataFrame([("frwiki", 1, "page_image", v) for v in ("A", "B", "B", "D", None)], "wiki_db string, pp_page bigint, pp_propname string, pp_value string")
    links = spark.createDataFrame([("Q1", 1, 0, "frwiki"), ("Q1", 1, 0, "frwiki"), ("Q2", 1, 0, "frwiki")], "item_id string, page_id bigint, page_namespace int, wiki_db string")
    items = spark.createDataFrame([("Q1",)], "item_id string")
    found = lambda gone: sorted(r.image for r in P.item_lead_images(links, props, page, gone, items).collect())
    assert found(None) == ["A", "A", "B", "B", "B", "B"]
    assert found(spark.createDataFrame([("B",), ("B",)], "page_title string")) == ["A", "A"]


def test_best_leads_are_ranked_once(spark):
    rows = [("w", 1, "v", "A")] * 3 + [("w", 1, "u", "B"), ("w", 2, "v", "A"), ("w", 2, "u", "A")]
    leads = spark.createDataFrame(rows, "wiki_db string, page_id bigint, src_wiki string, image string")
    want = S.rank_lead_images(S.images_by_wiki(leads))
    more = leads.union(leads.withColumn("page_id", F.lit(7).cast("bigint")))
    out = S.rank_lead_images_by_bitmap(leads, ["u", "v"], listed=more)
    assert "Window" not in _plan(out) and same_rows(out, want)
    assert "collect_list" not in _plan(S.rank_lead_images_by_bitmap(leads.where("page_id = 2"), ["u", "v"]))


def test_candidates_are_shuffled_by_page_once(spark):
    rows = spark.createDataFrame([("w", 1, "A", 2.0, "two"), ("w", 1, "A", 1.0, "one"), ("w", 1, "B", 3.0, "b"), ("v", 1, "A", 3.0, "v")],
                                 "wiki_db string, page_id bigint, image string, rating double, note string")
    with _NoBroadcast(spark):
        top = S.top_candidates(S.merge_sources(rows, rows.where("rating = 3")))
        assert _plan(top).count("Exchange") == 1
        assert sorted(map(tuple, top.collect())) == [("v", 1, 0, "A", 3.0, "v"), ("w", 1, 0, "A", 1.0, "one"), ("w", 1, 1, "B", 3.0, "b")]
