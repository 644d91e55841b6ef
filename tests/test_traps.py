"""One small hand-made input per trap listed in the survey."""

from pyspark.sql import functions as F

from picsel import constants as K
from picsel.functions import columns as C
from picsel.functions import html_extract as H
from picsel.operators import metrics as E
from picsel.operators import page_metadata as M
from picsel.operators import pool as P
from picsel.operators import publish as D
from picsel.operators import selection as S

LINK_SCHEMA = "wiki_db string, il_from bigint, il_to string, il_from_namespace int"


def test_icon_threshold_both_branches(spark):
    # below the base size: proportional, with a floor of 3.75; from it on: 15 * (1 + log10 of the ratio)
    want = {1: 3.75, 12500: 3.75, 12501: 3.7503, 25000: 7.5, 49999: 14.9997, 50000: 15.0, 500000: 30.0, 5000000: 45.0}
    df = spark.createDataFrame([(s,) for s in want], "wiki_size bigint")
    got = {r[0]: r[1] for r in df.select("wiki_size", C.icon_threshold("wiki_size")).collect()}
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want)


def test_quote_and_comma_names_are_never_icons(spark):
    rows = []
    for name in ("a,b.jpg", 'a"b.jpg', "c.jpg"):
        rows += [("xwiki", i, name, 0) for i in range(20)]
    links = spark.createDataFrame(rows, LINK_SCHEMA)
    th = spark.createDataFrame([("xwiki", 15.0)], "wiki_db string, threshold double")
    icons = [r.il_to for r in P.icon_images(links, th).collect()]
    assert icons == ["c.jpg"]
    # pages linking only the quoted/comma names stay illustrated
    with_images = P.pages_with_images(links, P.icon_images(links, th))
    assert with_images.count() == 20


def test_count_at_threshold_is_not_an_icon(spark):
    rows = [("xwiki", i, "at.jpg", 0) for i in range(15)] + [("xwiki", i, "over.jpg", 0) for i in range(16)]
    links = spark.createDataFrame(rows, LINK_SCHEMA)
    th = spark.createDataFrame([("xwiki", 15.0)], "wiki_db string, threshold double")
    assert [r.il_to for r in P.icon_images(links, th).collect()] == ["over.jpg"]


def test_lead_image_property_twice_counts_twice(spark):
    props = spark.createDataFrame(
        [("frwiki", 1, "page_image", "A.jpg"), ("frwiki", 1, "page_image_free", "A.jpg")],
        "wiki_db string, pp_page bigint, pp_propname string, pp_value string")
    page = spark.createDataFrame([("commonswiki", 9, "A.jpg", 6, 0)],
                                 "wiki_db string, page_id bigint, page_title string, page_namespace int, "
                                 "page_is_redirect int")
    ipl = spark.createDataFrame([("Q1", 1, 0, "frwiki"), ("Q1", 2, 0, "enwiki")],
                                "item_id string, page_id bigint, page_namespace int, wiki_db string")
    leads = P.item_lead_images(ipl, props, page, None)
    pages = spark.createDataFrame([("enwiki", "Q1", 2)], "wiki_db string, item_id string, page_id bigint")
    out = P.lead_images_elsewhere(pages, leads)
    assert out.count() == 2
    by = S.images_by_wiki(out).collect()
    assert len(by) == 1 and by[0].n_wikis == 2 and by[0].wikis == ["frwiki", "frwiki"]


def test_image_name_rules(spark):
    names = ["A b.jpg", "X.SVG", "Flag_of_X.png", "imageNA.png", "Good.jpg", "Map_of.png", ""]
    df = spark.createDataFrame([("enwiki", 1, "frwiki", n) for n in names],
                               "wiki_db string, page_id bigint, src_wiki string, image string")
    kept = sorted(r.image for r in S.images_by_wiki(df).collect())
    # 'imageNA' can never match a lower-cased name, so imageNA.png stays valid
    assert kept == ["Good.jpg", "imageNA.png"]


def test_same_image_from_three_sources_keeps_rating_one(spark):
    cols = "wiki_db string, page_id bigint, image string, rating double, note string"
    cat = spark.createDataFrame([("enwiki", 1, "A.jpg", 3.0, K.NOTE_COMMONS)], cols)
    wik = spark.createDataFrame([("enwiki", 1, "A.jpg", 2.0, K.NOTE_WIKIPEDIA_PREFIX + "frwiki")], cols)
    itm = spark.createDataFrame([("enwiki", 1, "A.jpg", 1.0, K.NOTE_WIKIDATA)], cols)
    rows = S.merge_sources(cat, wik, itm).collect()
    assert len(rows) == 1 and rows[0].rating == 1.0 and rows[0].note == K.NOTE_WIKIDATA


def test_category_without_dotted_titles_gives_nothing(spark):
    files = spark.createDataFrame([("Cat_a", "NoDot"), ("Cat_a", "AlsoNoDot"), ("Cat_b", "B.jpg")],
                                  "cl_to string, page_title string")
    pages = spark.createDataFrame([("enwiki", 1, "Cat_a"), ("enwiki", 2, "Cat_b")],
                                  "wiki_db string, page_id bigint, commonscategory string")
    out = S.draw_category_images(pages, files).collect()
    assert [(r.page_id, r.image) for r in out] == [(2, "B.jpg")]


def test_category_numbering_is_dense_and_in_title_order(spark):
    rows = [("Big", f"F{i}.jpg") for i in range(500)] + [("Small", "s.jpg")]
    files = spark.createDataFrame(rows, "cl_to string, page_title string")
    num = P.numbered_category_images(files)
    big = {r.page_title: r.idx for r in num.where("cl_to = 'Big'").collect()}
    assert big == {t: i for i, t in enumerate(sorted(big))} and len(big) == 500
    assert [r.idx for r in num.where("cl_to = 'Small'").collect()] == [0]


def test_candidate_text_variants(spark):
    texts = [
        None, "", "[]", "top_candidates",
        "[{'image': 'a.jpg', 'rating': 1, 'note': 'image was in the Wikidata item'}]",
        '[{"image": "It\'s.jpg", "rating": 2.0, "note": "image was found in the following Wikis: enwiki"}]',
        '{"image": "single.jpg", "rating": 3.0, "note": "image was found in the Commons category x"}',
        '[{"image": "bad.jpg", "rating": "x", "note": "n"}]',
    ]
    raw = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "page_id string, top_candidates string")
    got = {r.page_id: r.image for r in D.explode_candidates(raw).collect()}
    assert "0" not in got and "2" not in got and "3" not in got
    assert got["4"] == "a.jpg" and got["5"] == "It's.jpg" and got["6"] == "single.jpg"


def test_note_without_wikis_gives_single_empty(spark):
    df = spark.createDataFrame([(K.NOTE_WIKIDATA,), (K.NOTE_COMMONS,)], "note string")
    out = df.select(C.found_on("note").alias("f")).collect()
    assert all(r.f == [""] for r in out)


def test_null_instance_of_is_article(spark):
    df = spark.createDataFrame([(None,), ('{"id":"Q101352"}',), ("garbage",)], "instance_of string")
    out = [r[0] for r in df.select(C.is_article_page(C.instance_of_id("instance_of"))).collect()]
    assert out == [True, False, True]


def test_excluded_instances(spark):
    df = spark.createDataFrame([('{"numeric-id":577,"id":"Q577"}',), ('{"numeric-id":5,"id":"Q5"}',), (None,)],
                               "instanceof string")
    assert [r[0] for r in df.select(S.excluded_instance()).collect()] == [True, False, False]


def test_modes_keep_all_ties(spark):
    df = spark.createDataFrame([(2,), (2,), (3,), (3,), (1,)], "n bigint")
    assert [r.mode for r in E.modes(df, "n").collect()] == [2, 3]


def test_describe_matches_pandas(spark):
    import pandas as pd
    vals = [1, 2, 2, 5, 9, 10, 10, 10]
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    r = E.describe(df, "n").collect()[0]
    s = pd.Series(vals).describe()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                         ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert abs(float(r[ours]) - float(s[theirs])) < 1e-9


def test_export_empty_strings_unquoted(spark, scratch):
    prod = spark.createDataFrame(
        [("1", "T", None, None, None, "ds", 1.0, "enwiki", None, True, "2021-01")],
        "page_id string, page_title string, image_id string, confidence_rating string, source string, "
        "dataset_id string, insertion_ts double, wiki string, found_on array<string>, is_article_page boolean, "
        "snapshot string")
    D.write_exports(D.export_rows(prod), scratch + "/exp")
    import glob
    text = open(glob.glob(scratch + "/exp/wiki=enwiki/*.csv")[0]).read().splitlines()
    assert text[1] == "1\tT\t\t\t\tds\t1.0\t"


def test_html_description_and_caption():
    html = """<html><body>
      <div class="description mw-content-ltr en">first</div>
      <div class="description mw-content-ltr en"> last wins </div>
      <div class="wbmi-caption-value" lang="en">A cat</div>
      <div class="wbmi-caption-value extra" lang="fr">Un chat</div>
    </body></html>"""
    doc = H.parse(html)
    assert H.description(doc, "en", "ltr") == "last wins"
    assert H.caption(doc, "en") == "A cat"
    assert H.caption(doc, "fr") is None  # two classes
    en_fallback = H.parse('<div class="description"><div>nested</div></div>')
    assert H.description(en_fallback, "en", "ltr") is None
    assert H.description(H.parse('<td class="description">td text</td>'), "en", "ltr") == "td text"
    assert H.description(H.parse('<td class="description">td text</td>'), "fr", "ltr") is None


def test_depicts_values(spark):
    from picsel.operators import page_metadata as M
    block = lambda prop, text: f"<div data-property='{prop}' data-formatvalue='{text}'></div>"
    value = lambda lang, prop, text: f'{{"text/plain": {{"{lang}": {{"{prop}": "{text}"}}}}}}'
    html = (block("P180", f'{{"skipped": {value("en", "P180", "no")}, "b": {value("en", "P180", "cat")}, "c": {value("fr", "P180", "chat")}}}')
            + block("P275", f'{{"a": {{}}, "b": {value("en", "P275", "CC0")}}}') + block("P180", "broken") + block("P31", f'{{"a": {{}}, "b": {value("en", "P180", "x")}}}'))
    rows = [("en", "ltr", html), ("de", "ltr", html), ("en", "ltr", None), ("en", "ltr", "")]
    got = M.page_fields(spark.createDataFrame(rows, "language string, direction string, html string")).select("language", "depicts", "licence").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("en", ["cat"], "CC0"), ("de", [], None), ("en", [], None)], key=str)


def test_exact_values_are_counted_apart(spark):
    df = spark.createDataFrame([(None, 1e-7), ([""], 2e-7), ([], 3e-7), ([""], 1e-7)], "a array<string>, d double")
    got = [(r["column"], r["value"], r["count"]) for r in E.column_frequencies(df).collect()]
    assert sorted(got, key=str) == sorted([("a", None, 1), ("a", '[""]', 2), ("a", "[]", 1), ("d", "1.0E-7", 2), ("d", "2.0E-7", 1), ("d", "3.0E-7", 1)], key=str)
    assert [c for k, _, c in got if k == "a"][0] == 2


def test_std_of_large_close_values(spark):
    df = spark.createDataFrame([(10 ** 9 + i,) for i in range(4)], "n bigint")
    assert abs(E.describe(df, "n").first()["std"] - 1.2909944487) < 1e-9


def test_large_page_ids_are_served(spark):
    cols = ("page_id string, page_title string, image_id string, confidence_rating string, source string, dataset_id string, insertion_ts double, "
            "wiki string, found_on array<string>, is_article_page boolean, snapshot string")
    prod = spark.createDataFrame([(i, "T", "I.jpg", "high", "wikidata", "ds", 1.0, "enwiki", None, True, "2021-01") for i in ("3000000000", "x", "7")], cols)
    assert sorted(r.page_id for r in D.search_table(prod, "2021-01-25").collect()) == [7, 3000000000]
    assert [(r.page_id, r.n) for r in D.unserved_page_ids(prod).collect()] == [("x", 1)]
    assert 3000000000 in [r.page_id for r in D.serving_table(D.export_rows(prod)).collect()]


def test_box_stats_by_group(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 100)] + [("b", 5)], "g string, v bigint")
    got = {r.g: (r.median, r.n_outliers) for r in E.box_stats(df, "v", by=("g",)).collect()}
    assert got == {"a": (2.5, 1), "b": (5.0, 0)}
    assert E.box_stats(df, "v").count() == 1


def test_label_language_and_month(spark):
    df = spark.createDataFrame([("arwiki", "2021-01-25"), ("zh_min_nanwiki", "2020-12-28")], "w string, s string")
    out = df.select(C.label_language("w"), C.month_of("s")).collect()
    assert [tuple(r) for r in out] == [("ar", "2021-01"), ("zh_min_nan", "2020-12")]


def test_item_image_keeps_spaces_and_drops_flags(spark):
    pages = spark.createDataFrame([("enwiki", 1, '"A b.jpg"'), ("enwiki", 2, '"Flag of X.svg"')],
                                  "wiki_db string, page_id bigint, hasimage string")
    out = S.item_image_candidates(pages).collect()
    assert [(r.page_id, r.image, r.rating) for r in out] == [(1, "A b.jpg", 1.0)]


def test_schema_gate(spark, raw_data):
    import pytest
    from picsel.schemas import RAW_SCHEMA, require_schema
    require_schema(raw_data, RAW_SCHEMA)
    with pytest.raises(AttributeError):
        require_schema(raw_data.drop("snapshot"), RAW_SCHEMA)
    with pytest.raises(AttributeError):
        D.production_rows(raw_data.withColumn("page_id", F.col("page_id").cast("int")))
    # building schemas never widens a shared one
    from picsel.schemas import CSV_SCHEMA
    assert len(CSV_SCHEMA.fields) == 6 and len(RAW_SCHEMA.fields) == 8


def test_approx_median_close_to_exact(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 101)], "n bigint")
    exact = E.median(df, "n").collect()[0][0]
    approx = E.approx_median(df, "n", 0.01).collect()[0][0]
    assert abs(exact - 50.5) < 1e-9 and abs(approx - 50.5) <= 1


def test_found_on_lists_with_line_breaks(spark):
    """A list that goes on after a line break is no list to its end; a final line break does not count."""
    notes = ["image was found in the following Wikis: ab, c", "image was found in the following Wikis: ab,\n c", "image was found in the following Wikis: ab, c\n",
             "image was found in the following Wikis:\n ab", "image was found in the following Wikis:ab", "Wikis: a Wikis: b\nWikis: c", "none", "", None]
    got = spark.createDataFrame([(i, n) for i, n in enumerate(notes)], "i int, note string").select("i", C.found_on("note").alias("f")).orderBy("i").collect()
    assert [r.f for r in got] == [["ab", "c"], [""], ["ab", "c"], ["ab"], [""], ["c"], [""], [""], None]


def test_depicts_with_odd_entries(spark):
    """Entries of any shape stand beside the ones that count; the first is skipped by its place, not by its key."""
    from picsel.operators import page_metadata as M
    value = '{"text/plain": {"en": {"P180": "cat", "P275": "no"}, "fr": "flat"}}'
    blocks = ['{"z": "text", "a": %s}', '{"z": [1], "a": %s}', '{"z": null, "a": %s}', '{"z": 1, "y": 2, "x": [3], "w": {}, "v": {"text/plain": 4}, "u": {"text/plain": {"en": 5}}, "a": %s}',
              '{"a": %s}', '[%s]', '{"z": {}, "a": {"text/plain": %s}}']
    html = ["<div data-property='P180' data-formatvalue='" + b % value + "'></div>" for b in blocks]
    rows = spark.createDataFrame([(i, "en", "ltr", h) for i, h in enumerate(html)], "i int, language string, direction string, html string")
    assert [r.depicts for r in M.page_fields(rows).orderBy("i").collect()] == [["cat"]] * 4 + [[]] * 3
    assert [r.depicts for r in M.page_fields(rows.withColumn("language", F.lit("fr"))).collect()] == [[]] * 7


def test_description_classes_apart_by_more_spaces():
    assert H.description(H.parse('<div class=" description  mw-content-ltr\ten">x</div>'), "en", "ltr") == "x"
    assert H.description(H.parse('<div class="mw-content-ltr description en">x</div>'), "fr", "ltr") is None


def test_lead_images_by_bitmap(spark, monkeypatch):
    """The same ranks and notes as from lists: wikis once, twice and more often, over several bitmap words."""
    import random
    rng = random.Random(4)
    wikis = sorted({f"w{rng.randrange(10 ** 6)}wiki" for _ in range(70)})
    rows = [("enwiki", rng.randrange(40), rng.choice(wikis), f"I{rng.randrange(6)}.jpg") for _ in range(1500)]
    rows += [("enwiki", 99, wikis[0], "Twice.jpg")] * 2 + [("enwiki", 99, wikis[-1], "Twice.jpg")] + [("enwiki", 98, wikis[62 + i], "Edge.jpg") for i in range(3)]
    rows += [("enwiki", 97, wikis[1], "Often.jpg")] * 3 + [("enwiki", 97, wikis[2], "a b.jpg"), ("enwiki", 97, wikis[2], "Flag.jpg"), ("enwiki", 97, wikis[2], "")]
    leads = spark.createDataFrame(rows, "wiki_db string, page_id bigint, src_wiki string, image string")
    want = sorted(map(tuple, S.rank_lead_images(S.images_by_wiki(leads)).collect()))
    for bits in (S.WORD_BITS, 7):
        monkeypatch.setattr(S, "WORD_BITS", bits)
        assert sorted(map(tuple, S.rank_lead_images_by_bitmap(leads, wikis).collect())) == want
        flags = {r.image: r.exact for r in S.image_bitmaps(leads, wikis).where("page_id in (97, 99)").collect()}
        assert flags == {"Twice.jpg": True, "Often.jpg": False}
    assert S.rank_lead_images_by_bitmap(leads.limit(0), []).count() == 0
    plan = S.image_bitmaps(leads, wikis)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan


def test_plain_markup_gives_the_tree_of_the_parser():
    import random

    def shape(e):
        return e if isinstance(e, str) else (e.tag, e.attrs, [shape(c) for c in e.children])

    def parsed(html):
        b = H._TreeBuilder()
        b.feed(html)
        b.close()
        return shape(b.root)

    parts = ["<div>", "</div>", '<div class="a  b" lang=\'x "y"\'>', '<DIV Class="A" class="2">', "<br>", "<br/>", "</p>", "<p\n id='1>2'>", "text ", "a &amp; b", "&lt", "&lt;i&gt;", "<", ">",
             "< b", "<!-- c -->", "<td a=1>", "<td hidden>", "<a href='?x=1&amp;y'>", "<a href='?x&copy=1'>", "<script>", "</script>", "<title>", "</title>", "<b", '"', "é\u00a0", "</div >", "<x-y z='1'>", "\r\n"]
    draw = random.Random(3)
    plain = 0
    for i in range(6000):
        few = parts[:4] + parts[8:10] + parts[11:12] if i % 2 else parts
        html = "".join(draw.choice(few) for _ in range(draw.randint(1, 7)))
        fast = H._plain_tree(html)
        plain += fast is not None
        assert fast is None or shape(fast) == parsed(html), html
        assert shape(H.parse(html)) == parsed(html), html
    assert plain > 1500


def test_file_pages_are_dealt_out_before_they_are_built(spark, scratch):
    """One small file of keys is one split: its pages would all be parsed in one task."""
    from picsel.sources import standins
    n = 3 * standins.FILE_KEYS_PER_TASK
    spark.range(n).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{scratch}/part.parquet")
    pages = standins.StandIns(spark, scratch).file_pages
    sizes = [r["count"] for r in pages.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 4 * n and max(sizes) < 1.1 * 4 * n / 3
    assert pages.select("url").distinct().count() == 4 * n


def test_pages_are_never_broadcast_to_their_images(spark):
    """Built or packed page text is estimated far too small; with a high static limit a plan would gather it on the driver."""
    pages = spark.range(50).select(F.concat(F.lit("u"), "id").alias("url"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("<p>"), "id")).alias("html"))
    images = spark.range(60).select(F.lit("enwiki").alias("wiki_db"), F.col("id").cast("string").alias("image"), F.lit("en").alias("language"),
                                    F.concat(F.lit("u"), "id").alias("url"), F.lit("ltr").alias("direction"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 30))
    try:
        out = M.image_metadata(images, pages)
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        rows = out.collect()
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows) == 60 and sorted(int(r.image) for r in rows if r.depicts is not None) == list(range(0, 50, 2))
