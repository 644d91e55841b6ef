"""Properties of the publication transform on a few hand-made pages."""

import json

import pytest
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.functions.columns import found_on
from picsel.operators.publish import explode_candidates, production_rows
from picsel.schemas import PRODUCTION_COLUMNS


@pytest.fixture(scope="module")
def pages(raw_data):
    out = {}
    for r in production_rows(raw_data).collect():
        out.setdefault(r.page_id, []).append(r)
    return out


def test_a_row_per_candidate_and_one_for_pages_without_text(raw_data, pages):
    assert production_rows(raw_data).columns == list(PRODUCTION_COLUMNS)
    assert {i: len(rows) for i, rows in pages.items()} == {"7001": 1, "7002": 3, "7003": 1}
    assert explode_candidates(raw_data).count() == 4


def test_source_decides_confidence(pages):
    seen = {(r.source, r.confidence_rating) for rows in pages.values() for r in rows}
    assert seen == {("wikidata", "high"), ("wikipedia", "medium"), ("commons", "low"), (None, None)}


def test_page_without_text_is_all_null(pages):
    lone = pages["7003"][0]
    assert (lone.image_id, lone.source, lone.confidence_rating, lone.found_on, lone.instance_of) == (None,) * 5 and lone.is_article_page


def test_instances_and_articles(pages):
    assert {r.instance_of for r in pages["7002"]} == {"Q577"} and not any(r.is_article_page for r in pages["7002"])
    assert all(r.is_article_page and r.instance_of is None for r in pages["7001"])


@pytest.mark.parametrize("note, wikis", [
    (K.NOTE_WIKIPEDIA_PREFIX + "dewiki,  plwiki,svwiki", ["dewiki", "plwiki", "svwiki"]), (K.NOTE_WIKIPEDIA_PREFIX, [""]),
    (K.NOTE_WIKIDATA, [""]), ("", [""]), (None, None), ("Wikis:dewiki", [""]), ("a Wikis:  x Wikis: y,z", ["xWikis:y", "z"])])
def test_wikis_of_a_note(spark, note, wikis):
    assert spark.createDataFrame([(note,)], "note string").select(found_on("note")).first()[0] == wikis


def test_text_is_parsed_once(raw_data):
    plan = production_rows(raw_data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") <= 2 and "Union" not in plan


def test_json_round_trip(raw_data):
    name = 'It\'s "x".jpg'
    text = json.dumps([{"image": name, "rating": 1, "note": K.NOTE_WIKIDATA}])
    assert production_rows(raw_data.limit(1).withColumn("top_candidates", F.lit(text))).first().image_id == name
