import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from picsel import constants as K  # noqa: E402
from picsel.schemas import RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]").appName("picsel-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="picsel-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="picsel-test-", dir="/tmp")


def candidate(image: str, rating: float, note: str) -> dict:
    return {"image": image, "rating": rating, "note": note}


@pytest.fixture(scope="session")
def raw_data(spark):
    """Four pages: one candidate of each source, all three sources and a year item, no text, and a text that is not JSON."""
    item, wikis, files = K.NOTE_WIKIDATA, K.NOTE_WIKIPEDIA_PREFIX, K.NOTE_COMMONS
    year = json.dumps({"entity-type": "item", "numeric-id": 577, "id": "Q577"})
    three = [candidate("Bridge.jpg", 2.0, wikis + "dewiki, plwiki"), candidate("Tower.jpg", 1, item), candidate("Gate.jpg", 3.0, files)]
    rows = [("10", "Q20", "7001", "Old bridge", json.dumps([candidate("Bridge.jpg", 2.1, wikis + "plwiki")]), None, "frwiki", "2022-06"),
            ("11", "Q21", "7002", "1812", json.dumps(three), year, "frwiki", "2022-06"),
            ("12", "Q22", "7003", "Lone page", None, None, "kowiki", "2022-06"),
            ("13", "Q23", "7004", "Broken page", "no json here", "neither", "kowiki", "2022-06")]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def same_rows(a, b) -> bool:
    """Same columns and the same multiset of rows (stricter than a set difference)."""
    return sorted(a.columns) == sorted(b.columns) and \
        a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()
