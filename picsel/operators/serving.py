"""The serving table (D16) as files that answer lookups by (wiki, page_id): the index that the original's database had.

Three things keep a lookup from reading the table. Files lie in one folder per wiki; within a wiki, rows are dealt out by ranges of
the page id and sorted, so row groups have narrow, disjoint id ranges; and each row group has a Bloom filter of its ids. A few
literal ids reach the scan as predicates, which uses all three. A table of keys prunes the folders at runtime by its wikis and the
row groups by its smallest and largest id, and the rest is a join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SERVING_DDL = ("page_id bigint, page_title string, image_id string, confidence_rating string, source string, dataset_id string, "
               "insertion_ts double, found_on string, wiki string")
#: Rows of a row group: what a lookup of one page reads at most.
ROWS_PER_GROUP = 20_000


def write_serving(serving: DataFrame, path: str, rows_per_group: int = ROWS_PER_GROUP) -> None:
    """D16 (write half). Ranges of (wiki, page_id) go to one task each, so a large wiki is spread over many files."""
    rows = serving.select(*[c.split()[0] for c in SERVING_DDL.split(", ")])
    (
        rows.repartitionByRange("wiki", "page_id").sortWithinPartitions("wiki", "page_id")
        .write.mode("overwrite").partitionBy("wiki")
        .option("parquet.block.row.count.limit", rows_per_group)
        .option("parquet.bloom.filter.enabled#page_id", "true").option("parquet.bloom.filter.expected.ndv#page_id", rows_per_group)
        .option("parquet.enable.dictionary#page_id", "false")  # ids hardly repeat, and a dictionary would replace the filter
        .parquet(path)
    )


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERVING_DDL).parquet(path)


def lookup_pages(served: DataFrame, wiki: str, page_ids: Iterable[int]) -> DataFrame:
    """The rows of a few pages of one wiki (a client's request). Up to ten ids are compared with statistics and Bloom
    filters one by one (``spark.sql.parquet.pushdown.inFilterThreshold``), more by their range."""
    return served.where((F.col("wiki") == wiki) & F.col("page_id").isin(*page_ids))


def lookup(served: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of the pages in ``keys`` (wiki, page_id; repeated and NULL keys do no harm).

    ``keys`` is read for its wikis, its id range and the join. The broadcast side has one row per wiki.
    """
    # a comparison: only a side that is filtered is used to prune partitions at runtime
    keys = keys.select("wiki", F.col("page_id").cast("bigint").alias("page_id")).where((F.col("wiki") > "") & F.col("page_id").isNotNull())
    wikis = F.broadcast(keys.select("wiki").distinct())
    # two subqueries that Spark does not merge into one: only a plain value reaches the scan's row groups
    least, most = (keys.orderBy(order).limit(1).select("page_id").scalar() for order in (F.col("page_id"), F.col("page_id").desc()))
    near = served.where((F.col("page_id") >= least) & (F.col("page_id") <= most)).join(wikis, "wiki", "left_semi")
    return near.join(keys.distinct(), ["wiki", "page_id"], "left_semi")
