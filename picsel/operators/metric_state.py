"""Metric state kept per snapshot (E1, E5-E7, E14-E19): counts that add up and sketches that merge, so that a new snapshot is
read once and an old one never again.

    <path>/counts/snapshot=<s>/     wiki, metric, key, n     rows of the production table by wiki, pages by their number of images, ...
    <path>/sketches/snapshot=<s>/   wiki, sketch             quantile sketch of the numbers of wikis that suggestions were found on

The state of a snapshot has a few rows for each wiki. Reports read the state only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from picsel.operators import metrics as E

COUNTS_DDL = "wiki string, metric string, key string, n bigint, snapshot string"
SKETCHES_DDL = "wiki string, sketch binary, snapshot string"
RECORDS, IMAGES, CONFIDENCE, FOUND_ON = "records", "images_per_page", "confidence", "found_on"


def counts(prod: DataFrame, snapshot: str) -> DataFrame:
    """The counts of one snapshot: wiki, metric, key, n. Pages are counted within their wiki, so counts of snapshots add up."""
    one = prod.where(F.col("snapshot") == snapshot)
    pages = one.groupBy("wiki", "page_id").agg(F.count(F.lit(1)).alias("n_images"))
    count = lambda df, metric, key: df.groupBy("wiki", F.lit(metric).alias("metric"), key.cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return (
        count(one, RECORDS, F.lit(None)).unionByName(count(pages, IMAGES, F.col("n_images")))
        .unionByName(count(one, CONFIDENCE, F.col("confidence_rating")))
        .unionByName(count(E.found_on_sizes(one), FOUND_ON, F.col("num_languages"))))


def update(prod: DataFrame, path: str, snapshot: str) -> None:
    """Write (or replace) the state of one snapshot of the production table; the table's other partitions are not read."""
    one = prod.where(F.col("snapshot") == snapshot)
    sketches = E.quantile_sketches(E.found_on_sizes(one), "num_languages", ("wiki",))
    for name, df in (("counts", counts(prod, snapshot)), ("sketches", sketches)):
        rows = df.withColumn("snapshot", F.lit(snapshot)).coalesce(1)  # some rows a wiki
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot").parquet(f"{path}/{name}")


def _counts(spark: SparkSession, path: str, metric: str) -> DataFrame:
    return spark.read.schema(COUNTS_DDL).parquet(f"{path}/counts").where(F.col("metric") == metric)


def snapshot_counts(spark: SparkSession, path: str) -> DataFrame:
    """E1 / E19 from the state: rows per snapshot and wiki."""
    return _counts(spark, path, RECORDS).select("snapshot", "wiki", "n")


def suggestion_histogram(spark: SparkSession, path: str) -> DataFrame:
    """E6 from the state: pages by their number of rows, per snapshot and over all of them (snapshot NULL)."""
    rows = _counts(spark, path, IMAGES).select("snapshot", F.col("key").cast("bigint").alias("n_images"), "n")
    return rows.rollup("n_images", "snapshot").agg(F.sum("n").alias("n_pages")).where(F.col("n_images").isNotNull())


def suggestions_by_confidence(spark: SparkSession, path: str) -> DataFrame:
    """E7 from the state, per snapshot."""
    return _counts(spark, path, CONFIDENCE).select("snapshot", "wiki", F.col("key").alias("confidence_rating"), F.col("n").alias("n_suggestions"))


def found_on_histogram(spark: SparkSession, path: str) -> DataFrame:
    """E15 from the state, per snapshot."""
    rows = _counts(spark, path, FOUND_ON)
    return rows.groupBy("snapshot", F.col("key").cast("bigint").alias("num_languages")).agg(F.sum("n").alias("n"))


def found_on_median(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """E17 (approximate) from the state: the median over all snapshots, or per group of ``by`` (wiki, snapshot)."""
    return E.merged_quantile(spark.read.schema(SKETCHES_DDL).parquet(f"{path}/sketches"), 0.5, by)
