"""Source readers: snapshot scans, the candidates TSV, partitioned parquet tables (A1, A4, A5)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from picsel.constants import TARGET_WIKIS
from picsel.functions.columns import label_language, wiki_direction
from picsel.operators.publish import spread
from picsel.schemas import CSV_SCHEMA, RAW_SCHEMA


def snapshot_scan(df: DataFrame, snapshot: str, wikis: Iterable[str] | None = None) -> DataFrame:
    """A1: one snapshot of a table, optionally a set of wikis.

    The predicates stay on the raw partition columns so that they prune partitions / push into the scan.
    """
    out = df.where(F.col("snapshot") == F.lit(snapshot))
    if wikis is not None:
        out = out.where(F.col("wiki_db").isin(*list(wikis)))
    return out


def target_wikis(df: DataFrame, wikis: Iterable[str] = TARGET_WIKIS, col: str = "wiki_db") -> DataFrame:
    """A5: keep the client-facing wikis (a literal IN list: the filter pushes into the scan)."""
    return df.where(F.col(col).isin(*list(wikis)))


def write_snapshot_table(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """A source table as Parquet partitioned by (snapshot, wiki_db), as A1 expects it; a large partition gets several files."""
    others = [c for c in df.columns if c not in ("snapshot", "wiki_db")]
    out = spread(df, ["snapshot", "wiki_db"], others, rows_per_file)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot", "wiki_db").parquet(path)


def read_snapshot_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by :func:`write_snapshot_table`; the schema keeps partition values text."""
    return spark.read.schema(schema).parquet(path)


def scan_for_wikis(table: DataFrame, snapshot: str, wikis: DataFrame) -> DataFrame:
    """A1 with A5: one snapshot, and of it the wikis of a (filtered) wiki table.

    The wiki table has one row per wiki and is broadcast; Spark prunes the partitions of ``table`` at runtime by that
    broadcast, so only the files of the wanted wikis are opened, whichever rows the wiki table turns out to hold.
    """
    # a comparison: only a side that is filtered is used to prune partitions at runtime
    wanted = wikis.where(F.col("wiki_db") > "").select("wiki_db").distinct()
    return snapshot_scan(table, snapshot).join(F.broadcast(wanted), "wiki_db", "left_semi")


def wiki_table(spark: SparkSession, wikis: Iterable[str] = TARGET_WIKIS) -> DataFrame:
    """The configured wikis as a dimension table: wiki_db, language, direction."""
    rows = spark.createDataFrame([(w,) for w in wikis], "wiki_db string")
    return rows.select("wiki_db", label_language("wiki_db").alias("language"), wiki_direction("wiki_db").alias("direction"))


def read_candidates_tsv(spark: SparkSession, path: str, wiki: str, snapshot: str,
                        header: bool = True) -> DataFrame:
    """A4: the candidates TSV with its fixed all-string schema, plus wiki_db / snapshot literals.

    ``header=False`` reproduces the original reader, which turns the header line into a data row.
    """
    return (
        spark.read.schema(CSV_SCHEMA)
        .options(sep="\t", escape='"', header=str(header).lower())
        .csv(path)
        .withColumn("wiki_db", F.lit(wiki))
        .withColumn("snapshot", F.lit(snapshot))
    )


def read_partitioned_tsv(spark: SparkSession, path: str, snapshot: str) -> DataFrame:
    """A4 over a directory written by ``write_candidates`` (one ``wiki_db=...`` folder per wiki)."""
    return (
        spark.read.schema(_csv_with_wiki_schema())
        .options(sep="\t", escape='"', header="true")
        .csv(path)
        .withColumn("snapshot", F.lit(snapshot))
        .select(*RAW_SCHEMA.fieldNames())
    )


def _csv_with_wiki_schema() -> T.StructType:
    return T.StructType(list(CSV_SCHEMA.fields) + [T.StructField("wiki_db", T.StringType(), True)])


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The raw table as written by ``publish_raw`` (forced schema; partition columns discovered)."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)
