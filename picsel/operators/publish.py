"""Publication (D1-D16): raw table -> production rows -> search feed, exports, serving table.

Transforms are pure DataFrame functions; writers are kept apart and write partition by partition with
dynamic overwrite, one task per output file (as many as a partition's counted rows need).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.functions.columns import confidence_rating, found_on, instance_of_id, is_article_page, source_of
from picsel.schemas import PRODUCTION_COLUMNS, RAW_SCHEMA, TOP_CANDIDATES_DDL, require_schema
from picsel.session import materialize


def _candidate_rows(raw: DataFrame) -> DataFrame:
    """``raw`` with one ``candidate`` per row: parsed once; a NULL text keeps its page with a NULL candidate, a malformed or
    empty one drops it."""
    parsed = raw.withColumn("candidates", F.from_json("top_candidates", TOP_CANDIDATES_DDL))
    listed = parsed.where(F.col("top_candidates").isNull() | (F.size("candidates") > 0))
    return listed.withColumn("candidate", F.explode_outer("candidates")).drop("candidates")


def explode_candidates(raw: DataFrame) -> DataFrame:
    """D3: the candidates of each page as rows with image, rating and note.

    Malformed text and ``[]`` give no row at all; Python-repr text (single quotes) still parses.
    """
    return _candidate_rows(raw).where(F.col("top_candidates").isNotNull()).select("*", "candidate.*").drop("candidate")


def production_rows(raw: DataFrame, check_schema: bool = True) -> DataFrame:
    """One typed row per candidate, and one with NULLs per page without a candidate text; one pass over ``raw``."""
    if check_schema:
        require_schema(raw, RAW_SCHEMA)
    rows = _candidate_rows(raw)
    return rows.withColumns({
        "wiki": F.col("wiki_db"), "image_id": F.col("candidate.image"), "source": source_of("candidate.note"),
        "confidence_rating": confidence_rating("candidate.rating"), "found_on": found_on("candidate.note"),
        "instance_of": instance_of_id("instance_of"), "is_article_page": is_article_page(instance_of_id("instance_of")),
    }).select(*PRODUCTION_COLUMNS)


def production_table(rows: DataFrame, snapshot: str, dataset_id: str, insertion_ts: float) -> DataFrame:
    """D10 (transform half): rows + dataset_id, insertion_ts (epoch seconds), snapshot literal."""
    return (
        rows.withColumn("dataset_id", F.lit(dataset_id))
        .withColumn("insertion_ts", F.lit(float(insertion_ts)).cast("double"))
        .withColumn("snapshot", F.lit(snapshot))
    )


def _numeric_id() -> Column:
    return F.expr("try_cast(page_id AS BIGINT)")


def unserved_page_ids(prod: DataFrame) -> DataFrame:
    """Rows per wiki and page id of the production rows whose page id is no 64-bit number."""
    return prod.where(_numeric_id().isNull()).groupBy("wiki", "page_id").agg(F.count(F.lit(1)).alias("n"))


def search_table(prod: DataFrame, date: str, snapshot: str | None = None) -> DataFrame:
    """One row per article page with at least one image (not per image).

    ``snapshot`` restricts the input to one snapshot (the original read every snapshot). Page ids that are no 64-bit
    numbers can't be served; :func:`unserved_page_ids` lists them.
    """
    if snapshot is not None:
        prod = prod.where(F.col("snapshot") == snapshot)
    year, month, day = (int(x) for x in date.split("-"))
    return (
        prod.where(F.col("image_id").isNotNull() & (F.col("is_article_page") == F.lit(True)) & _numeric_id().isNotNull())
        .select(
            F.col("wiki").alias("wikiid"),
            _numeric_id().alias("page_id"),
            F.lit(K.SEARCH_PAGE_NAMESPACE).cast("int").alias("page_namespace"),
            F.lit(K.SEARCH_RECOMMENDATION_TYPE).alias("recommendation_type"),
            F.lit(year).cast("int").alias("year"), F.lit(month).cast("int").alias("month"),
            F.lit(day).cast("int").alias("day"),
        )
        .distinct()
    )


def export_rows(prod: DataFrame, snapshot: str | None = None, wikis=None, android: bool = False) -> DataFrame:
    """Article pages, NULL -> '' for image_id / confidence_rating / source, found_on joined by ','.

    ``android=True`` (D13) keeps only rows with an image.
    """
    out = prod.where(F.col("is_article_page") == F.lit(True))
    if snapshot is not None:
        out = out.where(F.col("snapshot") == snapshot)
    if wikis is not None:
        out = out.where(F.col("wiki").isin(*list(wikis)))
    if android:
        out = out.where(F.col("image_id").isNotNull())
    return out.select(
        "page_id", "page_title",
        F.coalesce("image_id", F.lit("")).alias("image_id"),
        F.coalesce("confidence_rating", F.lit("")).alias("confidence_rating"),
        F.coalesce("source", F.lit("")).alias("source"),
        "dataset_id", "insertion_ts", "wiki",
        F.concat_ws(",", "found_on").alias("found_on"),
    )


def export_summary(exports: DataFrame) -> DataFrame:
    """Occurrences of each (image_id, confidence_rating) over the exports (no header rows)."""
    return exports.groupBy("image_id", "confidence_rating").agg(F.count(F.lit(1)).alias("n")).orderBy("image_id", "confidence_rating")


def serving_table(exports: DataFrame, wikis=K.TARGET_WIKIS) -> DataFrame:
    """The target wikis' exports with typed columns, keyed (wiki, page_id) for lookups."""
    return exports.where(F.col("wiki").isin(*list(wikis))).select(
        _numeric_id().alias("page_id"), "page_title", "image_id", "confidence_rating",
        "source", "dataset_id", F.col("insertion_ts").cast("double").alias("insertion_ts"), "wiki", "found_on",
    )


# --------------------------------------------------------------------------------------------------
# Writers (actions). Partitioned, dynamic overwrite: only the partitions present in the data are replaced.
# --------------------------------------------------------------------------------------------------

def _dynamic(writer):
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")


#: Rows of an output file, about.
ROWS_PER_FILE = 1_000_000


def spread(df: DataFrame, partition_cols: list[str], row_cols: list[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` dealt to one task per output file: a partition gets as many files as its counted rows need.

    Its rows are spread over them by a hash of ``row_cols``, so that the largest wiki is not one task. The counts have one
    row per output partition.
    """
    missing = [c for c in partition_cols + row_cols if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    names = [f"_p{i}" for i in range(len(partition_cols))]
    files = df.groupBy(*[F.col(c).alias(n) for c, n in zip(partition_cols, names)]).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_files"))
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(partition_cols, names)]
    salted = df.join(F.broadcast(files), reduce(lambda a, b: a & b, same)).withColumn(
        "_file", F.pmod(F.xxhash64(*row_cols), F.col("_files")))
    return salted.repartition(*partition_cols, "_file").select(*df.columns)


def write_candidates(cands_raw: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Candidates as TSV with a header, one folder per wiki (top_candidates as JSON text)."""
    cols = ["pandas_idx", "item_id", "page_id", "page_title", "top_candidates", "instance_of", "wiki_db"]
    out = spread(cands_raw.select(*cols), ["wiki_db"], ["page_id"], rows_per_file)
    _dynamic(out.write.partitionBy("wiki_db")).options(sep="\t", header="true", escape='"').csv(path)


def publish_raw(raw: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Raw rows as parquet partitioned by wiki_db, snapshot."""
    out = spread(raw, ["wiki_db", "snapshot"], ["page_id"], rows_per_file)
    _dynamic(out.write.partitionBy("wiki_db", "snapshot")).parquet(path)


def publish_production(prod: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """D10 (write half): partitioned by wiki and snapshot; every file is sorted by page_title descending.

    The rows are staged first: over a constant ``snapshot`` column Spark would not see that our order starts with the
    partition columns, and sort each task again without the title.
    """
    rows = materialize(prod, name="production-rows")
    out = spread(rows, ["wiki", "snapshot"], ["page_id"], rows_per_file)
    out = out.sortWithinPartitions("wiki", "snapshot", F.col("page_title").desc())
    _dynamic(out.write.partitionBy("wiki", "snapshot")).parquet(path)


def publish_search(search: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """D11 (write half): partitioned by year, month, day."""
    out = spread(search, ["year", "month", "day"], ["wikiid", "page_id"], rows_per_file)
    _dynamic(out.write.partitionBy("year", "month", "day")).parquet(path)


def write_exports(exports: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """D12 / D13 (write half): Hive-text-like TSV per wiki; empty strings unquoted, NULL as \\N."""
    out = spread(exports, ["wiki"], ["page_id"], rows_per_file)
    _dynamic(out.write.partitionBy("wiki")).options(sep="\t", header="true", emptyValue="", quote="\u0000", nullValue="\\N").csv(path)


def register_tables(spark: SparkSession, raw_path: str, prod_path: str, search_path: str,
                    database: str | None = None) -> None:
    """External partitioned parquet tables over the written folders, partitions discovered."""
    prefix = f"{database}." if database else ""
    ddl = {
        "imagerec": (raw_path, "pandas_idx string, item_id string, page_id string, page_title string, "
                     "top_candidates string, instance_of string, wiki_db string, snapshot string",
                     "wiki_db, snapshot"),
        "imagerec_prod": (prod_path, "page_id string, page_title string, image_id string, "
                          "confidence_rating string, source string, instance_of string, is_article_page boolean, "
                          "dataset_id string, insertion_ts double, found_on array<string>, wiki string, "
                          "snapshot string", "wiki, snapshot"),
        "search_imagerec": (search_path, "wikiid string, page_id bigint, page_namespace int, "
                            "recommendation_type string, year int, month int, day int", "year, month, day"),
    }
    for name, (path, cols, parts) in ddl.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({cols}) USING parquet "
                  f"PARTITIONED BY ({parts}) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {prefix}{name}")
