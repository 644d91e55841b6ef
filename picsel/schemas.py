"""Immutable schemas of the tables the pipeline writes.

Built from field lists, never with ``StructType.add`` on a shared object (that mutates in place).
"""

from pyspark.sql import types as T

_S = T.StringType()

# ---------------------------------------------------------------------------
# FIXED VALUES (field names and types of the tables that are exchanged)
# ---------------------------------------------------------------------------

CSV_FIELDS = ("pandas_idx", "item_id", "page_id", "page_title", "top_candidates", "instance_of")
RAW_FIELDS = CSV_FIELDS + ("wiki_db", "snapshot")

CSV_SCHEMA = T.StructType([T.StructField(n, _S, True) for n in CSV_FIELDS])
RAW_SCHEMA = T.StructType([T.StructField(n, _S, True) for n in RAW_FIELDS])

TOP_CANDIDATES_DDL = "array<struct<image:string,note:string,rating:double>>"
INSTANCE_OF_DDL = "struct<`entity-type`:string,`numeric-id`:bigint,id:string>"

PRODUCTION_COLUMNS = (
    "wiki", "page_id", "page_title", "image_id", "confidence_rating", "source",
    "instance_of", "found_on", "is_article_page",
)

# ---------------------------------------------------------------------------
# End of fixed values
# ---------------------------------------------------------------------------


def require_schema(df, schema: T.StructType) -> None:
    """Exact field names and types, in order, else AttributeError. Runs no job.

    Nullability is not compared: literal columns are non-nullable in Spark, but the stored table is not.
    """
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise AttributeError(f"Invalid schema. Expected '{schema}'. Got '{df.schema}'")
