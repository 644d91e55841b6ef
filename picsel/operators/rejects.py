"""Candidates that can't be used, kept with a reason (A4, D3).

The original loses them silently: a malformed line shifts or drops columns, and a malformed or empty candidate list gives no
production row. Here each input row is either accepted or rejected, and rows in = rows accepted + rows rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from picsel.schemas import CSV_SCHEMA, RAW_SCHEMA, TOP_CANDIDATES_DDL

LINE, REASON = "_corrupt_record", "reason"
BAD_LINE, BAD_ID, BAD_TEXT, NO_CANDIDATE, NO_IMAGE = "malformed line", "page id is no number", "malformed candidates", "empty list of candidates", "candidate without image"


def judged(raw: DataFrame) -> DataFrame:
    """``raw`` with ``reason``: why a row can't be published, NULL if it can. A page without candidate text can."""
    text, listed = F.col("top_candidates"), F.from_json("top_candidates", TOP_CANDIDATES_DDL)
    line = F.col(LINE) if LINE in raw.columns else F.lit(None).cast("string")
    reason = (
        F.when(line.isNotNull(), BAD_LINE)
        .when(F.expr("try_cast(page_id AS BIGINT)").isNull(), BAD_ID)
        .when(text.isNotNull() & listed.isNull(), BAD_TEXT)
        .when(text.isNotNull() & (F.size(listed) == 0), NO_CANDIDATE)
        .when(text.isNotNull() & F.exists(listed, lambda c: c["image"].isNull()), NO_IMAGE))
    return raw.withColumn(REASON, reason)


def accepted(rows: DataFrame) -> DataFrame:
    """The usable rows of :func:`judged`, as raw table."""
    return rows.where(F.col(REASON).isNull()).select(*RAW_SCHEMA.fieldNames())


def rejected(rows: DataFrame) -> DataFrame:
    """The other rows with their reason; a malformed line is kept as it stood."""
    line = F.col(LINE) if LINE in rows.columns else F.lit(None).cast("string")
    return rows.where(F.col(REASON).isNotNull()).select(*RAW_SCHEMA.fieldNames(), line.alias("line"), REASON)


def read_judged_tsv(spark: SparkSession, path: str, snapshot: str, header: bool = True) -> DataFrame:
    """A4 over a folder of TSV files (one ``wiki_db=...`` folder per wiki): every line as a judged row.

    A line with another number of fields is kept whole in ``_corrupt_record``. Fields are not pruned: whether a line is malformed
    must not depend on which columns a later step reads.
    """
    schema = T.StructType([*CSV_SCHEMA.fields, T.StructField(LINE, T.StringType()), T.StructField("wiki_db", T.StringType())])
    options = dict(sep="\t", escape='"', header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE, columnPruning="false")
    rows = spark.read.schema(schema).options(**options).csv(path).withColumn("snapshot", F.lit(snapshot))
    return judged(rows.select(*RAW_SCHEMA.fieldNames(), LINE))
