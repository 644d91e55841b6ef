"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from picsel.session import application_id, ensure_checkpoint_dir

#: Bytes that separate words everywhere in this subpackage: ``bytes.split()`` cuts at exactly these.
SPACE = b" \t\n\r\x0b\x0c"
#: Spark's setting that removes a query's shuffle files as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/picsel-llm/{application_id(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later steps depend on the files only, so a lost executor costs at most the tasks of the running step. The write's own
    shuffle files go when it has ended.
    """
    spark = df.sparkSession
    path, old = stage_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)
    return spark.read.schema(df.schema).parquet(path)


def batches(schema: pa.Schema, rows: Callable[[pa.RecordBatch], Iterable[list]]) -> Callable:
    """A ``mapInArrow`` function from one that turns a batch into lists of columns."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for columns in rows(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8")


def blocks(it: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices whose ``column`` holds about ``most`` bytes (a longer single row stays whole)."""
    for batch in it:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


import pyarrow.compute  # noqa: E402,F401  (registers pa.compute)
