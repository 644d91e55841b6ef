"""Publication with a commit (D1 / D10): files are written beside the published ones and published by a manifest.

    <path>/data/write=<id>/<partition folders>/*.parquet     files of one publication, never changed
    <path>/manifest/version=<n>/*.parquet                    one row a file: where, its partition, its rows, a checksum of them

A publication replaces the partitions that its rows have. It (1) writes its files, (2) reads them back and compares rows and
checksum with what was sent, (3) writes the next manifest, the old one's files of the other partitions and its own, as one
file. Readers follow the highest manifest, so they see all of a publication or nothing of it: what a killed writer has left is
in no manifest. Two writers at once would make the same version; the second to write it fails.

A checksum is the XOR of a hash of each row, so it does not depend on the rows' order. The manifest has one row for each
file and is the only thing that is gathered on the driver, as Spark's own list of files is.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from picsel.operators.publish import ROWS_PER_FILE, spread
from picsel.session import materialize

MANIFEST_DDL = "file string, partition map<string,string>, n_rows bigint, checksum bigint"


class PublicationError(RuntimeError):
    """The written files do not hold what was sent."""


def _checksum(columns: list[str]) -> Column:
    return F.coalesce(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in columns])), F.lit(0))


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.schema(f"{MANIFEST_DDL}, version int").parquet(f"{path}/manifest")


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the last publication, 0 before the first."""
    found = _manifests(spark, path)
    return 0 if found is None else found.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The files of a publication (the last one unless ``version`` is given): file, partition, n_rows, checksum."""
    version = current_version(spark, path) if version is None else version
    found = _manifests(spark, path)
    if found is None or not version:
        return spark.createDataFrame([], MANIFEST_DDL)
    return found.where(F.col("version") == version).drop("version")


def _written(spark: SparkSession, path: str, schema: T.StructType, files: list[str]) -> DataFrame:
    """Rows of the files, which lie below ``<path>/data``, with ``_file`` relative to it."""
    full = T.StructType([*schema.fields, T.StructField("write", T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in files])
    return rows.withColumn("_file", F.substring_index(F.col("_metadata.file_path"), "/data/write=", -1)).withColumn("_file", F.concat(F.lit("write="), "_file")).drop("write")


def _by_file(rows: DataFrame, columns: list[str], partition_by: list[str]) -> DataFrame:
    values = F.create_map(*[x for c in partition_by for x in (F.lit(c), F.first(F.col(c).cast("string")))])
    return rows.groupBy(F.col("_file").alias("file")).agg(values.alias("partition"), F.count(F.lit(1)).alias("n_rows"), _checksum(columns).alias("checksum"))


def publish(df: DataFrame, path: str, partition_by: list[str], spread_by: list[str], sort: list[Column] | None = None, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Publish ``df``: its partitions replace those of the same values, all at once. Returns the new version."""
    spark, write = df.sparkSession, f"write={uuid.uuid4().hex}"
    sent = Observation()
    rows = materialize(df.observe(sent, F.count(F.lit(1)).alias("n"), _checksum(df.columns).alias("checksum")), name="to-publish")
    out = spread(rows, partition_by, spread_by, rows_per_file)
    if sort:
        out = out.sortWithinPartitions(*partition_by, *sort)
    out.write.partitionBy(*partition_by).parquet(f"{path}/data/{write}")
    if not sent.get["n"]:  # a publication of nothing replaces nothing
        return current_version(spark, path)
    new = materialize(_by_file(_written(spark, path, df.schema, [write]), df.columns, partition_by), name="manifest")
    total = new.agg(F.sum("n_rows").alias("n"), F.bit_xor("checksum").alias("checksum")).first()
    if (total["n"], total["checksum"]) != (sent.get["n"], sent.get["checksum"]):
        raise PublicationError(f"{path}/data/{write} has {total['n']} of {sent.get['n']} rows, checksum {total['checksum']} for {sent.get['checksum']}")
    version = current_version(spark, path)
    old = manifest(spark, path, version)
    same = [F.element_at(F.col("o.partition"), c).eqNullSafe(F.element_at(F.col("n.partition"), c)) for c in partition_by]
    kept = old.alias("o").join(new.alias("n"), reduce(lambda a, b: a & b, same), "left_anti")
    # one file: its rename is the commit
    kept.unionByName(new).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={version + 1}")
    return version + 1


def read(spark: SparkSession, path: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The published rows (of the last publication unless ``version`` is given); ``schema`` includes the partition columns."""
    files = [r["file"] for r in manifest(spark, path, version).select("file").collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return _written(spark, path, schema, files).drop("_file")


def damaged(spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str]) -> DataFrame:
    """Files of the last publication whose rows no longer match the manifest: file, the manifest's and the found n_rows and checksum."""
    listed = manifest(spark, path)
    files = [r["file"] for r in listed.select("file").collect()]
    found = _by_file(_written(spark, path, schema, files), schema.fieldNames(), partition_by) if files else listed
    both = listed.join(found.select("file", F.col("n_rows").alias("found_rows"), F.col("checksum").alias("found_checksum")), "file", "left")
    return both.where(~(F.col("n_rows").eqNullSafe(F.col("found_rows")) & F.col("checksum").eqNullSafe(F.col("found_checksum")))).drop("partition")
