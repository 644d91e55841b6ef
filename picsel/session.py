"""Session helpers. Jobs take the session they are given; these helpers are for tests, bench and CLI."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "picsel") -> SparkSession:
    """A local session configured the way the jobs expect a cluster session to be (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: let AQE keep several post-shuffle tasks instead of coalescing to one
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("PICSEL_MIN_PARTITION_SIZE", "64k"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # broadcast only what AQE has measured at runtime, never a plan-time size estimate
        .config("spark.sql.autoBroadcastJoinThreshold", os.environ.get("PICSEL_STATIC_BROADCAST", "-1"))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PICSEL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster it names a folder that all executors share and is used as is; without it the call fails there. Only a
    local master, whose tasks run on this machine, gets a fresh scratch folder when it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        current = current or sc.getCheckpointDir()
    except Exception:  # noqa: BLE001  (no SparkContext on a Connect session)
        sc = None
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="picsel-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def application_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", "app")


def materialize(df: DataFrame, enabled: bool = True, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a parquet stage table under ``spark.checkpoint.dir`` and read it back.

    One job computes and writes (``Dataset.checkpoint`` would compute twice without a cache); the result
    has no lineage, survives executor loss, and later scans get column pruning and filter pushdown.
    Never a local checkpoint or a machine-local folder: the folder is the session's shared checkpoint dir.
    """
    if not enabled:
        return df
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_root(spark: SparkSession) -> str:
    """Where this application's stage tables lie."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/picsel-stages/{application_id(spark)}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for clusters on which it is not installed (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_picsel_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="picsel-"), "picsel.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("picsel", os.path.relpath(full, root)))
    sc.addPyFile(path)  # served by the driver to every executor
    sc._picsel_shipped = True
