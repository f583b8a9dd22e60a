"""Session helpers: recommended settings, the shared folder, and written lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Upper bound for anything that is shipped whole to every executor.  All broadcasts of this
# package are measured against it first and split into several bounded ones when they exceed it.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Tiles are megabytes per row: Arrow batches are bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings this package is designed for to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; every executor can reach it.

    Where the setting is absent a temporary folder is used, but only on a ``local`` master: a
    machine-local folder on a cluster would be lost together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tilesieve-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one table below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/tilesieve/{app}/{label}-{uuid.uuid4().hex}"


def hinted(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """A local, broadcast copy of a table that has at most ``rows`` rows; otherwise the table.

    For the small side of a join on a key that may be hot: the other side is not shuffled.
    """
    head = df.limit(rows + 1).collect()
    if len(head) > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df``: write it once to the shared folder and read it back.

    The result does not depend on any executor staying alive, and every later use of it is a
    columnar, prunable scan instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
