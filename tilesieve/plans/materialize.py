"""Write the chosen tiles as shards of their own, with a manifest that addresses them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import basename
from ..operators.joins import rebase_manifest, renumber_row_groups
from ..session import written
from ..sources.tiles import addresses, extract_subset_rows, missing_rows, row_groups, write_shards


@dataclass(frozen=True)
class Materialized:
    manifest: DataFrame
    report: DataFrame


def materialize_subset(
    spark: SparkSession, images_dir: str, subset: DataFrame, dest: str, bands: Sequence[str] | None = None, kind: str = "binary"
) -> Materialized:
    """Extract the rows of the subset to ``dest``/images and the new manifest to ``dest``/metadata.

    Rows are copied with all their columns, or with ``bands`` of type ``kind`` only.

    Rows whose shard or row is absent or unreadable do not stop the others.  What counts is what
    was written: the manifest holds the rows found in the new shards, and the report,
    (shard, n_rows, n_missing, complete), the rest.
    """
    images, metadata = f"{dest.rstrip('/')}/images", f"{dest.rstrip('/')}/metadata"
    subset = written(subset, "subset")
    groups = written(row_groups(spark, images_dir, subset, tolerant=True), "groups")
    absent = addresses(subset, groups).filter(F.col("row_in_file").isNull()).select("row_id")
    present = written(subset.join(absent, "row_id", "left_anti"), "present")
    write_shards(extract_subset_rows(spark, images_dir, present, bands, kind=kind, tolerant=True, starts=groups), images)
    renumbered = written(renumber_row_groups(present, images), "renumbered")
    lost = missing_rows(spark, images, renumbered).select("row_id")
    rebase_manifest(renumbered.join(lost, "row_id", "left_anti")).write.parquet(metadata)
    manifest = spark.read.parquet(metadata)
    kept = manifest.select("row_id", F.lit(1).alias("_kept"))
    report = (
        subset.select("row_id", basename(F.col("parquet_file")).alias("shard"))
        .join(kept, "row_id", "left")
        .groupBy("shard")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_kept").isNull()).alias("n_missing"))
        .withColumn("complete", F.col("n_missing") == 0)
    )
    return Materialized(manifest, report)
