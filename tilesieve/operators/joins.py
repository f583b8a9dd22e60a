"""Joins between manifests, embeddings and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import basename, joined_path
from .ranking import first_per_group, rank_within


def align_manifest(manifest: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Manifest rows that have an embedding."""
    return manifest.join(embeddings.select("row_id"), "row_id", "left_semi")


def alignment_report(manifest: DataFrame, embeddings: DataFrame) -> DataFrame:
    """One row: sizes of both sides and how many ids only one side has."""
    both = manifest.select("row_id", F.lit(1).alias("_m")).join(
        embeddings.select("row_id", F.lit(1).alias("_e")), "row_id", "full_outer"
    )
    return both.agg(
        F.count("_m").alias("n_manifest"),
        F.count("_e").alias("n_embeddings"),
        F.count_if(F.col("_e").isNull()).alias("manifest_only"),
        F.count_if(F.col("_m").isNull()).alias("embeddings_only"),
    )


def check_alignment(manifest: DataFrame, embeddings: DataFrame) -> None:
    """ValueError with both row counts where manifest and embeddings do not cover the same ids."""
    row = alignment_report(manifest, embeddings).first()
    if row["manifest_only"] or row["embeddings_only"]:
        raise ValueError(
            f"manifest ({row['n_manifest']} rows) and embeddings ({row['n_embeddings']} rows) do not match: "
            f"{row['manifest_only']} and {row['embeddings_only']} ids on one side only"
        )


def gather(manifest: DataFrame, chosen: DataFrame, keep_distance: bool = False) -> DataFrame:
    """Manifest rows of the chosen tiles with their cluster_id (and distance on request)."""
    extra = [F.sqrt("d2").alias("distance_to_centroid")] if keep_distance else []
    return manifest.join(chosen.select("row_id", "cluster_id", *extra), "row_id")


def enrich_metadata(subset: DataFrame, original: DataFrame, first_by: str = "row_id") -> DataFrame:
    """Left join on (file name of parquet_url, grid_cell), null keys matching each other.

    Of several originals with one key the first by ``first_by`` counts, so every subset row stays
    exactly once.  Columns on both sides get ``_subset`` and ``_original``; ``first_by`` itself
    only serves the order.
    """
    subset = subset.withColumn("_file", basename(F.col("parquet_url")))
    keyed = original.withColumn("_file", basename(F.col("parquet_url")))
    firsts = first_per_group(keyed, ["_file", "grid_cell"], [first_by]).drop(first_by)
    payload = [c for c in firsts.columns if c not in ("_file", "grid_cell")]
    left = [c for c in subset.columns if c != "_file"]
    clash = set(left) & set(payload)
    right = firsts.select(
        F.col("_file").alias("_file_o"),
        F.col("grid_cell").alias("_cell_o"),
        *[F.col(c).alias(f"{c}_original" if c in clash else c) for c in payload],
    )
    same = F.col("_file").eqNullSafe(F.col("_file_o")) & F.col("grid_cell").eqNullSafe(F.col("_cell_o"))
    renamed = [F.col(c).alias(f"{c}_subset" if c in clash else c) for c in left]
    return subset.select("_file", *renamed).join(right, same, "left").drop("_file", "_file_o", "_cell_o")


def join_coordinates(subset: DataFrame, meta: DataFrame, first_by: str = "row_id") -> DataFrame:
    """Left join of centre_lat and centre_lon on grid_cell, first row per cell."""
    cells = first_per_group(meta.select("grid_cell", first_by, "centre_lat", "centre_lon"), ["grid_cell"], [first_by])
    right = cells.select(F.col("grid_cell").alias("_cell"), "centre_lat", "centre_lon")
    return subset.join(right, F.col("grid_cell").eqNullSafe(F.col("_cell")), "left").drop("_cell")


def drop_null_coords(df: DataFrame) -> DataFrame:
    """Rows with a latitude and a longitude; NaN counts as missing."""
    return df.dropna(subset=["centre_lat", "centre_lon"])


def renumber_row_groups(manifest: DataFrame, dest_dir: str) -> DataFrame:
    """Point the manifest at the extracted shards: row_group becomes the order of the old ones.

    A row that the manifest names twice is extracted once, so both entries get its number.
    """
    place = ["parquet_file", "row_group", "row_in_rg"]
    ranked = rank_within(manifest.select(*place).distinct(), ["parquet_file"], place[1:], "_rn")
    return manifest.join(ranked, place).select(
        *[F.col(c) for c in manifest.columns if c not in place],
        joined_path(dest_dir, basename(F.col("parquet_file"))).alias("parquet_file"),
        (F.col("_rn") - 1).cast("int").alias("row_group"),
        F.lit(0).alias("row_in_rg"),
    )


def rebase_manifest(manifest: DataFrame, overwrite: bool = False) -> DataFrame:
    """parquet_url = file name, parquet_row = row_group, where the manifest has no URL.

    ``overwrite`` is the form for copied whole files: the URL is replaced, the rest stays.
    """
    name = basename(F.col("parquet_file"))
    if overwrite:
        return manifest.withColumn("parquet_url", name)
    if "parquet_url" in manifest.columns:
        return manifest
    return manifest.withColumns({"parquet_url": name, "parquet_row": F.col("row_group")})


def source_files(manifest: DataFrame) -> DataFrame:
    """(parquet_file, n_rows): the shards a manifest draws from."""
    return manifest.groupBy("parquet_file").agg(F.count(F.lit(1)).alias("n_rows"))
