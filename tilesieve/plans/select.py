"""Step 2: cluster the embeddings and keep a representative or balanced subset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import RunConfig, SelectionConfig
from ..functions.vectors import l2_normalize
from ..operators.clustering import cluster_centroids, kmeans, minibatch_kmeans
from ..operators.joins import align_manifest, check_alignment, gather
from ..operators.nearest import assign_nearest, distance_to_own
from ..operators.reduction import pca_fit_transform
from ..operators.sampling import truncate
from ..operators.selection import (
    balanced_sample,
    centroid_only_subset,
    closest_per_cluster,
    cluster_counts,
    cluster_stats,
)
from ..operators.thresholds import threshold_clusters, threshold_search
from ..session import written
from ..sources.reports import write_cluster_stats
from ..sources.vectors import read_embeddings, write_centroids


@dataclass(frozen=True)
class Selection:
    """Tables of one selection; all are lazy except the written ones they start from."""

    subset: DataFrame
    stats: DataFrame
    centroids: DataFrame
    counts: DataFrame
    assign: DataFrame


def unit_points(embeddings: DataFrame, cfg: SelectionConfig) -> DataFrame:
    """Optional principal components, then unit length."""
    points = embeddings
    if cfg.pca_components:
        dims = embeddings.select(F.size("embedding")).first()[0]
        if 0 < cfg.pca_components < dims:
            points, _ = pca_fit_transform(embeddings, cfg.pca_components)
    return points.select("row_id", l2_normalize(F.col("embedding")).alias("embedding"))


def select_subset(manifest: DataFrame, embeddings: DataFrame, cfg: SelectionConfig) -> Selection:
    """Cluster and choose.

    ``lloyd``: full k-means and the closest tile per cluster.  ``kmeans`` / ``mini-batch-kmeans``:
    mini-batch k-means and balanced quotas.  ``birch-threshold-only``: clusters by radius, which
    stand for themselves.  ``hierarchical`` / ``birch``: the radius is lowered until there are
    enough clusters, then balanced quotas.
    """
    method = cfg.method.lower()
    known = ("lloyd", "kmeans", "mini-batch-kmeans", "birch-threshold-only", "hierarchical", "birch")
    if method not in known:
        raise ValueError(f"unknown clustering method {cfg.method!r}; choose one of {', '.join(known)}")
    if cfg.test_subset_size is not None:
        embeddings = truncate(embeddings, cfg.test_subset_size)
    manifest = align_manifest(manifest, embeddings)
    check_alignment(manifest, embeddings)
    points = written(unit_points(embeddings, cfg), "unit")

    k = cfg.n_clusters
    if method == "lloyd":
        centroids = kmeans(points, k, cfg.max_iter, cfg.seed, cfg.init, cfg.max_points_per_centroid, refill=cfg.refill)
        assign = written(assign_nearest(points, centroids), "assign")
    elif method in ("kmeans", "mini-batch-kmeans"):
        centroids = minibatch_kmeans(points, k, cfg.max_iter, cfg.batch_size, cfg.seed, cfg.init, reassignment=cfg.reassignment)
        assign = written(assign_nearest(points, centroids), "assign")
    else:
        if method == "birch-threshold-only":
            labels = threshold_clusters(points, cfg.threshold)
        else:
            _, _, labels = threshold_search(
                points,
                cfg.target_n_tiles,
                cfg.threshold,
                cfg.min_threshold,
                cfg.threshold_decay,
                cfg.threshold_attempts,
            )
        labels = written(labels, "labels")
        k = labels.agg(F.max("cluster_id")).first()[0] + 1
        centroids = written(cluster_centroids(points, labels, k).select("cluster_id", "centroid"), "centroids")
        assign = written(_measured(points, labels, centroids), "assign")

    counts = cluster_counts(assign, k)
    if method == "birch-threshold-only":
        subset, stats = centroid_only_subset(assign, k)
        return Selection(subset, stats, centroids, counts, assign)
    if method == "lloyd":
        chosen = written(closest_per_cluster(assign, 1), "chosen")
        stats = cluster_stats(assign, chosen, k)
    else:
        chosen = written(balanced_sample(assign, cfg.target_n_tiles, k), "chosen")
        stats = cluster_stats(assign, chosen, k, ranked=True)
    subset = gather(manifest, chosen, cfg.keep_distance).drop("parquet_url", "parquet_row")
    return Selection(subset, stats, centroids, counts, assign)


def _measured(points: DataFrame, labels: DataFrame, centroids: DataFrame) -> DataFrame:
    """Labels kept, distances taken to the mean of the members instead of the sub-cluster."""
    return distance_to_own(points.join(labels.select("row_id", "cluster_id"), "row_id"), centroids)


def store_selection(selection: Selection, cfg: RunConfig) -> None:
    write_centroids(selection.centroids, selection.counts, cfg.data.table("centroids"))
    selection.subset.write.parquet(cfg.data.table("subset"))
    write_cluster_stats(selection.stats, cfg.data.table("cluster_stats"))


def run_selection(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Select from the stored manifest and embeddings and store subset, centroids and statistics."""
    manifest = spark.read.parquet(cfg.data.table("manifest"))
    embeddings = read_embeddings(spark, cfg.data.table("embeddings"))
    store_selection(select_subset(manifest, embeddings, cfg.selection), cfg)
    return spark.read.parquet(cfg.data.table("subset"))
