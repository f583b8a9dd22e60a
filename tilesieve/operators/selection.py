"""Choosing members of clusters and the statistics of the choice.

``assign`` is always (row_id, cluster_id, d2); ties go to the smaller row_id, and between clusters
of one size to the smaller cluster_id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .ranking import first_per_group, rank_within, top_n_per_group

_CLOSEST = ["d2", "row_id"]


def cluster_counts(assign: DataFrame, k: int) -> DataFrame:
    """(cluster_id, n) for every cluster 0..k-1, empty ones included."""
    sizes = assign.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    every = assign.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    return every.join(sizes, "cluster_id", "left").select("cluster_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def cluster_rank(counts: DataFrame) -> DataFrame:
    """(cluster_id, n, cluster_rank): 0-based rank by size, descending."""
    ranked = rank_within(counts, [], [F.desc("n"), "cluster_id"], "cluster_rank")
    return ranked.withColumn("cluster_rank", F.col("cluster_rank") - 1)


def size_curve(stats: DataFrame) -> DataFrame:
    """(rank, cluster_id, n_candidates): non-empty sizes in descending order."""
    held = stats.filter(F.col("n_candidates") > 0).select("cluster_id", "n_candidates")
    return rank_within(held, [], [F.desc("n_candidates"), "cluster_id"], "rank")


def closest_per_cluster(assign: DataFrame, n: int = 1) -> DataFrame:
    """(row_id, cluster_id, d2) of the n members closest to their centroid, per cluster."""
    if n == 1:
        return first_per_group(assign, ["cluster_id"], _CLOSEST).select("row_id", "cluster_id", "d2")
    return top_n_per_group(assign, ["cluster_id"], _CLOSEST, n).select("row_id", "cluster_id", "d2")


def quotas(assign: DataFrame, target: int, k: int) -> DataFrame:
    """(cluster_id, n, cluster_rank, quota): max(1, target div k), one more for the first target mod k ranks."""
    share, rest = max(1, target // k), target % k
    ranked = cluster_rank(cluster_counts(assign, k))
    extra = F.when(F.col("cluster_rank") < rest, 1).otherwise(0)
    return ranked.withColumn("quota", F.least(F.col("n"), F.lit(share) + extra))


def balanced_sample(assign: DataFrame, target: int, k: int) -> DataFrame:
    """(row_id, cluster_id, d2): the closest members up to the quota of their cluster.

    A cluster smaller than its quota is taken whole; what it lacks is not given to others.
    """
    most = max(1, target // k) + (1 if target % k else 0)
    ranked = top_n_per_group(assign, ["cluster_id"], _CLOSEST, most)
    allowed = quotas(assign, target, k).select("cluster_id", "quota")
    return ranked.join(allowed, "cluster_id").filter(F.col("rn") <= F.col("quota")).select("row_id", "cluster_id", "d2")


def proportional_sample(assign: DataFrame, fraction: float = 0.2) -> DataFrame:
    """(row_id, cluster_id, d2): the closest floor(fraction x size) members of every cluster."""
    sizes = assign.groupBy("cluster_id").agg(F.floor(F.count(F.lit(1)) * F.lit(fraction)).alias("_take"))
    ranked = rank_within(assign, ["cluster_id"], _CLOSEST)
    return ranked.join(sizes, "cluster_id").filter(F.col("rn") <= F.col("_take")).select("row_id", "cluster_id", "d2")


def cluster_stats(assign: DataFrame, chosen: DataFrame, k: int, ranked: bool = False) -> DataFrame:
    """(cluster_id, n_candidates, n_sampled[, cluster_rank]) for every cluster 0..k-1."""
    taken = chosen.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_taken"))
    sizes = cluster_counts(assign, k)
    if ranked:
        sizes = cluster_rank(sizes)
    extra = ["cluster_rank"] if ranked else []
    return sizes.join(taken, "cluster_id", "left").select(
        "cluster_id",
        F.col("n").alias("n_candidates"),
        F.coalesce("_taken", F.lit(0)).cast("bigint").alias("n_sampled"),
        *extra,
    )


def centroid_only_subset(assign: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(subset, stats) where a cluster stands for itself: only ids, one sample each, rank = id."""
    counts = cluster_counts(assign, k)
    stats = counts.select(
        "cluster_id",
        F.col("n").alias("n_candidates"),
        F.lit(1).cast("bigint").alias("n_sampled"),
        F.col("cluster_id").cast("bigint").alias("cluster_rank"),
    )
    return counts.select("cluster_id"), stats


def cluster_members_topn(assign: DataFrame, clusters: Sequence[int], n: int = 20) -> DataFrame:
    """The n closest members of the given clusters: rank, size of the cluster, flag on the first."""
    wanted = assign.filter(F.col("cluster_id").isin([int(c) for c in clusters]))
    sizes = wanted.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    ranked = top_n_per_group(wanted, ["cluster_id"], _CLOSEST, n, "position")
    return ranked.join(sizes, "cluster_id").select(
        "cluster_id", "row_id", "d2", "position", "cluster_size", (F.col("position") == 1).alias("selected")
    )


def large_clusters(stats: DataFrame, min_points: int = 99) -> DataFrame:
    """(cluster_id, n_candidates) of the clusters with strictly more than min_points members."""
    return stats.filter(F.col("n_candidates") > min_points).select("cluster_id", "n_candidates")


def first_large_clusters(stats: DataFrame, min_points: int = 99, most: int = 50) -> DataFrame:
    """The report form of large_clusters: the first ids and the number of all of them."""
    found = large_clusters(stats, min_points)
    total = found.select(F.count(F.lit(1))).scalar()
    return found.orderBy("cluster_id").limit(most).withColumn("n_large", total)


def union_chosen(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenation of several choices or manifests, matched by column name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
