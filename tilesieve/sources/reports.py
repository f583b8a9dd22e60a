"""Text outputs: cluster statistics, cluster ids and labelled samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

STATS_SCHEMA = "cluster_id int, n_candidates bigint, n_sampled bigint"
RANKED_STATS_SCHEMA = STATS_SCHEMA + ", cluster_rank bigint"


def write_cluster_stats(stats: DataFrame, path: str) -> None:
    """CSV with header in the order of cluster_id; large tables come as several ordered files."""
    stats.orderBy("cluster_id").write.option("header", True).csv(path)


def read_cluster_stats(spark: SparkSession, path: str, ranked: bool = False) -> DataFrame:
    return spark.read.schema(RANKED_STATS_SCHEMA if ranked else STATS_SCHEMA).option("header", True).csv(path)


def write_cluster_ids(clusters: DataFrame, path: str) -> None:
    """One cluster id per line."""
    clusters.orderBy("cluster_id").select(F.col("cluster_id").cast("string")).write.text(path)


def write_labelled_sample_csv(sample: DataFrame, path: str) -> None:
    """CSV of analysed tiles: idx, cluster, is_garbage, black_pct."""
    sample.select("idx", "cluster", "is_garbage", "black_pct").write.option("header", True).csv(path)
