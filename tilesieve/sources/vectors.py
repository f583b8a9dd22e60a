"""Embeddings and centroids as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EMBEDDING_SCHEMA = "row_id bigint, embedding array<float>"
CENTROID_SCHEMA = "cluster_id int, centroid array<double>, n bigint"


def write_embeddings(df: DataFrame, path: str, key: str = "row_id", vec: str = "embedding", mode: str = "errorifexists") -> None:
    df.select(F.col(key).cast("bigint").alias("row_id"), F.col(vec).cast("array<float>").alias("embedding")).write.mode(mode).parquet(path)


def read_embeddings(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(EMBEDDING_SCHEMA).parquet(*paths)


def write_centroids(centroids: DataFrame, counts: DataFrame, path: str) -> None:
    """Store centroids with the size of their cluster; ranges of ids stay together in the files."""
    sized = centroids.select("cluster_id", "centroid").join(counts.select("cluster_id", "n"), "cluster_id", "left")
    sized.select(
        F.col("cluster_id").cast("int").alias("cluster_id"), "centroid", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    ).write.parquet(path)


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CENTROID_SCHEMA).parquet(path)


def centroid_total(spark: SparkSession, path: str) -> int:
    return read_centroids(spark, path).count()
