"""The tables of the workflow, derived by Spark from the given tables, each over all its rows.

What the workflow itself stores between its steps (shards, centroids, assignment) is written once
per session and input folder and then read, as the steps do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vectors import l2_normalize
from ..operators.clustering import kmeans
from ..operators.nearest import assign_nearest
from ..operators.reports import black_tiles
from ..operators.selection import closest_per_cluster
from ..operators.tiles import null_band_policy
from ..session import scratch_path, written
from ..sources.manifest import build_manifest
from ..sources.tiles import write_shards

IMAGES = "/data/images"
K = 10
ROUNDS = 3
PIXELS = 64
SIDE = 8

_stored: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _stored:
        _stored[slot] = make()
    return _stored[slot]


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, embedding) as stored."""
    return embeddings(spark, sf_dir).select(F.col("vec_id").alias("row_id"), "embedding")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, embedding) of unit length, in double."""
    return vectors(spark, sf_dir).select("row_id", l2_normalize(F.col("embedding")).alias("embedding"))


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of different length, and a zero vector for every row."""
    v = embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("row_id"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x * (1 + F.col("vec_id") % 5)).alias("embedding"),
    )
    zeros = v.select((F.col("row_id") + 1000000).alias("row_id"), F.transform("embedding", lambda x: F.lit(0.0)).alias("embedding"))
    return v.unionByName(zeros)


def tapered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors whose elements vary less and less, so that their principal components are well apart."""
    return embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("row_id"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x, i: x * F.pow(F.lit(0.7), i)).alias("embedding"),
    )


def blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten separated clusters: one-hot(label) + 0.15 x embedding."""
    return embeddings(spark, sf_dir).select(
        F.col("vec_id").alias("row_id"),
        F.transform(
            F.col("embedding").cast("array<double>"),
            lambda x, i: x * 0.15 + F.when(i == F.col("label"), 1.0).otherwise(0.0),
        ).alias("embedding"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per tile: grid cell, shard URL and row, position, cloud cover, no-data share."""
    return embeddings(spark, sf_dir).selectExpr(
        "vec_id AS row_id",
        "concat(vec_id % 40, 'U_', vec_id % 7, 'R') AS grid_cell",
        "concat('https://host/core/images/part_', lpad(CAST(vec_id DIV 25 AS STRING), 5, '0'), '.parquet') AS parquet_url",
        "vec_id % 25 AS parquet_row",
        "CASE WHEN vec_id % 53 = 5 THEN NULL ELSE CAST((vec_id * 37) % 180 AS DOUBLE) - 89.5 END AS centre_lat",
        "CAST((vec_id * 73) % 360 AS DOUBLE) - 179.5 AS centre_lon",
        "CAST((vec_id * 13) % 101 AS DOUBLE) AS cloud_cover",
        "CAST((vec_id * 29) % 64 AS DOUBLE) / 64 AS nodata",
    )


def metadata_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metadata row and a later copy of it with another cloud cover."""
    base = metadata(spark, sf_dir)
    copies = base.withColumns({"row_id": F.col("row_id") + 1000000, "cloud_cover": F.lit(-1.0)})
    return base.unionByName(copies)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = metadata(spark, sf_dir).select("row_id", "grid_cell", "parquet_url", "parquet_row")
    return build_manifest(meta, IMAGES)


def manifest_with_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and for every row a twin in a shard that does not exist."""
    here = manifest(spark, sf_dir)
    gone = here.withColumns(
        {
            "row_id": F.col("row_id") + 1000000,
            "parquet_file": F.regexp_replace("parquet_file", "part_", "absent_"),
        }
    )
    return here.unionByName(gone)


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, B04, B03, B02): 8 x 8 pixels from the 64 vector elements, some black, some without B02."""
    first = embeddings(spark, sf_dir).selectExpr(
        "vec_id AS row_id",
        """CASE WHEN vec_id % 125 = 7 THEN array_repeat(0, 64)
           ELSE transform(CAST(embedding AS ARRAY<DOUBLE>),
                x -> CAST(floor(greatest(x - CAST(0.05 AS DOUBLE), CAST(0 AS DOUBLE)) * 30000) AS INT)) END AS B04""",
    )
    return first.selectExpr(
        "row_id",
        "B04",
        "transform(B04, v -> CAST(floor(v * CAST(0.8 AS DOUBLE)) AS INT)) AS B03",
        "CASE WHEN row_id % 97 = 13 THEN NULL ELSE concat(slice(B04, 2, 63), slice(B04, 1, 1)) END AS B02",
    )


def raw_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tiles as little-endian uint16 blobs."""

    def blob(name: str):
        pairs = F.transform(
            name,
            lambda v: F.concat(
                F.lpad(F.hex(v.bitwiseAND(255)), 2, "0"), F.lpad(F.hex(F.shiftright(v, 8)), 2, "0")
            ),
        )
        return F.unhex(F.array_join(pairs, "")).alias(name)

    return tiles(spark, sf_dir).select("row_id", blob("B04"), blob("B03"), blob("B02"))


def images_dir(spark: SparkSession, sf_dir: str) -> str:
    """The raw tiles as shards."""

    def make() -> str:
        path = scratch_path(spark, "images")
        meta = metadata(spark, sf_dir).select(
            "row_id",
            F.substring_index("parquet_url", "/", -1).alias("shard"),
            F.col("parquet_row").alias("tile_row"),
        )
        # Rows of a shard together, so that it is one file.
        write_shards(raw_tiles(spark, sf_dir).join(meta, "row_id").drop("row_id").repartition("shard"), path)
        return path

    return _once(spark, sf_dir, "images", make)


def start10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means with 10 clusters from the first rows, three rounds."""
    return kmeans(points(spark, sf_dir), K, ROUNDS, init="first", max_points_per_centroid=None)


def centroids10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "centroids10", lambda: written(start10(spark, sf_dir), "centroids10"))


def assign10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        "assign10",
        lambda: written(assign_nearest(points(spark, sf_dir), centroids10(spark, sf_dir)), "assign10"),
    )


def chosen10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closest_per_cluster(assign10(spark, sf_dir), 1)


def black_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The embedding of the first black tile, as the black clusters are looked for with it."""

    def make() -> list[float]:
        black = black_tiles(null_band_policy(tiles(spark, sf_dir))).select("row_id")
        row = vectors(spark, sf_dir).join(F.broadcast(black), "row_id", "left_semi").select("embedding").first()
        return [float(x) for x in row[0]]

    return _once(spark, sf_dir, "black", make)


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cluster_id, n_candidates) of very unequal size: orders per customer, lines per number and supplier."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", "l_linenumber")
    finished = orders.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    per_customer = customer.join(finished, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("bigint").alias("cluster_id"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_candidates")
    )
    per_line = lines.groupBy((F.col("l_linenumber") + 10000000).cast("bigint").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n_candidates")
    )
    per_supplier = lines.groupBy((F.col("l_suppkey") + 20000000).cast("bigint").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n_candidates")
    )
    return per_customer.unionByName(per_line).unionByName(per_supplier)
