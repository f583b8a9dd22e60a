"""Metadata and manifests.  A tile is identified by ``row_id``, its position in the metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.text import after_images, basename, joined_path

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("grid_cell", T.StringType()),
        T.StructField("parquet_url", T.StringType()),
        T.StructField("parquet_row", T.LongType()),
        T.StructField("centre_lat", T.DoubleType()),
        T.StructField("centre_lon", T.DoubleType()),
        T.StructField("cloud_cover", T.DoubleType()),
        T.StructField("nodata", T.DoubleType()),
    ]
)
ADDRESS = ("grid_cell", "parquet_url", "parquet_row")


def read_metadata(
    spark: SparkSession, path: str, cols: Sequence[str] = ADDRESS, schema: T.StructType = METADATA_SCHEMA
) -> DataFrame:
    """Column-projected scan with a fixed schema, so no footer is read for inference."""
    return spark.read.schema(schema).parquet(path).select(*cols)


def with_positions(spark: SparkSession, path: str, cols: Sequence[str] = ADDRESS) -> DataFrame:
    """read_metadata plus ``row_id``, the 0-based position over all files in name order."""
    scan = spark.read.schema(METADATA_SCHEMA).parquet(path)
    placed = scan.select(*cols, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row per metadata file.
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_file").select((F.col("_start") + F.col("_row")).alias("row_id"), *cols)


def build_manifest(meta: DataFrame, images_dir: str, rule: str = "basename") -> DataFrame:
    """Add the physical address: parquet_file, row_group, row_in_rg.

    ``basename`` takes the text after the last slash of the URL, ``images_split`` the text after
    ``images/``, which has to occur exactly once.
    """
    url = F.col("parquet_url")
    if rule == "basename":
        name = basename(url)
    elif rule == "images_split":
        name = after_images(url)
    else:
        raise ValueError(f"rule must be 'basename' or 'images_split', not {rule!r}")
    return meta.withColumns(
        {
            "parquet_file": joined_path(images_dir, name),
            "row_group": F.col("parquet_row").cast("int"),
            "row_in_rg": F.lit(0),
        }
    )


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_or_build_manifest(
    spark: SparkSession, manifest_path: str, metadata_path: str, images_dir: str, rule: str = "images_split"
) -> DataFrame:
    """The stored manifest where there is one; otherwise build it from the metadata and store it."""
    stored = read_if_present(spark, manifest_path)
    if stored is not None:
        return stored
    if read_if_present(spark, metadata_path) is None:
        raise FileNotFoundError(f"there is no metadata at {metadata_path}")
    build_manifest(with_positions(spark, metadata_path), images_dir, rule).write.parquet(manifest_path)
    return spark.read.parquet(manifest_path)


def write_subset_manifest(subset: DataFrame, path: str) -> None:
    """Store the chosen rows without the source address columns."""
    subset.drop("parquet_url", "parquet_row").write.parquet(path)
