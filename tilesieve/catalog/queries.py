"""One query per operator.  Every query takes (spark, sf_dir) and covers its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DataConfig, ExtractionConfig, RunConfig, SelectionConfig
from ..functions import bands as bd
from ..functions.text import basename
from ..functions.vectors import l2_normalize, l2_normalize_eps
from ..operators import clustering, joins, models, nearest, pairs, ranking, reduction, reports, sampling, selection, starts, thresholds
from ..operators import tiles as tl
from ..plans.extract import prepare_and_embed_tiles
from ..plans.materialize import materialize_subset as materialize
from ..plans.select import select_subset as choose
from ..plans.steps import run_steps as steps
from ..session import scratch_path, written
from ..sources import manifest as man
from ..sources import reports as rep
from ..sources import tiles as src
from ..sources import vectors as vec
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RGB = tl.RGB
GARBAGE = 0.02


def query(run: Query) -> Query:
    QUERIES[run.__name__.rstrip("_")] = run
    return run


# ---------------------------------------------------------------- shapes of results


def _r(col):
    """Six digits, without a negative zero."""
    return F.round(col, 6) + F.lit(0.0)


def _long(df: DataFrame, ids: list[str], col: str) -> DataFrame:
    return df.select(*ids, F.posexplode(col).alias("pos", "_x")).select(*ids, "pos", _r(F.col("_x").cast("double")).alias("value"))


def _bands_long(df: DataFrame) -> DataFrame:
    lines = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("_v")) for b in RGB])
    return _long(df.select("row_id", F.inline(lines)), ["row_id", "band"], "_v")


def _bands_text(df: DataFrame, ids: list[str]) -> DataFrame:
    return df.select(*ids, *[F.array_join(F.col(b), ",").alias(b.lower()) for b in RGB])


def _b(df: DataFrame) -> list:
    return [F.col(b) for b in RGB]


def _whole(spark, sf_dir) -> DataFrame:
    """Tiles with all three bands."""
    return tl.null_band_policy(fx.tiles(spark, sf_dir), "drop")


def _assign(df: DataFrame) -> DataFrame:
    return df.select("row_id", "cluster_id", _r(F.col("d2")).alias("d2"))


# ---------------------------------------------------------------- sources and sinks


def _stored_metadata(spark, sf_dir) -> str:
    path = scratch_path(spark, "metadata")
    fx.metadata(spark, sf_dir).orderBy("row_id").drop("row_id").write.parquet(path)
    return path


@query
def read_metadata(spark, sf_dir):
    return man.read_metadata(spark, _stored_metadata(spark, sf_dir))


@query
def build_manifest(spark, sf_dir):
    return fx.manifest(spark, sf_dir)


@query
def build_manifest_images_split(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir).select("row_id", "grid_cell", "parquet_url", "parquet_row")
    return man.build_manifest(meta, fx.IMAGES, "images_split")


@query
def load_or_build_manifest(spark, sf_dir):
    meta, path = _stored_metadata(spark, sf_dir), scratch_path(spark, "manifest")
    man.load_or_build_manifest(spark, path, meta, fx.IMAGES)
    again = man.load_or_build_manifest(spark, path, "no metadata is needed now", fx.IMAGES)
    return again.select("grid_cell", "parquet_file", "row_group", "row_in_rg")


@query
def read_tiles(spark, sf_dir):
    found = src.read_tiles(spark, fx.images_dir(spark, sf_dir), fx.manifest_with_absent(spark, sf_dir), RGB)
    return _bands_text(tl.decode_raw_band(found), ["row_id", "shard", "row_in_file"])


@query
def read_embeddings(spark, sf_dir):
    path = scratch_path(spark, "embeddings")
    vec.write_embeddings(fx.vectors(spark, sf_dir), path)
    return _long(vec.read_embeddings(spark, path), ["row_id"], "embedding")


@query
def read_centroids(spark, sf_dir):
    path = scratch_path(spark, "centroids")
    counts = selection.cluster_counts(fx.assign10(spark, sf_dir), fx.K)
    vec.write_centroids(fx.centroids10(spark, sf_dir), counts, path)
    return _long(vec.read_centroids(spark, path), ["cluster_id", "n"], "centroid")


@query
def count_centroids(spark, sf_dir):
    path = scratch_path(spark, "centroids")
    counts = selection.cluster_counts(fx.assign10(spark, sf_dir), fx.K)
    vec.write_centroids(fx.centroids10(spark, sf_dir), counts, path)
    return vec.read_centroids(spark, path).agg(F.count(F.lit(1)).alias("n_centroids"))


@query
def write_subset_manifest(spark, sf_dir):
    path = scratch_path(spark, "subset")
    man.write_subset_manifest(joins.gather(fx.manifest(spark, sf_dir), fx.chosen10(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query
def write_cluster_stats(spark, sf_dir):
    path = scratch_path(spark, "stats")
    rep.write_cluster_stats(_stats(spark, sf_dir), path)
    return rep.read_cluster_stats(spark, path)


@query
def write_cluster_ids(spark, sf_dir):
    path = scratch_path(spark, "ids")
    rep.write_cluster_ids(selection.large_clusters(fx.sizes(spark, sf_dir)), path)
    return spark.read.text(path)


@query
def write_labelled_sample_csv(spark, sf_dir):
    path = scratch_path(spark, "sample")
    rep.write_labelled_sample_csv(_labelled(spark, sf_dir), path)
    back = spark.read.schema("idx bigint, cluster int, is_garbage boolean, black_pct double").option("header", True).csv(path)
    return back.withColumn("black_pct", _r(F.col("black_pct")))


# ---------------------------------------------------------------- tiles


@query
def band_columns(spark, sf_dir):
    names = bd.band_columns([3, 2, 1])
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("channel"),
                F.lit(b).alias("band"),
                F.size(b).cast("bigint").alias("n_pixels"),
                F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
            )
            for i, b in enumerate(names)
        ]
    )
    return _whole(spark, sf_dir).select("row_id", F.inline(lines))


@query
def decode_raw_band(spark, sf_dir):
    return _bands_text(tl.decode_raw_band(fx.raw_tiles(spark, sf_dir)), ["row_id"])


@query
def null_band_policy_drop(spark, sf_dir):
    return _bands_text(_whole(spark, sf_dir), ["row_id"])


@query
def null_band_policy_zeros(spark, sf_dir):
    return _bands_text(tl.null_band_policy(fx.tiles(spark, sf_dir), "zeros", pixels=fx.PIXELS), ["row_id"])


@query
def nodata_fraction(spark, sf_dir):
    t = _whole(spark, sf_dir)
    return t.select("row_id", _r(bd.nodata_fraction(*_b(t))).alias("nodata"))


@query
def zero_value_pct(spark, sf_dir):
    return tl.with_zero_pct(_whole(spark, sf_dir)).select("row_id", _r(F.col("zero_pct")).alias("zero_pct"))


@query
def filter_nodata(spark, sf_dir):
    return tl.filter_nodata(_whole(spark, sf_dir)).select("row_id")


@query
def scale_clamp(spark, sf_dir):
    return _bands_long(_whole(spark, sf_dir).withColumns({b: bd.scale_clamp(F.col(b)) for b in RGB}))


@query
def resize_bicubic(spark, sf_dir):
    unit = _whole(spark, sf_dir).withColumns({b: bd.scale_clamp(F.col(b)) for b in RGB})
    small = tl.resize_bicubic(unit, fx.SIDE, fx.SIDE, 5)
    # Exact decimals can end in a 5 right behind the last digit kept; a third breaks such ties.
    return _bands_long(small.withColumns({b: F.transform(b, lambda x: x + F.lit(1e-7 / 3)) for b in RGB}))


@query
def channel_normalize(spark, sf_dir):
    unit = _whole(spark, sf_dir).withColumns({b: bd.scale_clamp(F.col(b)) for b in RGB})
    return _bands_long(unit.withColumns({b: bd.channel_normalize(F.col(b), i) for i, b in enumerate(RGB)}))


@query
def is_black_tile(spark, sf_dir):
    t = _whole(spark, sf_dir)
    return t.select("row_id", bd.is_black_tile(*_b(t)).alias("is_black"))


@query
def display_rgb(spark, sf_dir):
    return _bands_text(_whole(spark, sf_dir).withColumns({b: bd.display_rgb(F.col(b)) for b in RGB}), ["row_id"])


def _outcome(spark, sf_dir) -> DataFrame:
    t = fx.tiles(spark, sf_dir)
    return t.select("row_id", bd.tile_outcome(F.lit(True), _b(t)).alias("status"))


@query
def tile_status(spark, sf_dir):
    return tl.tile_status(fx.manifest_with_absent(spark, sf_dir), _outcome(spark, sf_dir))


@query
def tile_status_counts(spark, sf_dir):
    return tl.status_counts(tl.tile_status(fx.manifest_with_absent(spark, sf_dir), _outcome(spark, sf_dir)))


@query
def prepare_tiles(spark, sf_dir):
    found = src.read_tiles(spark, fx.images_dir(spark, sf_dir), fx.manifest_with_absent(spark, sf_dir), RGB)
    made = tl.prepare_tiles(found, fx.SIDE, fx.SIDE, fx.SIDE)
    return made.select("row_id", "status", _r(F.col("nodata")).alias("nodata"), F.size("pixels").alias("n_values"))


SELECTION = SelectionConfig(n_clusters=fx.K, max_iter=fx.ROUNDS, init="first", max_points_per_centroid=None)


def _run_config(spark, sf_dir, model: str, size: int, metadata_path: str = "", pixels: str = "float") -> RunConfig:
    return RunConfig(
        DataConfig(metadata_path, fx.images_dir(spark, sf_dir), scratch_path(spark, "run")),
        ExtractionConfig(model=model, crop_size=size, pixels=pixels, tile_height=fx.SIDE, tile_width=fx.SIDE),
        SELECTION,
    )


@query
def embed_tiles(spark, sf_dir):
    cfg = _run_config(spark, sf_dir, "projection", 6)
    return _long(prepare_and_embed_tiles(spark, fx.manifest(spark, sf_dir), cfg), ["row_id"], "embedding")


def _channel_means():
    """Mean of every channel, returned the way a network with a class token does."""
    return lambda images: {"x_norm_clstoken": images.mean(axis=(2, 3))}


def _bright_share():
    """Share of pixels above the channel's mean, first of a tuple as some networks return it."""
    return lambda images: ((images > 0).mean(axis=(2, 3)), None)


@query
def register_model(spark, sf_dir):
    models.register_model("bright-share", _bright_share)
    found = src.read_tiles(spark, fx.images_dir(spark, sf_dir), fx.manifest(spark, sf_dir), RGB)
    made = tl.prepare_tiles(found, fx.SIDE, fx.SIDE, fx.SIDE).filter(F.col("status") == "kept")
    out = tl.embed_tiles(made, models.model_factory("bright-share"), fx.SIDE)
    return _long(out, ["row_id"], "embedding")


@query
def l2_normalize_(spark, sf_dir):
    return _long(fx.scaled(spark, sf_dir).select("row_id", l2_normalize(F.col("embedding")).alias("v")), ["row_id"], "v")


@query
def l2_normalize_eps_(spark, sf_dir):
    return _long(fx.scaled(spark, sf_dir).select("row_id", l2_normalize_eps(F.col("embedding")).alias("v")), ["row_id"], "v")


@query
def minmax_scale(spark, sf_dir):
    meta = fx.metadata(spark, sf_dir).select("row_id", "cloud_cover")
    return reduction.minmax_scale(meta, "cloud_cover").select("row_id", _r(F.col("scaled")).alias("scaled"))


@query
def basename_(spark, sf_dir):
    return fx.metadata(spark, sf_dir).select("row_id", basename(F.col("parquet_url")).alias("name"))


# ---------------------------------------------------------------- filters and samples


@query
def align_manifest(spark, sf_dir):
    return joins.align_manifest(fx.manifest_with_absent(spark, sf_dir), fx.vectors(spark, sf_dir))


@query
def truncate(spark, sf_dir):
    return sampling.truncate(fx.metadata(spark, sf_dir), 100).select("row_id", "grid_cell")


@query
def check_alignment(spark, sf_dir):
    return joins.alignment_report(fx.manifest_with_absent(spark, sf_dir), fx.vectors(spark, sf_dir))


@query
def sample_exact(spark, sf_dir):
    return sampling.sample_exact(fx.metadata(spark, sf_dir), 20).select("row_id", "grid_cell")


@query
def sample_exact_by_buckets(spark, sf_dir):
    return sampling.sample_exact(fx.metadata(spark, sf_dir), 333, direct=0).select("row_id", "grid_cell")


@query
def sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(fx.metadata(spark, sf_dir), 0.3).select("row_id", "grid_cell")


@query
def first_matching(spark, sf_dir):
    inside = (bd.zero_value_pct(*[F.col(b) for b in RGB]) > 30) & (bd.zero_value_pct(*[F.col(b) for b in RGB]) < 70)
    found = sampling.first_matching(_whole(spark, sf_dir), inside, 10)
    return tl.with_zero_pct(found).select("row_id", _r(F.col("zero_pct")).alias("zero_pct"))


@query
def first_black_tile(spark, sf_dir):
    return reports.black_tiles(_whole(spark, sf_dir)).select("row_id")


def _reader(spark, sf_dir):
    """What fetches the tiles of manifest rows that have all three bands."""
    images = fx.images_dir(spark, sf_dir)
    return lambda rows: tl.null_band_policy(tl.decode_raw_band(src.read_tiles(spark, images, rows, RGB)), "drop")


@query
def first_matching_in_waves(spark, sf_dir):
    """The first wave has too few hits, so several are read."""
    share = bd.zero_value_pct(*[F.col(b) for b in RGB])
    found = sampling.first_matching_in_waves(fx.manifest(spark, sf_dir), _reader(spark, sf_dir), (share > 30) & (share < 70), 10, first=10)
    return tl.with_zero_pct(found).select("row_id", _r(F.col("zero_pct")).alias("zero_pct"))


@query
def first_black_tile_in_waves(spark, sf_dir):
    return reports.black_tiles_of(fx.manifest(spark, sf_dir), _reader(spark, sf_dir)).select("row_id")


def _garbage(spark, sf_dir) -> DataFrame:
    return reports.garbage_clusters(_sims(spark, sf_dir), GARBAGE)


def _split(spark, sf_dir) -> DataFrame:
    return reports.split_garbage(fx.assign10(spark, sf_dir), _garbage(spark, sf_dir))


def _labelled(spark, sf_dir) -> DataFrame:
    """The shuffled sample that the SQL asks for: 500 tiles of garbage clusters and 1,000 of the others."""
    return reports.labelled_sample(_split(spark, sf_dir), fx.tiles(spark, sf_dir), garbage=500, good=1000)


@query
def sample_per_group(spark, sf_dir):
    return sampling.sample_per_group(_split(spark, sf_dir), "is_garbage", {True: 15, False: 40})


@query
def drop_null_coords(spark, sf_dir):
    return joins.drop_null_coords(fx.metadata(spark, sf_dir)).select("row_id", "centre_lat", "centre_lon")


@query
def filter_zero_range(spark, sf_dir):
    found = tl.filter_zero_range(tl.with_zero_pct(_whole(spark, sf_dir)), 30, 70)
    return found.select("row_id", _r(F.col("zero_pct")).alias("zero_pct"))


@query
def pick_clusters(spark, sf_dir):
    return sampling.pick_clusters(fx.assign10(spark, sf_dir))


# ---------------------------------------------------------------- joins


@query
def assign_nearest(spark, sf_dir):
    return _assign(nearest.assign_nearest(fx.points(spark, sf_dir), fx.centroids10(spark, sf_dir)))


@query
def assign_nearest_in_blocks(spark, sf_dir):
    """The path for centroids beyond the broadcast bound, forced by a small bound."""
    found = nearest.assign_nearest(fx.points(spark, sf_dir), fx.centroids10(spark, sf_dir), max_bytes=2_200)
    return _assign(found)


@query
def assign_nearest_normalized(spark, sf_dir):
    return _assign(nearest.assign_nearest_normalized(fx.points(spark, sf_dir), fx.centroids10(spark, sf_dir)))


def _blank_cell(df: DataFrame) -> DataFrame:
    return df.withColumn("grid_cell", F.nullif(F.col("grid_cell"), F.lit("5U_5R")))


@query
def enrich_metadata(spark, sf_dir):
    subset = _blank_cell(fx.metadata(spark, sf_dir)).select(
        "row_id", "grid_cell", basename(F.col("parquet_url")).alias("parquet_url")
    )
    return joins.enrich_metadata(subset, _blank_cell(fx.metadata_twice(spark, sf_dir)))


@query
def join_coordinates(spark, sf_dir):
    subset = _blank_cell(fx.metadata(spark, sf_dir)).select("row_id", "grid_cell")
    return joins.join_coordinates(subset, _blank_cell(fx.metadata_twice(spark, sf_dir)))


@query
def extract_subset_rows(spark, sf_dir):
    subset = joins.gather(fx.manifest(spark, sf_dir), selection.closest_per_cluster(fx.assign10(spark, sf_dir), 20))
    path = scratch_path(spark, "extracted")
    src.write_shards(src.extract_subset_rows(spark, fx.images_dir(spark, sf_dir), subset, RGB), path)
    return _bands_text(tl.decode_raw_band(src.open_shards(spark, path, RGB)), ["shard", "row_in_file"])


@query
def extract_subset_rows_in_parts(spark, sf_dir):
    """The path for addresses beyond the broadcast bound, forced by a small bound."""
    images = fx.images_dir(spark, sf_dir)
    rows = src.extract_subset_rows(spark, images, fx.manifest(spark, sf_dir), RGB, max_bytes=16 * 1024)
    return _bands_text(tl.decode_raw_band(rows), ["shard", "tile_row"])


@query
def missing_sources(spark, sf_dir):
    return src.missing_sources(spark, fx.images_dir(spark, sf_dir), fx.manifest_with_absent(spark, sf_dir))


@query
def pairwise_distances(spark, sf_dir):
    return pairs.pairwise_distances(fx.vectors(spark, sf_dir))


def _sims(spark, sf_dir, normalize: str = "none") -> DataFrame:
    return nearest.similarity_to_reference(fx.centroids10(spark, sf_dir), fx.black_vector(spark, sf_dir), normalize)


@query
def similarity_to_reference(spark, sf_dir):
    return _sims(spark, sf_dir).select("cluster_id", _r(F.col("similarity")).alias("similarity"))


@query
def similarity_to_reference_both(spark, sf_dir):
    return _sims(spark, sf_dir, "both").select("cluster_id", _r(F.col("similarity")).alias("similarity"))


@query
def gather(spark, sf_dir):
    found = joins.gather(fx.manifest(spark, sf_dir), fx.chosen10(spark, sf_dir), keep_distance=True)
    return found.withColumn("distance_to_centroid", _r(F.col("distance_to_centroid")))


# ---------------------------------------------------------------- reduction and clustering


@query
def pca_fit_transform(spark, sf_dir):
    return _long(reduction.pca_fit_transform(fx.tapered(spark, sf_dir), 8)[0], ["row_id"], "embedding")


@query
def pca_cumulative_variance(spark, sf_dir):
    found = reduction.pca_cumulative_variance(fx.tapered(spark, sf_dir))
    return found.select("component", _r(F.col("ratio")).alias("ratio"), _r(F.col("cumulative")).alias("cumulative"))


@query
def pca_variance_marks(spark, sf_dir):
    found = reduction.variance_marks(reduction.pca_cumulative_variance(fx.tapered(spark, sf_dir)), at=2)
    return found.withColumn("cumulative_2", _r(F.col("cumulative_2")))


@query
def kmeans(spark, sf_dir):
    return _long(fx.start10(spark, sf_dir), ["cluster_id"], "centroid")


@query
def kmeans_in_blocks(spark, sf_dir):
    """The path for centres beyond the broadcast bound, forced by a small bound."""
    found = clustering.kmeans(
        written(fx.points(spark, sf_dir), "points"), fx.K, 1, init="first", max_points_per_centroid=None, max_bytes=2_600
    )
    return _long(found, ["cluster_id"], "centroid")


@query
def kmeans_capped_training(spark, sf_dir):
    found = clustering.kmeans(fx.points(spark, sf_dir), fx.K, 2, init="sample", max_points_per_centroid=20)
    return _long(found, ["cluster_id"], "centroid")


@query
def minibatch_kmeans(spark, sf_dir):
    data = written(fx.points(spark, sf_dir), "points")
    centroids = clustering.minibatch_kmeans(data, fx.K, max_iter=2, batches=3)
    return _assign(nearest.assign_nearest(data, centroids))


@query
def oversampled_start(spark, sf_dir):
    data = written(fx.points(spark, sf_dir), "points")
    return _long(starts.oversampled_start(data, fx.K), ["cluster_id"], "centroid")


@query
def threshold_clusters(spark, sf_dir):
    return _assign(thresholds.threshold_clusters(written(fx.blobs(spark, sf_dir), "blobs"), 0.3))


@query
def threshold_search(spark, sf_dir):
    return thresholds.threshold_search(written(fx.blobs(spark, sf_dir), "blobs"), target=100, threshold=0.4, decay=0.125)[0]


@query
def threshold_sweep(spark, sf_dir):
    sample = fx.blobs(spark, sf_dir)
    return thresholds.threshold_sweep(sample, [0.05, 0.3, 0.6, 1.2, 2.4])


@query
def cluster_centroids(spark, sf_dir):
    found = clustering.cluster_centroids(fx.points(spark, sf_dir), fx.assign10(spark, sf_dir), fx.K + 2)
    return _long(found, ["cluster_id", "n"], "centroid")


@query
def inertia(spark, sf_dir):
    return clustering.inertia(fx.assign10(spark, sf_dir)).select(_r(F.col("inertia")).alias("inertia"))


# ---------------------------------------------------------------- reports


@query
def cluster_counts(spark, sf_dir):
    return selection.cluster_counts(fx.assign10(spark, sf_dir), fx.K + 2)


def _stats(spark, sf_dir) -> DataFrame:
    return selection.cluster_stats(fx.assign10(spark, sf_dir), fx.chosen10(spark, sf_dir), fx.K + 2)


@query
def cluster_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query
def cluster_stats_ranked(spark, sf_dir):
    a = fx.assign10(spark, sf_dir)
    return selection.cluster_stats(a, selection.balanced_sample(a, 128, fx.K), fx.K, ranked=True)


@query
def size_tiers(spark, sf_dir):
    return reports.size_tiers(fx.sizes(spark, sf_dir))


@query
def size_histogram(spark, sf_dir):
    held = fx.sizes(spark, sf_dir).filter(F.col("n_candidates") > 0)
    found = reports.size_histogram(held, "n_candidates")
    return found.select("bin", _r(F.col("low")).alias("low"), _r(F.col("high")).alias("high"), "n")


@query
def zero_histogram_by_class(spark, sf_dir):
    share = tl.with_zero_pct(_whole(spark, sf_dir)).select("row_id", "zero_pct")
    found = reports.size_histogram(share.join(_split(spark, sf_dir), "row_id"), "zero_pct", 50, ["is_garbage"])
    return found.select("is_garbage", "bin", _r(F.col("low")).alias("low"), _r(F.col("high")).alias("high"), "n")


@query
def band_stats(spark, sf_dir):
    found = tl.band_stats(fx.tiles(spark, sf_dir))
    return found.select("band", "n_tiles", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"))


@query
def measure_tiles(spark, sf_dir):
    found = tl.measure_tiles(fx.raw_tiles(spark, sf_dir))
    return found.select("row_id", _r(F.col("nodata")).alias("nodata"), _r(F.col("zero_pct")).alias("zero_pct"), "is_black", "n_pixels")


@query
def band_stats_of_blobs(spark, sf_dir):
    found = tl.band_stats_of_measures(tl.measure_tiles(fx.raw_tiles(spark, sf_dir)))
    return found.select("band", "n_tiles", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"))


@query
def distance_profile(spark, sf_dir):
    found = pairs.distance_profile(fx.vectors(spark, sf_dir))
    return found.select("metric", _r(F.col("distance")).alias("distance"))


@query
def recommend_thresholds(spark, sf_dir):
    found = pairs.recommend_thresholds(fx.vectors(spark, sf_dir))
    return found.select("n_clusters", _r(F.col("threshold")).alias("threshold"))


@query
def describe_by_class(spark, sf_dir):
    labelled = _labelled(spark, sf_dir).withColumn("class", F.when(F.col("is_garbage"), "garbage").otherwise("good"))
    found = reports.describe_by_class(labelled, "black_pct", "class")
    return found.select("class", "metric", _r(F.col("value")).alias("value"))


@query
def profile_metadata(spark, sf_dir):
    found = reports.profile_metadata(fx.metadata(spark, sf_dir))
    return found.select("column", "metric", _r(F.col("value")).alias("value"))


@query
def top_values(spark, sf_dir):
    return reports.top_values(fx.assign10(spark, sf_dir))


@query
def similarity_counts(spark, sf_dir):
    return reports.similarity_counts(_sims(spark, sf_dir), [0.1, 0.02, 0.0, -0.02])


@query
def subset_size_estimate(spark, sf_dir):
    found = reports.subset_size_estimate(fx.chosen10(spark, sf_dir), fx.assign10(spark, sf_dir))
    return found.select(
        "n_tiles", "bytes", _r(F.col("uncompressed_tb")).alias("uncompressed_tb"), _r(F.col("selected_pct")).alias("selected_pct")
    )


@query
def source_files(spark, sf_dir):
    return joins.source_files(fx.manifest(spark, sf_dir))


@query
def geo_density(spark, sf_dir):
    return reports.geo_density(fx.metadata(spark, sf_dir), 5.0)


# ---------------------------------------------------------------- selection


@query
def closest_per_cluster(spark, sf_dir):
    return _assign(fx.chosen10(spark, sf_dir))


@query
def closest_five_per_cluster(spark, sf_dir):
    return _assign(selection.closest_per_cluster(fx.assign10(spark, sf_dir), 5))


@query
def balanced_sample(spark, sf_dir):
    return _assign(selection.balanced_sample(fx.assign10(spark, sf_dir), 128, fx.K))


@query
def balanced_sample_below_k(spark, sf_dir):
    return _assign(selection.balanced_sample(fx.assign10(spark, sf_dir), 7, fx.K))


@query
def proportional_sample(spark, sf_dir):
    return _assign(selection.proportional_sample(fx.assign10(spark, sf_dir)))


@query
def centroid_only_subset(spark, sf_dir):
    subset, stats = selection.centroid_only_subset(fx.assign10(spark, sf_dir), fx.K + 2)
    return subset.join(stats, "cluster_id")


@query
def cluster_members_topn(spark, sf_dir):
    found = selection.cluster_members_topn(fx.assign10(spark, sf_dir), [0, 3, 7, 99], 20)
    return found.withColumn("d2", _r(F.col("d2")))


@query
def renumber_row_groups(spark, sf_dir):
    subset = joins.gather(fx.manifest(spark, sf_dir), selection.closest_per_cluster(fx.assign10(spark, sf_dir), 20))
    return joins.renumber_row_groups(subset, "/data/subset").select("row_id", "parquet_file", "row_group", "row_in_rg")


@query
def rebase_manifest(spark, sf_dir):
    subset = joins.gather(fx.manifest(spark, sf_dir), fx.chosen10(spark, sf_dir)).drop("parquet_url", "parquet_row")
    return joins.rebase_manifest(subset)


@query
def rebase_manifest_overwrite(spark, sf_dir):
    return joins.rebase_manifest(fx.manifest(spark, sf_dir), overwrite=True)


@query
def size_curve(spark, sf_dir):
    return selection.size_curve(fx.sizes(spark, sf_dir))


@query
def size_curve_in_slices(spark, sf_dir):
    """The rank form for tables that one task must not sort."""
    held = fx.sizes(spark, sf_dir).filter(F.col("n_candidates") > 0)
    return ranking.running_total(held, [], [F.desc("n_candidates"), "cluster_id"], None, "rank")


@query
def cluster_rank(spark, sf_dir):
    return selection.cluster_rank(selection.cluster_counts(fx.assign10(spark, sf_dir), fx.K + 2))


@query
def large_clusters(spark, sf_dir):
    return selection.large_clusters(fx.sizes(spark, sf_dir))


@query
def first_large_clusters(spark, sf_dir):
    return selection.first_large_clusters(fx.sizes(spark, sf_dir))


@query
def pca_scatter(spark, sf_dir):
    found = reduction.pca_scatter(fx.tapered(spark, sf_dir))
    return found.select("row_id", *[_r(F.col(c)).alias(c) for c in ("pc1", "pc2", "pc3", "color")])


# ---------------------------------------------------------------- sets


@query
def union_chosen(spark, sf_dir):
    a = fx.assign10(spark, sf_dir)
    return _assign(selection.union_chosen([selection.closest_per_cluster(a, 1), selection.closest_per_cluster(a, 3)]))


@query
def garbage_clusters(spark, sf_dir):
    return _garbage(spark, sf_dir)


@query
def dark_clusters(spark, sf_dir):
    return reports.dark_clusters(fx.tiles(spark, sf_dir), fx.assign10(spark, sf_dir))


@query
def split_garbage(spark, sf_dir):
    return _split(spark, sf_dir)


@query
def garbage_tally(spark, sf_dir):
    return reports.garbage_tally(_split(spark, sf_dir))


# ---------------------------------------------------------------- whole runs


@query
def select_subset(spark, sf_dir):
    return choose(fx.manifest(spark, sf_dir), fx.vectors(spark, sf_dir), SELECTION).subset


@query
def select_subset_stats(spark, sf_dir):
    return choose(fx.manifest(spark, sf_dir), fx.vectors(spark, sf_dir), SELECTION).stats


@query
def run_steps(spark, sf_dir):
    """Both steps from stored metadata and shards; the model gives the mean of every channel, of pixels in double.

    Means are rounded to single precision once, as in the SQL, so that tiles with equal means tie.
    """
    models.register_model("channel-means", _channel_means)
    cfg = _run_config(spark, sf_dir, "channel-means", fx.SIDE, _stored_metadata(spark, sf_dir), pixels="double")
    subset = steps(spark, cfg, [1, 2])
    return subset.withColumn("parquet_file", basename(F.col("parquet_file")))


def _materialized(spark, sf_dir):
    """Chosen tiles and their twins in absent shards."""
    near = selection.closest_per_cluster(fx.assign10(spark, sf_dir), 20)
    twins = near.withColumn("row_id", F.col("row_id") + 1000000)
    subset = joins.gather(fx.manifest_with_absent(spark, sf_dir), near.unionByName(twins)).drop("parquet_url", "parquet_row")
    dest = scratch_path(spark, "materialized")
    return materialize(spark, fx.images_dir(spark, sf_dir), subset, dest, RGB)


@query
def materialize_subset(spark, sf_dir):
    made = _materialized(spark, sf_dir)
    return made.manifest.select("row_id", "cluster_id", "parquet_url", "parquet_row", "row_group", "row_in_rg")


@query
def materialize_subset_report(spark, sf_dir):
    return _materialized(spark, sf_dir).report
