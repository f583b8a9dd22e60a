"""Manifests, joins, selections and whole runs."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilesieve.catalog import fixtures as fx
from tilesieve.config import DataConfig, ExtractionConfig, RunConfig, SelectionConfig
from tilesieve.functions.text import after_images
from tilesieve.operators import joins, selection, tiles as tl
from tilesieve.plans.materialize import materialize_subset
from tilesieve.plans.select import select_subset
from tilesieve.plans.steps import run_steps
from tilesieve.sources import manifest as man
from tilesieve.sources import reports as rep
from tilesieve.sources import tiles as src


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- manifests


def test_positions_run_over_all_files(spark, tmp_path):
    path = str(tmp_path / "metadata")
    meta = spark.range(0, 100, 1, 4).selectExpr(
        "concat('c', id) AS grid_cell", "concat('h/images/', id) AS parquet_url", "id AS parquet_row",
        "0D AS centre_lat", "0D AS centre_lon", "0D AS cloud_cover", "0D AS nodata",
    )
    meta.write.parquet(path)
    placed = man.with_positions(spark, path)
    assert placed.filter("row_id <> parquet_row").count() == 0 and placed.select("row_id").distinct().count() == 100


def test_images_has_to_occur_once(spark):
    df = spark.createDataFrame([("a/images/b.parquet",), (None,)], "u string")
    assert rows(df.select(after_images(F.col("u")))) == [("b.parquet",), (None,)]
    for bad in ("a/b.parquet", "images/images/b.parquet"):
        with pytest.raises(Exception, match="exactly once"):
            spark.createDataFrame([(bad,)], "u string").select(after_images(F.col("u"))).collect()


def test_missing_metadata(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        man.load_or_build_manifest(spark, str(tmp_path / "m"), str(tmp_path / "none"), "/images")
    with pytest.raises(ValueError, match="rule"):
        man.build_manifest(spark.range(1).select(F.lit("x").alias("parquet_url")), "/images", "other")


# ---------------------------------------------------------------- joins


def test_alignment(spark):
    a, b = spark.range(5).withColumnRenamed("id", "row_id"), spark.range(1, 5).withColumnRenamed("id", "row_id")
    joins.check_alignment(b, b)
    with pytest.raises(ValueError, match=r"manifest \(5 rows\) and embeddings \(4 rows\)"):
        joins.check_alignment(a, b)


def test_enrich_takes_the_first_row_and_matches_null_keys(spark):
    subset = spark.createDataFrame(
        [(1, "f.parquet", "a", 7), (2, "f.parquet", None, 8), (3, None, "a", 9), (4, "z.parquet", "a", 9)],
        "row_id bigint, parquet_url string, grid_cell string, extra int",
    )
    original = spark.createDataFrame(
        [(9, "h/f.parquet", "a", -1.0), (5, "h/f.parquet", "a", 0.5), (6, "f.parquet", None, 0.6), (7, None, "a", 0.7)],
        "row_id bigint, parquet_url string, grid_cell string, cloud_cover double",
    )
    got = {r["row_id"]: r for r in joins.enrich_metadata(subset, original).collect()}
    assert len(got) == 4
    assert [got[i]["cloud_cover"] for i in (1, 2, 3, 4)] == [0.5, 0.6, 0.7, None]
    assert got[1]["parquet_url_subset"] == "f.parquet" and got[1]["parquet_url_original"] == "h/f.parquet"
    assert got[1]["extra"] == 7


def test_enrich_with_a_hot_key(spark):
    subset = spark.range(3000).selectExpr("id AS row_id", "if(id % 3 = 0, 'hot', concat('f', id)) AS parquet_url", "'c' AS grid_cell")
    original = spark.range(6000).selectExpr("id AS row_id", "if(id % 3 = 0, 'hot', concat('f', id)) AS parquet_url", "'c' AS grid_cell", "id AS v")
    got = joins.enrich_metadata(subset, original)
    assert got.count() == 3000
    assert rows(got.filter("parquet_url_subset = 'hot'").select("v").distinct()) == [(0,)]


def test_a_row_named_twice_keeps_one_number(spark):
    df = spark.createDataFrame(
        [(1, "/a/f.parquet", 7, 0), (2, "/a/f.parquet", 7, 0), (3, "/a/f.parquet", 9, 0)],
        "row_id bigint, parquet_file string, row_group int, row_in_rg int",
    )
    got = {r["row_id"]: (r["parquet_file"], r["row_group"]) for r in joins.renumber_row_groups(df, "/b").collect()}
    assert got == {1: ("/b/f.parquet", 0), 2: ("/b/f.parquet", 0), 3: ("/b/f.parquet", 1)}


def test_nan_coordinates_are_dropped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 2.0), (1.0, None)], "centre_lat double, centre_lon double")
    assert joins.drop_null_coords(df).count() == 1


def test_rebase_leaves_an_existing_url(spark):
    df = spark.createDataFrame([("/a/b.parquet", "keep", 3)], "parquet_file string, parquet_url string, row_group int")
    assert joins.rebase_manifest(df).first()["parquet_url"] == "keep"
    assert joins.rebase_manifest(df, overwrite=True).first()["parquet_url"] == "b.parquet"


# ---------------------------------------------------------------- selection


@pytest.fixture(scope="module")
def assign(spark):
    """1,200 points in clusters 0..9; cluster 3 holds a third, cluster 8 is empty."""
    return spark.range(1200).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, 3).otherwise(F.element_at(F.array(*[F.lit(i) for i in (0, 1, 2, 4, 5, 6, 7, 9)]), (F.col("id") % 8 + 1).cast("int"))).alias("cluster_id"),
        ((F.col("id") * 7919) % 211 / 211.0).alias("d2"),
    )


def test_quota_below_one_exceeds_the_target(spark, assign):
    full = assign.withColumn("cluster_id", (F.col("row_id") % 10).cast("int"))
    assert selection.balanced_sample(full, 7, 10).count() == 17


def test_target_beyond_the_table_takes_all(spark, assign):
    assert selection.balanced_sample(assign, 10**6, 10).count() == 1200


def test_shortfall_is_not_redistributed(spark, assign):
    got = {r["cluster_id"]: r["count"] for r in selection.balanced_sample(assign, 2000, 10).groupBy("cluster_id").count().collect()}
    assert got[3] == 200 and all(got[c] == 100 for c in got if c != 3) and 8 not in got


def test_large_quotas_take_the_sliced_form(spark, assign, monkeypatch):
    want = rows(selection.balanced_sample(assign, 500, 10))
    monkeypatch.setattr("tilesieve.operators.ranking.TOP_N_LIMIT", 1)
    monkeypatch.setattr("tilesieve.operators.ranking.LARGE_GROUP", 1)
    assert rows(selection.balanced_sample(assign, 500, 10)) == want


def test_closest_breaks_ties_by_row_id(spark):
    df = spark.createDataFrame([(5, 0, 0.1), (2, 0, 0.1), (9, 1, 0.3)], "row_id bigint, cluster_id int, d2 double")
    assert rows(selection.closest_per_cluster(df).select("row_id")) == [(2,), (9,)]
    assert rows(selection.closest_per_cluster(df, 2).select("row_id")) == [(2,), (5,), (9,)]


def test_strict_bound_of_large_clusters(spark):
    stats = spark.createDataFrame([(0, 99), (1, 100)], "cluster_id int, n_candidates bigint")
    assert rows(selection.large_clusters(stats)) == [(1, 100)]


def test_stats_file_is_sorted(spark, tmp_path, assign):
    stats = selection.cluster_stats(assign, selection.closest_per_cluster(assign), 10, ranked=True)
    path = str(tmp_path / "stats")
    rep.write_cluster_stats(stats, path)
    back = rep.read_cluster_stats(spark, path, ranked=True)
    assert [r["cluster_id"] for r in back.collect()] == list(range(10))
    assert rows(back) == rows(stats)


# ---------------------------------------------------------------- runs


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return fx.manifest(spark, sf_dir), fx.vectors(spark, sf_dir)


def test_selection_methods(spark, inputs):
    base = SelectionConfig(n_clusters=8, max_iter=2, batch_size=300, target_n_tiles=50, threshold=0.95, threshold_attempts=3)
    for method in ("lloyd", "kmeans", "mini-batch-kmeans", "birch", "birch-threshold-only"):
        found = select_subset(*inputs, dataclasses.replace(base, method=method))
        stats = found.stats.orderBy("cluster_id").collect()
        assert sum(r["n_candidates"] for r in stats) == 500
        assert [r["cluster_id"] for r in stats] == list(range(len(stats)))
        n = found.subset.count()
        assert n == sum(r["n_sampled"] for r in stats)
        assert found.centroids.count() == len(stats)
        assert ("parquet_url" in found.subset.columns) is False
        if method == "lloyd":
            assert n <= 8
    with pytest.raises(ValueError, match="unknown clustering method"):
        select_subset(*inputs, dataclasses.replace(base, method="other"))


def test_selection_options(spark, inputs):
    cfg = SelectionConfig(n_clusters=5, max_iter=1, pca_components=6, test_subset_size=200, keep_distance=True)
    found = select_subset(*inputs, cfg)
    assert found.assign.count() == 200
    assert len(found.centroids.first()["centroid"]) == 6
    distance = [r[0] for r in found.subset.select("distance_to_centroid").collect()]
    assert all(0 <= d <= 2 for d in distance)


def config(spark, sf_dir, tmp_path, **options):
    meta = str(tmp_path / "metadata")
    fx.metadata(spark, sf_dir).drop("row_id").coalesce(1).write.parquet(meta)
    return RunConfig(
        DataConfig(meta, fx.images_dir(spark, sf_dir), str(tmp_path / "out")),
        ExtractionConfig(model="projection", crop_size=6, tile_height=8, tile_width=8, **options),
        SelectionConfig(n_clusters=6, max_iter=2),
    )


def test_steps_through_stored_tables(spark, sf_dir, tmp_path):
    cfg = config(spark, sf_dir, tmp_path)
    subset = run_steps(spark, cfg, [1, 2])
    kept = spark.read.parquet(cfg.data.table("embeddings")).count()
    t = fx.tiles(spark, sf_dir)
    assert kept == tl.filter_nodata(tl.null_band_policy(t)).count()
    status = spark.read.parquet(cfg.data.table("tile_status"))
    assert status.count() == t.count() and status.filter("status = 'kept'").count() == kept
    stats = rep.read_cluster_stats(spark, cfg.data.table("cluster_stats"))
    assert stats.agg(F.sum("n_candidates")).first()[0] == kept
    # step 2 alone, from the stored embeddings, gives the same subset
    again = dataclasses.replace(cfg, data=dataclasses.replace(cfg.data, output_dir=str(tmp_path / "again")))
    for name in ("manifest", "embeddings"):
        spark.read.parquet(cfg.data.table(name)).write.parquet(again.data.table(name))
    assert rows(run_steps(spark, again, [2])) == rows(subset)
    with pytest.raises(ValueError, match="unknown step 3"):
        run_steps(spark, cfg, [3])


def test_a_stopped_extraction_goes_on(spark, sf_dir, tmp_path, monkeypatch):
    from tilesieve.plans import extract

    whole = config(spark, sf_dir, tmp_path / "a")
    want = rows(extract.extract_features(spark, whole))
    cfg = config(spark, sf_dir, tmp_path / "b", slices=4)
    prepared, original = [], extract.prepare_wanted

    def prepare(spark, manifest, cfg):
        prepared.append(manifest.agg(F.min("row_id"), F.max("row_id")).first())
        return original(spark, manifest, cfg)

    def stopped(df, path, **how):
        if path.endswith("embeddings-000002"):
            df.limit(1).select("row_id", F.array(F.lit(9.0)).alias("embedding")).write.parquet(path)
            raise RuntimeError("lost")
        written_as_ever(df, path, **how)

    written_as_ever = extract.write_embeddings
    monkeypatch.setattr(extract, "prepare_wanted", prepare)
    monkeypatch.setattr(extract, "write_embeddings", stopped)
    with pytest.raises(RuntimeError, match="lost"):
        extract.extract_features(spark, cfg)
    assert len(prepared) == 3 and man.read_if_present(spark, cfg.data.table("embeddings")) is None
    monkeypatch.setattr(extract, "write_embeddings", written_as_ever)
    # Other settings do not go on with it.
    other = dataclasses.replace(cfg, extraction=dataclasses.replace(cfg.extraction, nodata_threshold=0.1))
    with pytest.raises(ValueError, match="other settings"):
        extract.extract_features(spark, other)
    got = extract.extract_features(spark, cfg)
    # Slices 0 and 1 are not prepared again, the half-written slice 2 is.
    assert len(prepared) == 5 and prepared[3] == prepared[2] and rows(got) == want
    status = lambda c: rows(spark.read.parquet(c.data.table("tile_status")))
    assert status(cfg) == status(whole)
    # A run that is whole does nothing more.
    assert rows(extract.extract_features(spark, cfg)) == want and len(prepared) == 5


def test_publishing_goes_on_and_other_tables_stay(spark, sf_dir, tmp_path, monkeypatch):
    from tilesieve.plans import extract

    cfg = config(spark, sf_dir, tmp_path, slices=3, sample_fraction=0.4)
    foreign = spark.range(1).selectExpr("id AS row_id", "array(1F) AS embedding")
    foreign.write.parquet(cfg.data.table("embeddings"))
    with pytest.raises(FileExistsError):
        extract.extract_features(spark, cfg)
    assert rows(spark.read.parquet(cfg.data.table("embeddings"))) == rows(foreign)
    moved = dataclasses.replace(cfg, data=dataclasses.replace(cfg.data, output_dir=str(tmp_path / "second")))
    commit = extract._commit
    monkeypatch.setattr(extract, "_commit", lambda s, c, n: commit(s, c, n) if n != extract._WHOLE else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        extract.extract_features(spark, moved)
    monkeypatch.setattr(extract, "_commit", commit)
    monkeypatch.setattr(extract, "_extract_slice", None)
    n = extract.extract_features(spark, moved).count()
    assert 0 < n <= 200 and spark.read.parquet(moved.data.table("tile_status")).count() == 200


def test_a_search_in_waves_reads_few_tiles(spark, sf_dir):
    from tilesieve.operators import sampling

    images, manifest = fx.images_dir(spark, sf_dir), fx.manifest(spark, sf_dir)
    whole = src.read_tiles(spark, images, manifest, tl.RGB)
    asked = []

    def read(keys):
        asked.append(keys.count())
        return src.read_tiles(spark, images, keys, tl.RGB)

    often, never = F.col("row_id") % 5 == 0, F.col("row_id") < 0
    for k, first, within, seed in ((3, None, None, 42), (40, 10, None, 7), (3, 10, 60, 42), (1000, 50, None, 42)):
        asked.clear()
        got = sampling.first_matching_in_waves(manifest, read, often, k, seed=seed, within=within, first=first)
        want = sampling.first_matching(whole, often, k, seed=seed, within=within)
        assert rows(got.select("row_id")) == rows(want.select("row_id"))
        assert sum(asked) <= (500 if within is None else within)
        if k == 3:
            assert sum(asked) < 120
    assert sampling.first_matching_in_waves(manifest, read, never, 2, first=20).count() == 0
    empty = manifest.limit(0)
    assert sampling.first_matching_in_waves(empty, read, often, 2).count() == 0


def test_unreadable_tiles_can_be_embedded_as_zeros(spark, sf_dir, tmp_path):
    from tilesieve.plans.extract import prepare_and_embed_tiles

    wanted = fx.manifest_with_absent(spark, sf_dir)
    drop = prepare_and_embed_tiles(spark, wanted, config(spark, sf_dir, tmp_path, on_error="drop"))
    zeros = prepare_and_embed_tiles(spark, wanted, config(spark, sf_dir, tmp_path / "z", on_error="zeros"))
    assert zeros.count() == drop.count() + 500
    blank = zeros.filter("row_id >= 1000000").select("embedding").distinct().collect()
    assert len(blank) == 1 and np.isfinite(blank[0][0]).all()


def test_materialized_rows_are_addressed_by_the_new_manifest(spark, sf_dir, tmp_path):
    images = fx.images_dir(spark, sf_dir)
    chosen = selection.closest_per_cluster(fx.assign10(spark, sf_dir), 7)
    subset = joins.gather(fx.manifest(spark, sf_dir), chosen).drop("parquet_url", "parquet_row")
    made = materialize_subset(spark, images, subset, str(tmp_path / "sub"), tl.RGB)
    before = src.read_tiles(spark, images, subset, tl.RGB).select("row_id", *tl.RGB)
    after = src.read_tiles(spark, str(tmp_path / "sub" / "images"), made.manifest, tl.RGB).select("row_id", *tl.RGB)
    assert rows(before) == rows(after)
    assert made.report.filter("not complete").count() == 0


def test_clusters_of_the_first_half_dark_tiles(spark, sf_dir):
    from tilesieve.operators import reports

    images, manifest, assign = fx.images_dir(spark, sf_dir), fx.manifest(spark, sf_dir), fx.assign10(spark, sf_dir)
    read = lambda keys: tl.decode_raw_band(src.read_tiles(spark, images, keys, tl.RGB))
    for most, within in ((3, None), (5, 100)):
        want = reports.dark_clusters(read(manifest), assign, most=most, within=within)
        assert rows(reports.dark_clusters_of(manifest, read, assign, most, within=within)) == rows(want) != []
