"""Raw tiles, shards and images."""

import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tilesieve.functions import bands as bd
from tilesieve.operators import models
from tilesieve.operators import tiles as tl
from tilesieve.plans.materialize import materialize_subset
from tilesieve.session import written
from tilesieve.sources import tiles as src

RGB = list(tl.RGB)


def blob(values):
    return struct.pack(f"<{len(values)}H", *values)


def shard(path, tiles, group=1):
    """A Parquet file with one tile per row and ``group`` rows per row group."""
    table = pa.table({b: pa.array([t[i] for t in tiles], pa.binary()) for i, b in enumerate(RGB)})
    pq.write_table(table, path, row_group_size=group)


@pytest.fixture()
def images(tmp_path):
    folder = tmp_path / "images"
    folder.mkdir()
    for s in range(3):
        shard(folder / f"part_{s}.parquet", [[blob([s, t, b, 9]) for b in range(3)] for t in range(4)])
    return str(folder)


def manifest(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, parquet_file string, row_group int, row_in_rg int")


@pytest.mark.parametrize("max_bytes", [1 << 28, 384])
def test_read_tiles_addresses_rows(spark, images, max_bytes):
    wanted = manifest(spark, [(i, f"/x/part_{i % 3}.parquet", i % 4, 0) for i in range(12)] + [(99, "/x/gone.parquet", 0, 0)])
    found = tl.decode_raw_band(src.read_tiles(spark, images, wanted, RGB, max_bytes=max_bytes)).collect()
    assert sorted(r["row_id"] for r in found) == list(range(12))
    for r in found:
        assert r["B03"] == [r["row_id"] % 3, r["row_id"] % 4, 1, 9]


def test_a_row_named_twice_is_read_twice_but_extracted_once(spark, images):
    wanted = manifest(spark, [(0, "/x/part_1.parquet", 2, 0), (1, "/x/part_1.parquet", 2, 0)])
    assert src.read_tiles(spark, images, wanted, RGB).count() == 2
    assert src.extract_subset_rows(spark, images, wanted, RGB).count() == 1


def test_larger_row_groups_are_addressed_through_the_footers(spark, tmp_path):
    folder = tmp_path / "grouped"
    folder.mkdir()
    shard(folder / "part_0.parquet", [[blob([t, b]) for b in range(3)] for t in range(10)], group=3)
    starts = src.row_group_starts(spark, str(folder))
    assert sorted(tuple(r) for r in starts.collect()) == [("part_0.parquet", i, 3 * i) for i in range(4)]
    wanted = manifest(spark, [(5, "/x/part_0.parquet", 2, 1)])
    got = tl.decode_raw_band(src.read_tiles(spark, str(folder), wanted, RGB, starts)).first()
    assert got["B04"] == [7, 0]


def test_rows_behind_a_group_are_not_those_of_the_next(spark, tmp_path):
    folder = tmp_path / "grouped"
    folder.mkdir()
    shard(folder / "part_0.parquet", [[blob([t, b]) for b in range(3)] for t in range(10)], group=3)
    wanted = manifest(spark, [(0, "/x/part_0.parquet", 1, 2), (1, "/x/part_0.parquet", 1, 3), (2, "/x/part_0.parquet", 4, 0), (3, None, 0, 0)])
    got = tl.decode_raw_band(src.read_tiles(spark, str(folder), wanted, RGB)).collect()
    assert [(r["row_id"], r["B04"]) for r in got] == [(0, [5, 0])]
    assert sorted(r["row_id"] for r in src.missing_rows(spark, str(folder), wanted).collect()) == [1, 2, 3]


def test_extracted_rows_keep_all_columns_and_types(spark, tmp_path, capsys):
    folder = tmp_path / "typed"
    folder.mkdir()
    for s in range(2):
        table = pa.table(
            {
                "B04": pa.array([blob([s, t]) for t in range(8)], pa.binary()),
                "a.b": pa.array([t / 2 for t in range(8)]),
                "product": pa.array([f"{s}-{t}" if t % 2 else None for t in range(8)]),
                "box": pa.array([{"x": t, "y": [s]} for t in range(8)]),
            }
        )
        pq.write_table(table, folder / f"part_{s}.parquet", row_group_size=3)
    wanted = manifest(spark, [(i, f"/x/part_{i % 2}.parquet", g, 1) for i, g in enumerate([0, 0, 2, 1])] + [(9, "/x/gone.parquet", 0, 0)])
    rows = src.extract_subset_rows(spark, str(folder), wanted)
    rows.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    made = materialize_subset(spark, str(folder), wanted, str(tmp_path / "out"))
    back = src.open_shards(spark, str(tmp_path / "out" / "images"), None).select("shard", "row_in_file", "`a.b`", "product", "box").collect()
    assert sorted((r[0], r[1], r[2], r[3], r[4].x, list(r[4].y)) for r in back) == [
        ("part_0.parquet", 0, 0.5, "0-1", 1, [0]),
        ("part_0.parquet", 1, 3.5, "0-7", 7, [0]),
        ("part_1.parquet", 0, 0.5, "1-1", 1, [1]),
        ("part_1.parquet", 1, 2.0, None, 4, [1]),
    ]
    again = src.read_tiles(spark, str(tmp_path / "out" / "images"), made.manifest, ["B04"]).select("row_id", F.hex("B04").alias("h")).collect()
    assert {r["row_id"]: r["h"] for r in again} == {0: "00000100", 1: "01000100", 2: "00000700", 3: "01000400"}
    assert [(r["shard"], r["n_missing"]) for r in made.report.filter("not complete").collect()] == [("gone.parquet", 1)]


def test_only_named_row_groups_and_columns_are_opened(spark, tmp_path, capsys):
    """What lies in other row groups, columns and shards is overwritten, and nobody notices."""
    folder = tmp_path / "torn"
    folder.mkdir()
    for s in range(3):
        shard(folder / f"part_{s}.parquet", [[blob([s, t, b]) for b in range(3)] for t in range(12)], group=3)
    wanted = manifest(spark, [(0, "/x/part_1.parquet", 2, 0), (1, "/x/part_1.parquet", 2, 2)])
    groups = written(src.row_groups(spark, str(folder), wanted), "groups")
    for s in range(3):
        path = folder / f"part_{s}.parquet"
        about = pq.ParquetFile(path).metadata
        with open(path, "r+b") as out:
            for g in range(about.num_row_groups):
                for c in range(about.num_columns):
                    column = about.row_group(g).column(c)
                    if (s, g, column.path_in_schema) != (1, 2, "B04"):
                        out.seek(min(x for x in (column.dictionary_page_offset, column.data_page_offset) if x))
                        out.write(b"\xff" * column.total_compressed_size)
    frame = src.read_tiles(spark, str(folder), wanted, ["B04"], groups)
    assert sorted((r["row_id"], r["row_in_file"], r["B04"][1]) for r in tl.decode_raw_band(frame, ["B04"]).collect()) == [(0, 6, 6), (1, 8, 8)]
    with pytest.raises(Exception, match="part_1.parquet"):
        src.read_tiles(spark, str(folder), wanted, ["B03"], groups).collect()
    frame.explain()
    assert "FileScan parquet [B04" not in capsys.readouterr().out


def test_a_row_group_larger_than_a_task_may_hold_is_streamed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(src, "HELD_BYTES", 8)
    folder = tmp_path / "large"
    folder.mkdir()
    shard(folder / "part_0.parquet", [[blob([t, b]) for b in range(3)] for t in range(50)], group=50)
    wanted = manifest(spark, [(t, "/x/part_0.parquet", 0, t) for t in (49, 0, 7, 8, 31)] + [(100, "/x/part_0.parquet", 0, 7)])
    got = tl.decode_raw_band(src.read_tiles(spark, str(folder), wanted, RGB)).collect()
    assert sorted((r["row_id"], r["B04"][0]) for r in got) == [(0, 0), (7, 7), (8, 8), (31, 31), (49, 49), (100, 7)]


def test_a_shard_of_any_size_is_written_by_several_tasks(spark, images, tmp_path):
    wanted = manifest(spark, [(i, f"/x/part_{i % 3}.parquet", 3 - i // 3, 0) for i in range(12)])
    out = str(tmp_path / "written")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        src.write_shards(src.extract_subset_rows(spark, images, wanted, RGB), out, rows_per_file=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "written").glob("shard=*")}
    assert len(files) == 3 and max(files.values()) > 1
    back = tl.decode_raw_band(src.open_shards(spark, out, RGB)).collect()
    assert sorted((r["shard"], r["row_in_file"], r["B04"][1]) for r in back) == [(f"part_{s}.parquet", t, t) for s in range(3) for t in range(4)]


def test_an_unreadable_shard_is_reported(spark, images):
    with open(f"{images}/part_1.parquet", "wb") as out:
        out.write(b"no parquet at all")
    wanted = manifest(spark, [(i, f"/x/part_{i % 3}.parquet", i % 4, 0) for i in range(12)])
    with pytest.raises(Exception, match="part_1.parquet"):
        src.read_tiles(spark, images, wanted, RGB).collect()
    found = src.read_tiles(spark, images, wanted, RGB, tolerant=True)
    assert sorted(r["row_id"] for r in found.select("row_id").collect()) == [i for i in range(12) if i % 3 != 1]
    bad = src.missing_sources(spark, images, wanted).filter("not complete").collect()
    assert [(r["shard"], r["n_rows"], r["n_missing"]) for r in bad] == [("part_1.parquet", 4, 4)]
    made = materialize_subset(spark, images, wanted, f"{images}-out", RGB)
    assert made.manifest.count() == 8
    assert [r["shard"] for r in made.report.filter("not complete").collect()] == ["part_1.parquet"]


def test_missing_sources(spark, images):
    wanted = manifest(spark, [(0, "/x/part_0.parquet", 0, 0), (1, "/x/part_0.parquet", 7, 0), (2, "/x/gone.parquet", 0, 0)])
    got = {r["shard"]: (r["n_rows"], r["n_missing"], r["complete"]) for r in src.missing_sources(spark, images, wanted).collect()}
    assert got == {"part_0.parquet": (2, 1, False), "gone.parquet": (1, 1, False)}


def test_decode_struct_and_null(spark):
    df = spark.createDataFrame([(0, (bytearray(blob([1, 256, 65535])),)), (1, None)], "row_id bigint, B04 struct<bytes:binary>")
    got = tl.decode_raw_band(df, ["B04"]).orderBy("row_id").collect()
    assert got[0]["B04"] == [1, 256, 65535] and got[1]["B04"] is None


def bands_frame(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, B04 array<int>, B03 array<int>, B02 array<int>")


def test_nodata_equal_to_the_threshold_is_kept(spark):
    def tile(zeros):
        return [0] * zeros + [5] * (100 - zeros)

    df = bands_frame(spark, [(z, tile(z), tile(z), tile(z)) for z in (44, 45, 46)])
    assert sorted(r["row_id"] for r in tl.filter_nodata(df).collect()) == [44, 45]
    status = {r["row_id"]: r["s"] for r in df.select("row_id", bd.tile_outcome(F.lit(True), [F.col(b) for b in RGB]).alias("s")).collect()}
    assert status == {44: "kept", 45: "kept", 46: "nodata"}
    raw = spark.createDataFrame([(z, *[bytearray(blob(tile(z)))] * 3) for z in (44, 45, 46)], "row_id bigint, B04 binary, B03 binary, B02 binary")
    made = {r["row_id"]: r["status"] for r in tl.prepare_tiles(raw, 10, 10, 5).collect()}
    assert made == status


def test_two_definitions_of_no_data(spark):
    df = bands_frame(spark, [(0, [0, 0, 1, 1], [0, 1, 1, 1], [0, 1, 1, 0])])
    cols = [F.col(b) for b in RGB]
    row = df.select(bd.nodata_fraction(*cols).alias("a"), bd.zero_value_pct(*cols).alias("b")).first()
    assert row["a"] == 0.25 and np.isclose(row["b"], 100 * 5 / 12)


def test_unreadable_and_short_blobs(spark):
    raw = spark.createDataFrame(
        [(0, bytearray(b"x"), bytearray(b"x"), bytearray(b"x")), (1, None, bytearray(blob([1] * 4)), bytearray(blob([1] * 4)))],
        "row_id bigint, B04 binary, B03 binary, B02 binary",
    )
    got = {r["row_id"]: r["status"] for r in tl.prepare_tiles(raw, 2, 2, 2).collect()}
    assert got == {0: "read_error", 1: "null_band"}
    everything = spark.range(3).withColumnRenamed("id", "row_id")
    status = {r["row_id"]: r["status"] for r in tl.tile_status(everything, tl.prepare_tiles(raw, 2, 2, 2)).collect()}
    assert status[2] == "read_error"


def bicubic(image, size):
    """Direct four-by-four neighbourhood sums."""

    def kernel(t, a=-0.75):
        t = abs(t)
        if t <= 1:
            return (a + 2) * t**3 - (a + 3) * t**2 + 1
        return a * t**3 - 5 * a * t**2 + 8 * a * t - 4 * a if t < 2 else 0.0

    h, w = image.shape
    out = np.zeros((size, size))
    for i in range(size):
        for j in range(size):
            y, x = (i + 0.5) * h / size - 0.5, (j + 0.5) * w / size - 0.5
            for p in range(int(np.floor(y)) - 1, int(np.floor(y)) + 3):
                for q in range(int(np.floor(x)) - 1, int(np.floor(x)) + 3):
                    value = image[min(max(p, 0), h - 1), min(max(q, 0), w - 1)]
                    out[i, j] += kernel(y - p) * kernel(x - q) * value
    return out


@pytest.mark.parametrize("h,w,size", [(9, 13, 5), (6, 6, 11), (20, 7, 7)])
def test_resize_is_bicubic(h, w, size):
    image = np.random.default_rng(3).random((2, h, w))
    got = tl.resizer(h, w, size)(image)
    assert np.allclose(got, [bicubic(b, size) for b in image])
    assert np.allclose(tl.cubic_weights(h, size).sum(1), 1)
    assert np.allclose(tl.resizer(h, w, size)(np.full((1, h, w), 0.3)), 0.3)


def test_resize_to_the_same_size_changes_nothing():
    image = np.random.default_rng(3).random((1, 6, 6))
    assert np.allclose(tl.resizer(6, 6, 6)(image), image)


def test_band_stats_skip_tiles_with_a_null_band(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 12000, 30).tolist(), rng.integers(0, 12000, 30).tolist()
    df = bands_frame(spark, [(0, a, b, a), (1, b, b, b), (2, a, None, a)])
    got = {r["band"]: r for r in tl.band_stats(df).collect()}
    pixels = np.array(a + b) / 10000
    assert got["B04"]["n_tiles"] == 2
    assert np.isclose(got["B04"]["mean"], pixels.mean()) and np.isclose(got["B04"]["std"], pixels.std())


def test_measures_of_blobs(spark):
    raw = spark.createDataFrame(
        [
            (0, bytearray(blob([0, 0, 5, 10000])), bytearray(blob([0, 7, 5, 1])), bytearray(blob([0, 0, 0, 2]))),
            (1, None, bytearray(blob([0, 0, 0, 0])), bytearray(blob([0, 0, 0, 0]))),
            (2, None, None, None),
        ],
        "row_id bigint, B04 binary, B03 binary, B02 binary",
    )
    got = tl.measure_tiles(raw).collect()
    assert [r["row_id"] for r in got] == [0]
    assert got[0]["nodata"] == 0.25 and np.isclose(got[0]["zero_pct"], 100 * 6 / 12) and not got[0]["is_black"]
    assert np.allclose(got[0]["sums"], [1.0005, 0.0013, 0.0002])
    zeros = {r["row_id"]: r for r in tl.measure_tiles(raw, null_bands="zeros").collect()}
    assert sorted(zeros) == [0, 1] and zeros[1]["is_black"] and zeros[1]["zero_pct"] == 100


def test_measures_of_unreadable_blobs(spark):
    two = bytearray(blob([1, 2]))
    raw = spark.createDataFrame(
        [(0, two, two, two), (1, two, bytearray(b"abc"), two), (2, two, bytearray(b"ab"), two), (3, *[bytearray(b"")] * 3)],
        "row_id bigint, B04 binary, B03 binary, B02 binary",
    )
    got = tl.measure_tiles(raw)
    assert {r["row_id"]: (r["status"], r["nodata"]) for r in got.collect()} == {0: ("kept", 0.0), **{i: ("read_error", None) for i in (1, 2, 3)}}
    assert {r["n_tiles"] for r in tl.band_stats_of_measures(got).collect()} == {1}


def test_resize_of_frames_with_null_bands(spark):
    image = [float(x) for x in range(12)]
    df = spark.createDataFrame([(0, image, None, image), (1, None, None, None), (2, image, image, image)], "row_id bigint, B04 array<double>, B03 array<double>, B02 array<double>")
    got = {r["row_id"]: r for r in tl.resize_bicubic(df, 3, 4, 2).collect()}
    want = bicubic(np.reshape(image, (3, 4)), 2).ravel()
    for i, present in {0: "B04 B02", 1: "", 2: "B04 B03 B02"}.items():
        for b in RGB:
            assert np.allclose(got[i][b], want) if b in present.split() else got[i][b] is None


def test_model_outputs_and_names():
    x = np.ones((2, 3))
    for out in (x, (x, "rest"), {"x_norm_clstoken": x}):
        assert (models.vectors_of(out) == x).all()
    with pytest.raises(ValueError, match="unknown model"):
        models.model_factory("no such model")


def test_embedding_keeps_rows_and_ids(spark):
    raw = spark.createDataFrame([(i, *[bytearray(blob([i + 1] * 16))] * 3) for i in range(10)], "row_id bigint, B04 binary, B03 binary, B02 binary")
    made = tl.prepare_tiles(raw, 4, 4, 4)
    got = {r["row_id"]: r["embedding"] for r in tl.embed_tiles(made, models.model_factory("projection"), 4, 3).collect()}
    model = models.projection()
    for i in range(10):
        pixels = np.concatenate([np.full(16, ((i + 1) / 10000 - m) / s) for m, s in zip((0.430, 0.411, 0.296), (0.213, 0.156, 0.143))])
        assert np.allclose(got[i], model(pixels.astype(np.float32)[None])[0], atol=1e-4)


def test_black_and_display(spark):
    df = bands_frame(spark, [(0, [0, 0], [0, 0], [0, 0]), (1, [0, 0], [0, 0], [0, 3001])])
    cols = [F.col(b) for b in RGB]
    assert [r[0] for r in df.orderBy("row_id").select(bd.is_black_tile(*cols)).collect()] == [True, False]
    assert df.orderBy("row_id").select(bd.display_rgb(F.col("B02"))).collect()[1][0] == [0, 255]
