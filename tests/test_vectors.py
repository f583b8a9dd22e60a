"""Nearest centroids, pair distances, k-means and radius clustering against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tilesieve.catalog import fixtures as fx
from tilesieve.operators import blocks, clustering, nearest, neighbours, pairs, reduction, thresholds
from tilesieve.session import written


def frame(spark, values, key="row_id", vec="embedding", partitions=4):
    table = pa.table({key: pa.array(range(len(values)), pa.int64()), vec: blocks.list_array(np.asarray(values, float))})
    return spark.createDataFrame(table).repartition(partitions)


def brute(x, c):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12))
    x[100:233] = x[100]  # a third of the points are copies
    return x


@pytest.mark.parametrize("cells", [10, 1000, 4_000_000])
def test_kernel_is_brute_force_with_ties_to_the_lowest_id(cloud, cells, monkeypatch):
    monkeypatch.setattr(nearest, "CELLS", cells)
    monkeypatch.setattr(nearest, "LEAST_ROWS", 7)
    c = np.vstack([cloud[50:60], cloud[50:60], cloud[95:105]])
    ids = np.arange(100, 100 + len(c))
    labels, d2 = nearest.Finder(ids, c)(cloud)
    want, dist = brute(cloud, c)
    assert (labels == ids[want]).all()
    assert np.allclose(d2, dist, atol=1e-12)
    assert (d2[50:60] == 0).all() and (labels[50:60] == ids[:10]).all()


def test_large_offsets_do_not_change_the_winner():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 4)) * 1e-4 + 1e4
    c = rng.normal(size=(20, 4)) * 1e-4 + 1e4
    assert (nearest.Finder(np.arange(20), c)(x)[0] == brute(x, c)[0]).all()


@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e12, 1e20])
def test_near_ties_beyond_single_precision(scale):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(1, 8))
    c = (base + rng.normal(size=(30, 8)) * 1e-9) * scale
    x = (base + rng.normal(size=(40, 8)) * 1e-9) * scale
    assert (nearest.Finder(np.arange(30), c)(x)[0] == brute(x, c)[0]).all()


def test_equal_centroids_are_sent_once(spark, cloud):
    made = blocks.vector_blocks(frame(spark, cloud, "cluster_id", "centroid"), "cluster_id", "centroid", distinct=True)
    ids, values = made[0].data.value
    assert len(ids) == 400 - 132 and 100 in ids and 101 not in ids


@pytest.mark.parametrize("partitions,max_bytes", [(1, 1 << 28), (16, 1 << 28), (4, 500)])
def test_assign_nearest(spark, cloud, partitions, max_bytes):
    points = frame(spark, cloud, partitions=partitions)
    centroids = frame(spark, cloud[:37], "cluster_id", "centroid")
    got = nearest.assign_nearest(points, centroids, max_bytes=max_bytes).orderBy("row_id").collect()
    want, dist = brute(cloud, cloud[:37])
    assert [r["cluster_id"] for r in got] == want.tolist()
    assert np.allclose([r["d2"] for r in got], dist, atol=1e-12)


def test_no_join_of_points_and_centroids_is_planned(spark, cloud):
    found = nearest.assign_nearest(frame(spark, cloud), frame(spark, cloud[:37], "cluster_id", "centroid"), max_bytes=500)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_blocks_stay_below_the_bound(spark, cloud):
    made = blocks.vector_blocks(frame(spark, cloud), "row_id", "embedding", 3000)
    assert sum(b.rows for b in made) == 400
    assert max(b.rows for b in made) <= blocks.rows_per_block(12, 3000)
    assert sorted(np.concatenate([b.data.value[0] for b in made]).tolist()) == list(range(400))


def test_null_vectors_are_left_out(spark, cloud):
    points = frame(spark, cloud).withColumn("embedding", F.when(F.col("row_id") != 3, F.col("embedding")))
    assert nearest.assign_nearest(points, frame(spark, cloud[:5], "cluster_id", "centroid")).count() == 399


@pytest.mark.parametrize("max_bytes", [15_000, 1 << 28])
def test_pair_distances(spark, cloud, max_bytes):
    d = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(2))
    d = d[d > 0]
    got = {r["distance"]: r["n_pairs"] for r in pairs.pairwise_distances(frame(spark, cloud), digits=2, max_bytes=max_bytes).collect()}
    value, n = np.unique(np.floor(d * 100 + 0.5) / 100, return_counts=True)
    assert got == dict(zip(value.tolist(), n.tolist()))
    probs = [0, 0.05, 0.5, 0.95, 0.99, 1]
    assert np.allclose(
        pairs.pair_percentiles(frame(spark, cloud), probs, max_bytes=max_bytes), np.percentile(d, [100 * p for p in probs]), atol=1e-9
    )


def lloyd(x, c, rounds):
    inertia = []
    for _ in range(rounds):
        label, d = brute(x, c)
        inertia.append(d.sum())
        c = np.vstack([x[label == k].mean(0) if (label == k).any() else c[k] for k in range(len(c))])
    return c, inertia


@pytest.mark.parametrize("partitions,max_bytes", [(1, 1 << 28), (16, 1 << 28), (4, 700)])
def test_kmeans_is_lloyd(spark, cloud, partitions, max_bytes):
    points = frame(spark, cloud, partitions=partitions)
    got = clustering.kmeans(points, 9, 2, init="first", max_points_per_centroid=None, max_bytes=max_bytes).orderBy("cluster_id").collect()
    want, inertia = lloyd(cloud, cloud[:9].copy(), 2)
    assert [r["cluster_id"] for r in got] == list(range(9))
    assert np.allclose([r["centroid"] for r in got], want, atol=1e-10)
    assert inertia == sorted(inertia, reverse=True)


def test_a_centre_without_points_stays(spark):
    x = np.array([[0.0, 0.0], [0.0, 0.0], [1.0, 0.0], [1.0, 1.0]])
    got = clustering.kmeans(frame(spark, x), 3, 2, init="first", max_points_per_centroid=None).orderBy("cluster_id").collect()
    assert [r["centroid"] for r in got] == [[0.0, 0.0], [0.0, 0.0], [1.0, 0.5]]


def test_more_clusters_than_points(spark, cloud):
    with pytest.raises(ValueError, match="401 clusters from 400 points"):
        clustering.kmeans(frame(spark, cloud), 401)


@pytest.mark.parametrize("max_bytes", [700, 1 << 28])
def test_minibatch_paths_agree(spark, cloud, max_bytes):
    points = written(frame(spark, cloud), "points")
    got = clustering.minibatch_kmeans(points, 9, 3, 150, max_bytes=max_bytes).orderBy("cluster_id").collect()
    want = clustering.minibatch_kmeans(points, 9, 3, 150).orderBy("cluster_id").collect()
    assert np.allclose([r["centroid"] for r in got], [r["centroid"] for r in want], atol=1e-10)


def test_vectors_of_different_length_are_rejected():
    import pyarrow as pa
    from tilesieve.operators.blocks import matrix

    with pytest.raises(ValueError, match="different lengths"):
        matrix(pa.array([[1.0] * 3, [1.0] * 5]))


def brute_merged(points, threshold):
    """Sub-clusters of (ids, x) by the definition, one pair after the other: {id: number}."""
    held = {}
    for i, v in points:
        twin = next((k for k, (_, _, c) in held.items() if np.array_equal(c, v)), None)
        if twin is None:
            held[i] = (1, 0.0, v)
        else:
            held[twin] = (held[twin][0] + 1, 0.0, v)
    while True:
        points = {}
        for i, (n, sse, c) in held.items():
            others = [(float(((c - o[2]) ** 2).sum()), j) for j, o in held.items() if j != i]
            if others:
                d2, j = min(others)
                m, other, _ = held[j]
                if (sse + other + n * m / (n + m) * d2) / (n + m) <= threshold**2:
                    points[i] = (d2, j)
        if not points:
            return {i: n for i, (n, _, _) in held.items()}
        roots = [i for i, (_, j) in points.items() if points.get(j, (0, None))[1] == i and (-held[i][0], i) < (-held[j][0], j)]
        points = {i: p for i, p in points.items() if i not in roots}
        for hub in {j for _, j in points.values()} - set(points):
            centre, members = held[hub][2], sorted((d2, i) for i, (d2, j) in points.items() if j == hub)
            n, about = held[hub][:2]
            taken = [hub]
            for d2, i in members:
                n, about = n + held[i][0], about + held[i][1] + held[i][0] * d2
                if about <= threshold**2 * n or len(taken) == 1:
                    taken.append(i)
                if about > threshold**2 * n:
                    break
            size = sum(held[i][0] for i in taken)
            mean = sum(held[i][2] * held[i][0] for i in taken) / size
            sse = sum(held[i][1] + held[i][0] * ((held[i][2] - mean) ** 2).sum() for i in taken)
            for i in taken:
                held.pop(i)
            held[hub] = (size, sse, mean)


@pytest.mark.parametrize("threshold", [0.05, 0.5, 0.9])
def test_merging_is_the_definition_whatever_the_bounds(spark, threshold):
    """Overlapping points with copies: the same sub-clusters in memory, in rounds, and by brute force."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(90, 3)) * 0.7
    x[60:] = x[rng.integers(0, 60, 30)] + (rng.random((30, 1)) < 0.5) * 0.01
    want = sorted(brute_merged(list(enumerate(x)), threshold).values())
    points = written(frame(spark, x), "overlapping")
    for rows in (4096, 40):
        found = thresholds.threshold_centroids(points.repartition(3), threshold, group_rows=rows).collect()
        assert sorted(r.n for r in found) == want, rows
        assert max(r.radius for r in found) <= threshold + 1e-9


def test_merging_by_stored_blocks_is_the_same(spark):
    x = np.random.default_rng(6).normal(size=(60, 3)) * 0.7
    points = written(frame(spark, x), "overlapping")
    stored = thresholds.threshold_centroids(points, 0.5, group_rows=40, max_bytes=20 * 32)
    assert sorted(r.n for r in stored.collect()) == sorted(brute_merged(list(enumerate(x)), 0.5).values())


def test_where_nothing_merges_there_is_one_round(spark, monkeypatch):
    points = written(frame(spark, np.eye(40)), "apart")
    rounds, real = [], thresholds._round
    monkeypatch.setattr(thresholds, "_round", lambda *a: rounds.append(1) or real(*a))
    assert thresholds.threshold_centroids(points, 1e-6, group_rows=10).count() == 40
    assert len(rounds) == 1


def test_stored_blocks_are_opened_only_where_their_ball_is_near(spark):
    rng = np.random.default_rng(1)
    centres = np.repeat(np.eye(8) * 100, 20, axis=0) + rng.normal(size=(160, 8))
    table = frame(spark, centres).selectExpr("row_id AS cluster_id", "embedding AS centroid")
    held = nearest.Centroids.of(table, 20 * (8 * 8 + 8))
    find = held.finder()
    x = centres[:20] + 0.1
    labels, d2 = find(x)
    want = ((x[:, None] - centres[None]) ** 2).sum(2)
    assert labels.tolist() == want.argmin(1).tolist() and np.allclose(d2, want.min(1))
    assert find.opened < len(held.files) and find.measured < len(x) * len(centres) / 2


def test_unknown_starts_are_rejected(spark, cloud):
    with pytest.raises(ValueError, match="init"):
        clustering.kmeans(frame(spark, cloud), 5, init="other")


def test_empty_cluster_has_a_zero_centroid(spark, cloud):
    points = frame(spark, cloud)
    assign = points.select("row_id", F.lit(1).alias("cluster_id"))
    got = clustering.cluster_centroids(points, assign, 3).orderBy("cluster_id").collect()
    assert [r["n"] for r in got] == [0, 400, 0]
    assert got[0]["centroid"] == [0.0] * 12 and np.allclose(got[1]["centroid"], cloud.mean(0))


@pytest.mark.parametrize("partitions,group_rows", [(1, 40), (16, 40), (4, 4096)])
def test_threshold_clusters_find_the_blobs(spark, sf_dir, group_rows, partitions):
    points = written(fx.blobs(spark, sf_dir).repartition(partitions), "blobs")
    found = thresholds.threshold_centroids(points, 0.3, group_rows=group_rows)
    assert found.count() == 10
    assert found.agg(F.sum("n")).first()[0] == points.count()
    assert found.agg(F.max("radius")).first()[0] <= 0.3
    labels = thresholds.threshold_clusters(points, 0.3, group_rows=group_rows)
    truth = fx.embeddings(spark, sf_dir).select(F.col("vec_id").alias("row_id"), "label")
    assert labels.join(truth, "row_id").select("cluster_id", "label").distinct().count() == 10


def test_threshold_extremes(spark, sf_dir):
    points = written(fx.points(spark, sf_dir), "points")
    for rows in (250, 4096):
        assert thresholds.threshold_centroids(points, 1.01, group_rows=rows).count() == 1
        assert thresholds.threshold_centroids(points, 1e-4, group_rows=rows).count() == points.count()


def test_copies_collapse_whatever_the_groups(spark, cloud):
    found = thresholds.threshold_centroids(written(frame(spark, cloud), "cloud"), 1e-4, group_rows=25)
    assert found.count() == 400 - 132
    assert found.agg(F.max("n")).first()[0] == 133


def test_several_rounds_keep_all_points(spark, cloud):
    found = thresholds.threshold_centroids(written(frame(spark, cloud), "cloud"), 1.0, group_rows=200)
    assert found.agg(F.sum("n")).first()[0] == 400
    assert found.agg(F.max("radius")).first()[0] <= 1.0 + 1e-9


def test_threshold_search_stops(spark, sf_dir):
    points = written(fx.blobs(spark, sf_dir), "blobs")
    log, _, labels = thresholds.threshold_search(points, 100, 0.3)
    found = log.orderBy("attempt").collect()
    assert [r["threshold"] for r in found] == [0.3 * 0.5**i for i in range(len(found))]
    assert found[-1]["n_clusters"] >= 100 and all(r["n_clusters"] < 100 for r in found[:-1])
    assert labels.count() == points.count()
    log, _, _ = thresholds.threshold_search(points, 10**6, 0.3, attempts=2)
    assert log.count() == 2
    log, _, _ = thresholds.threshold_search(points, 10**6, 0.3, min_threshold=0.2)
    assert [r["threshold"] for r in log.orderBy("attempt").collect()] == [0.3, 0.2]


def test_threshold_sweep_stops_at_one_cluster(spark, sf_dir):
    sweep = thresholds.threshold_sweep(fx.blobs(spark, sf_dir), [0.3, 1.2, 2.0]).collect()
    assert [(r["threshold"], r["n_clusters"]) for r in sweep] == [(0.3, 10), (1.2, 1)]


def test_pca_is_the_eigen_decomposition(spark, cloud):
    x = cloud * np.arange(1, 13)
    reduced, share = reduction.pca_fit_transform(frame(spark, x), 3)
    value, vector = np.linalg.eigh(np.cov(x.T))
    value, vector = value[::-1], vector[:, ::-1][:, :3]
    vector = vector * np.sign(vector[np.abs(vector).argmax(0), range(3)])
    want = (x - x.mean(0)) @ vector
    got = np.array([r["embedding"] for r in reduced.orderBy("row_id").collect()])
    assert np.allclose(got, want, atol=1e-8)
    assert np.isclose(share, value[:3].sum() / value.sum())
    curve = reduction.pca_cumulative_variance(frame(spark, x)).orderBy("component").collect()
    assert np.allclose([r["cumulative"] for r in curve], np.cumsum(value) / value.sum())
    marks = reduction.variance_marks(reduction.pca_cumulative_variance(frame(spark, x)), at=5).first()
    assert np.isclose(marks["cumulative_5"], value[:5].sum() / value.sum())
    assert marks["reach_90"] == int(np.argmax(np.cumsum(value) / value.sum() >= 0.9)) + 1


@pytest.mark.parametrize("max_bytes", [1, 2_000, 1 << 28])
def test_partial_sums_in_bounded_memory(cloud, max_bytes):
    labels = np.arange(400) % 37
    sums = clustering._Sums(max_bytes)
    out = []
    for lo in range(0, 400, 60):
        out += list(sums.add(labels[lo : lo + 60], cloud[lo : lo + 60]))
    out += list(sums.drain())
    n, total = np.zeros(37), np.zeros((37, 12))
    for batch in out:
        ids, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        n[ids] += size
        total[ids] += blocks.matrix(batch.column(2)) * size[:, None]
    assert (n == np.bincount(labels)).all()
    assert np.allclose(total, [cloud[labels == k].sum(0) for k in range(37)])
    assert max_bytes > 2_000 or len(out) > 1


@pytest.mark.parametrize("max_bytes", [1 << 28, 200])
def test_distances_to_the_own_centroid(spark, max_bytes, capsys):
    rng = np.random.default_rng(5)
    x, c = rng.normal(size=(60, 3)), rng.normal(size=(9, 3))
    label = [0 if i % 3 else int(rng.integers(0, 9)) for i in range(60)]  # two thirds in one cluster
    rows = [(i, x[i].tolist(), label[i]) for i in range(60)] + [(60, None, 1), (61, [1.0, 2.0, 3.0], None), (62, [1.0, 2.0, 3.0], 77)]
    points = spark.createDataFrame(rows, "row_id bigint, embedding array<double>, cluster_id int")
    centroids = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cluster_id int, centroid array<double>")
    found = nearest.distance_to_own(points, centroids, max_bytes=max_bytes)
    found.explain()
    assert "Exchange" not in capsys.readouterr().out
    got = {r["row_id"]: (r["cluster_id"], r["d2"]) for r in found.collect()}
    assert sorted(got) == list(range(60))
    for i in range(60):
        assert got[i][0] == label[i] and np.isclose(got[i][1], ((x[i] - c[label[i]]) ** 2).sum())


def test_many_blocks_take_one_scan_and_no_shuffle_of_points(spark, cloud, tmp_path):
    frame(spark, cloud, partitions=4).write.parquet(str(tmp_path / "points"))
    points = spark.read.parquet(str(tmp_path / "points"))
    table = frame(spark, cloud[:28], "cluster_id", "centroid")
    held = nearest.Centroids.of(table, 220)
    assert held.data is None and len(held.files) >= 14
    found = nearest.assign_nearest(points, table, max_bytes=220)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert [r["cluster_id"] for r in found.orderBy("row_id").collect()] == brute(cloud, cloud[:28])[0].tolist()


def test_chunks_are_put_together_from_batches():
    batches = [pa.RecordBatch.from_arrays([pa.array(list(range(n)), pa.int64())], names=["a"]) for n in (3, 0, 4, 5, 1)]
    got = [b.column(0).to_pylist() for b in blocks.in_chunks(iter(batches), 48)]
    assert got == [[0, 1, 2, 0, 1, 2, 3], [0, 1, 2, 3, 4, 0]]


def test_percentiles_are_found_bit_by_bit(spark, monkeypatch):
    monkeypatch.setattr(pairs, "KEPT", 1)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(60, 3)) * 10.0 ** rng.integers(-9, 3, size=(60, 1))
    x[50:] = x[0]  # equal points have no distance, but many equal ones to others
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    d = d[d > 0]
    probs = [0, 0.01, 0.25, 0.5, 0.9, 0.999, 1]
    assert np.allclose(pairs.pair_percentiles(frame(spark, x), probs), np.percentile(d, [100 * p for p in probs]), rtol=1e-6)
    assert np.isnan(pairs.pair_percentiles(frame(spark, x).filter("row_id < 0"), probs)).all()
    assert np.isnan(pairs.pair_percentiles(frame(spark, x).filter("row_id >= 50"), probs)).all()


def test_pairs_are_measured_once_and_no_vector_comes_to_the_driver(spark, cloud, monkeypatch):
    """Several files, repeated keys and a key that is null; vectors are neither collected nor broadcast."""

    def fail(*_):
        raise AssertionError("vectors in the driver")

    monkeypatch.setattr(blocks, "loaded", fail)
    monkeypatch.setattr(blocks.Block, "of", fail)
    monkeypatch.setattr(pairs, "LEAST", 30)
    ids = [None if i == 7 else i % 390 for i in range(400)]
    rows = [(i, v.tolist()) for i, v in zip(ids, cloud)]
    points = spark.createDataFrame(rows, "row_id bigint, embedding array<double>")
    assert len(pairs._files(points, "row_id", "embedding", 1 << 28)) > 3
    d = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(2))
    d = [d[i, j] for i in range(400) for j in range(400) if None not in (ids[i], ids[j]) and ids[i] != ids[j] and d[i, j] > 0]
    got = {r["distance"]: r["n_pairs"] for r in pairs.pairwise_distances(points, digits=2).collect()}
    value, n = np.unique(np.floor(np.array(d) * 100 + 0.5) / 100, return_counts=True)
    assert got == dict(zip(value.tolist(), n.tolist()))
    probs = [0, 0.05, 0.5, 0.95, 1]
    assert np.allclose(pairs.pair_percentiles(points, probs), np.percentile(d, [100 * p for p in probs]), atol=1e-9)


@pytest.mark.parametrize("dense,held", [(1 << 22, 1 << 20), (50, 10)])
def test_counts_of_numbers_near_and_far(monkeypatch, dense, held):
    monkeypatch.setattr(pairs, "DENSE", dense)
    monkeypatch.setattr(pairs, "HELD", held)
    rng = np.random.default_rng(3)
    parts = [rng.integers(base, base + width, 40) for base, width in ((5, 9), (0, 30), (100, 20), (10, 400), (60, 3), (-20, 4))]
    value, n = np.unique(np.concatenate(parts), return_counts=True)
    for count in (pairs._counted, pairs._listed):
        got = {}
        for some, many in count(iter([p.copy() for p in parts])):
            for v, m in zip(some.tolist(), many.tolist()):
                got[v] = got.get(v, 0) + m
        assert got == dict(zip(value.tolist(), n.tolist()))


def test_sub_clusters_beyond_a_bound_do_not_come_to_the_driver(spark, monkeypatch):
    """However much may be broadcast: the driver gathers no more centroids than its own bound, with the same result."""
    x = np.random.default_rng(6).normal(size=(60, 3)) * 0.7
    points = written(frame(spark, x), "overlapping")
    gathered, real = [], nearest.loaded
    monkeypatch.setattr(nearest, "GATHERED_BYTES", 20 * 32)
    monkeypatch.setattr(nearest, "loaded", lambda *a: gathered.append(a[0].count()) or real(*a))
    labels = thresholds.threshold_clusters(points, 0.5, group_rows=40)
    sizes = sorted(r["count"] for r in labels.groupBy("cluster_id").count().collect())
    assert gathered and max(gathered) <= 20
    assert sum(sizes) == 60 and len(sizes) == len(brute_merged(list(enumerate(x)), 0.5))


@pytest.mark.parametrize("few,in_task", [(0, 1 << 20), (0, 0), (256, 1 << 20)])
def test_rounds_over_files_are_the_definition(spark, monkeypatch, few, in_task):
    """Files of few rows, nearest ones kept over rounds, stars in a task or in joins, and rounds followed in the driver."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 3)) * 0.8
    x[100:] = x[rng.integers(0, 20, 50)] + rng.normal(size=(50, 3)) * 0.01
    points = written(frame(spark, x), "overlapping")
    followed, real = [], thresholds._followed
    monkeypatch.setattr(neighbours, "LEAST", 9)
    monkeypatch.setattr(thresholds, "FEW_PAIRS", few)
    monkeypatch.setattr(thresholds, "PAIRS_IN_TASK", in_task)
    monkeypatch.setattr(thresholds, "_followed", lambda *a: followed.append(real(*a)) or followed[-1])
    start = thresholds.Start(thresholds.distinct_points(points))
    assert len(start.held().files) >= 10
    for threshold in (0.05, 0.2):
        want = sorted(brute_merged(list(enumerate(x)), threshold).values())
        found = thresholds.threshold_centroids(points, threshold, group_rows=5, start=start).collect()
        assert sorted(r.n for r in found) == want
    assert any(f[0] for f in followed) if few else not followed


def test_one_member_a_round_takes_few_searches(spark, monkeypatch):
    """A large sub-cluster takes in one point after the other; the rounds do not search all rows each time."""
    rng = np.random.default_rng(9)
    far = rng.normal(size=(900, 16))
    far /= np.linalg.norm(far, axis=1)[:, None] / rng.uniform(1, 1.2, 900)[:, None]
    x = np.vstack([rng.normal(size=(400, 16)) * 1e-3, far])
    points = written(frame(spark, x), "heavy")
    held = thresholds.merge_all(np.arange(1300), np.ones(1300), np.zeros(1300), x.copy(), 0.25)
    rounds, searched, real, look = [], [], thresholds._followed, thresholds.with_nearest
    monkeypatch.setattr(thresholds, "_followed", lambda *a: rounds.append(real(*a)) or rounds[-1])
    monkeypatch.setattr(thresholds, "with_nearest", lambda *a, **k: searched.append(1) or look(*a, **k))
    found = thresholds.threshold_centroids(points, 0.25, group_rows=10).collect()
    assert sorted(r.n for r in found) == sorted(held[1].astype(int).tolist())
    assert sum(r[0] for r in rounds) >= 15 and len(searched) <= 10


def test_no_more_rows_are_gathered_than_the_bound(spark, monkeypatch):
    """Equal distances, and a row that is the nearest one of nearly all: the driver still gathers few."""
    rng = np.random.default_rng(10)
    sphere = rng.normal(size=(500, 12))
    sphere /= np.linalg.norm(sphere, axis=1)[:, None]
    lattice = np.stack(np.meshgrid(*[np.arange(8.0)] * 3), -1).reshape(-1, 3)
    for x, threshold in ((np.vstack([np.zeros((1, 12)), sphere * 0.5, [[0.01] * 12]]), 0.06), (np.vstack([lattice, lattice[:1] + 0.01]), 0.4)):
        points = written(frame(spark, x), "ties")
        gathered, real = [], neighbours.Rows.of.__func__
        monkeypatch.setattr(neighbours, "LEAST", 20)
        monkeypatch.setattr(thresholds, "FOLLOWED_BYTES", 64 * (8 * x.shape[1] + 48))
        monkeypatch.setattr(neighbours.Rows, "of", classmethod(lambda cls, table: gathered.append(table.num_rows) or real(cls, table)))
        found = thresholds.threshold_centroids(points, threshold, group_rows=5).collect()
        assert sorted(r.n for r in found) == sorted(brute_merged(list(enumerate(x)), threshold).values())
        assert gathered and max(gathered) <= 100
        monkeypatch.undo()


def test_all_thresholds_share_one_search(spark, monkeypatch):
    points = written(frame(spark, np.eye(40)), "apart")
    searched, look = [], thresholds.with_nearest
    monkeypatch.setattr(thresholds, "with_nearest", lambda *a, **k: searched.append(1) or look(*a, **k))
    sweep = thresholds.threshold_sweep(points, [1e-6, 1e-3, 0.1], group_rows=10).collect()
    assert [r.n_clusters for r in sweep] == [40, 40, 40] and len(searched) == 1
    log = thresholds.threshold_search(points, 50, 0.1, attempts=3, group_rows=10)[0].collect()
    assert [r.n_clusters for r in log] == [40, 40, 40] and len(searched) == 2


def test_different_points_of_one_key_stay_apart_in_files(spark):
    """Keys that repeat, or are null, on different points: each is a sub-cluster of its own."""
    rows = [(None if i == 3 else i // 2, v.tolist()) for i, v in enumerate(np.eye(20))]
    points = written(spark.createDataFrame(rows, "row_id bigint, embedding array<double>"), "keys")
    assert thresholds.threshold_centroids(points, 0.5, group_rows=5).count() == 20
    assert thresholds.threshold_centroids(points, 0.75, group_rows=5).agg(F.sum("n")).first()[0] == 20


def test_marked_cells_are_found_as_nonzero_finds_them():
    rng = np.random.default_rng(4)
    for shape in ((1, 1), (3, 5), (7, 8), (40, 33), (0, 4)):
        marks = rng.random(shape) < 0.1
        assert [p.tolist() for p in nearest._places(marks)] == [p.tolist() for p in np.nonzero(marks)]
