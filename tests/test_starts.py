"""Starting centres, refilled and reassigned centres."""

import numpy as np
import pytest

from tilesieve.operators import clustering
from tilesieve.operators.starts import oversampled_start
from tilesieve.session import written


def frame(spark, x, partitions=4):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "row_id bigint, embedding array<double>").repartition(partitions)


def values(found):
    ordered = found.orderBy("cluster_id").collect()
    assert [r["cluster_id"] for r in ordered] == list(range(len(ordered)))
    return np.array([r["centroid"] for r in ordered])


def inertia(x, c):
    return ((x[:, None] - c[None]) ** 2).sum(2).min(1).sum()


@pytest.fixture(scope="module")
def islands():
    """Twelve groups far from each other; one holds a third of all rows."""
    rng = np.random.default_rng(5)
    size = [200] + [30] * 11
    middle = rng.normal(size=(12, 6)) * 100
    return np.vstack([middle[i] + rng.normal(size=(n, 6)) for i, n in enumerate(size)]), np.repeat(np.arange(12), size)


def test_a_start_finds_every_island(spark, islands):
    x, island = islands
    points = frame(spark, x)
    start = values(oversampled_start(points, 12))
    at = ((x[:, None] - start[None]) ** 2).sum(2).argmin(0)
    assert np.allclose(x[at], start) and len(set(island[at])) == 12
    sampled = values(clustering.initial_centroids(points, 12, "sample", 42, "row_id", "embedding"))
    assert inertia(x, start) < inertia(x, sampled)
    # Fixed by the keys alone: neither partitions nor the form in which centres are sent matter.
    assert np.array_equal(start, values(oversampled_start(frame(spark, x, 1), 12, max_bytes=700)))


def test_a_start_with_more_centres_than_rounds(spark, islands):
    x, _ = islands
    start = values(oversampled_start(frame(spark, x), 40))
    assert len(start) == 40 and len(np.unique(start, axis=0)) == 40
    sampled = values(clustering.initial_centroids(frame(spark, x), 40, "sample", 42, "row_id", "embedding"))
    assert inertia(x, start) < inertia(x, sampled)


def test_a_start_with_too_few_different_points(spark):
    x = np.repeat([[0.0, 0.0], [5.0, 0.0], [0.0, 9.0]], 20, axis=0)
    start = values(oversampled_start(frame(spark, x), 6))
    assert len(start) == 6 and {tuple(v) for v in start[:3]} == {(0.0, 0.0), (5.0, 0.0), (0.0, 9.0)}
    assert (values(oversampled_start(frame(spark, np.zeros((4, 2))), 4)) == 0).all()


@pytest.mark.parametrize("max_bytes", [300, 1 << 28])
def test_refilled_centres_have_members(spark, max_bytes):
    """The first rows are equal, so without refilling centres share a place and get no point."""
    x = np.vstack([np.zeros((30, 3)), np.eye(3) * 4, -np.eye(3) * 7])
    points = frame(spark, x)
    label = lambda c: set(((x[:, None] - c[None]) ** 2).sum(2).argmin(1).tolist())
    plain = values(clustering.kmeans(points, 5, 6, init="first", max_bytes=max_bytes))
    full = values(clustering.kmeans(points, 5, 6, init="first", refill=True, max_bytes=max_bytes))
    assert len(label(plain)) < 5 and len(label(full)) == 5
    assert inertia(x, full) < inertia(x, plain)


def test_refilling_leaves_full_clusters_alone(spark, islands):
    x, _ = islands
    points = written(frame(spark, x), "points")
    how = {"k": 3, "niter": 2, "init": "first"}
    assert np.allclose(values(clustering.kmeans(points, **how)), values(clustering.kmeans(points, refill=True, **how)), atol=1e-9)


@pytest.mark.parametrize("max_bytes", [300, 1 << 28])
def test_light_centres_are_reassigned(spark, islands, max_bytes):
    x, _ = islands
    # All centres start in one island, but one that no point is near to.
    y = np.vstack([np.full((1, 6), 1e4), x])
    points = written(frame(spark, y), "points")
    kept = values(clustering.minibatch_kmeans(points, 4, 3, init="first", batches=1, max_bytes=max_bytes))
    moved = values(clustering.minibatch_kmeans(points, 4, 3, init="first", batches=1, reassignment=0.05, max_bytes=max_bytes))
    assert (np.abs(kept - 1e4) < 1).all(1).any() and inertia(x, moved) < inertia(x, kept)


def test_reassigned_forms_agree(spark, islands):
    points = written(frame(spark, islands[0]), "points")
    how = {"init": "first", "batches": 2, "reassignment": 0.2}
    assert np.allclose(
        values(clustering.minibatch_kmeans(points, 6, 2, max_bytes=300, **how)), values(clustering.minibatch_kmeans(points, 6, 2, **how)), atol=1e-9
    )
