"""Nearest centroid per point: one map over the points with the centroids in bounded blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..functions.vectors import dot, l2_normalize, l2_normalize_eps, literal_vector
from ..session import MAX_BROADCAST_BYTES
from .blocks import CHUNK_BYTES, Block, in_chunks, loaded, matrix, rows_per_block, sized, stored_block, stored_blocks

# Cells of the distance matrix a task looks at together, and the least number of points for it;
# also the numbers in one slice of the exact recheck.
CELLS = 1_000_000
LEAST_ROWS = 512
# Most balls that stored centroids are grouped in.
MOST_BALLS = 1_024
# Centroids beyond this size do not come to the driver; tasks read them from files of at most that size.
GATHERED_BYTES = 8 * 1024 * 1024


def _places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero of a matrix with few marks: eight cells are looked at together."""
    flat = marks.reshape(-1)
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    inside = (words[:, None] * 8 + np.arange(8)).reshape(-1)
    at = np.concatenate([inside[flat[inside]], whole + np.flatnonzero(flat[whole:])])
    return np.divmod(at, marks.shape[1])


class Finder:
    """Nearest row of one matrix, exact, with the bulk of the work in a single-precision product.

    ``c`` is moved to its mean, which leaves all differences as they are and keeps the product
    accurate.  [x, 1] @ [-2c, |c|^2] ranks the candidates; all of them within the worst-case
    rounding error of the best are then measured directly in double precision, so ties and
    near-ties go to the lowest id exactly as a direct comparison would have it.
    """

    def __init__(self, ids: np.ndarray, c: np.ndarray) -> None:
        self.ids, self.c, self.shift = ids, c, c.mean(axis=0)
        centred = c - self.shift
        c2 = np.einsum("ij,ij->i", centred, centred)
        self.reach = float(np.sqrt(c2.max()))
        self.kind = np.float32 if self.reach < 1e15 else np.float64
        self.table = np.vstack([-2.0 * centred.T, c2]).astype(self.kind)

    def _candidates(self, part: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        moved = part - self.shift
        length = np.sqrt(np.einsum("ij,ij->i", moved, moved))
        kind = self.kind if length.max() < 1e15 else np.float64
        rows = np.hstack([moved, np.ones((len(moved), 1))]).astype(kind)
        approx = rows @ self.table
        if own is not None:
            at = np.minimum(np.searchsorted(self.ids, own), len(self.ids) - 1)
            here = np.flatnonzero(self.ids[at] == own)
            approx[here, at[here]] = np.inf
        error = (part.shape[1] + 4) * np.finfo(self.kind).eps * (2.0 * length + self.reach) * self.reach
        least = approx.min(axis=1)
        most = np.where(least < np.inf, least + 2.0 * error, -np.inf)
        if approx.dtype == np.float32:
            # The next number above, so that a bound in single precision leaves nothing out.
            most = np.nextafter(most.astype(np.float32), np.float32(np.inf))
        return _places(approx <= most[:, None])

    def __call__(self, x: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Id and squared distance of the nearest row for every row of ``x``; -1 and inf where there is none.

        ``own`` are ids that the rows of ``x`` must not be given themselves; ``ids`` are in order then.
        """
        labels, best = np.full(len(x), -1, dtype=np.int64), np.full(len(x), np.inf)
        step, stride = max(LEAST_ROWS, CELLS // len(self.c)), max(1, CELLS // self.c.shape[1])
        for lo in range(0, len(x), step):
            part = x[lo : lo + step]
            row, col = self._candidates(part, None if own is None else own[lo : lo + step])
            exact = np.empty(len(row))
            for s in range(0, len(row), stride):
                diff = part[row[s : s + stride]] - self.c[col[s : s + stride]]
                exact[s : s + stride] = np.einsum("ij,ij->i", diff, diff)
            order = np.lexsort((self.ids[col], exact, row))
            found, first = np.unique(row[order], return_index=True)
            labels[lo + found] = self.ids[col[order[first]]]
            best[lo + found] = exact[order[first]]
        return labels, best


class StoredFinder:
    """As ``Finder`` over stored blocks: one is read at a time, and the nearest so far is kept.

    A block holds centroids that lie together, within ``radius`` of a centre.  By the triangle
    inequality none of them is nearer to a point than its distance to the centre less the radius, so
    a block measures only the points that this bound leaves open, and is not opened where there are none.
    """

    def __init__(self, files: list[str], centres: np.ndarray, radii: np.ndarray) -> None:
        self.files, self.centres, self.radii = files, centres, radii
        self.opened, self.measured = 0, 0

    def _bounds(self, x: np.ndarray) -> np.ndarray:
        """For each point and block a squared distance below which none of its centroids lies."""
        away = np.empty((len(x), len(self.files)))
        for b, centre in enumerate(self.centres):
            diff = x - centre
            away[:, b] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        # Less than rounding can add to either side.
        safe = away - self.radii - 1e-12 * x.shape[1] * (away + self.radii)
        return np.square(np.maximum(safe, 0.0))

    def __call__(self, x: np.ndarray, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        labels, best = np.full(len(x), -1, dtype=np.int64), np.full(len(x), np.inf)
        bounds = self._bounds(x)
        # Blocks that are nearest to many points come first.
        nearest = np.bincount(bounds.argmin(axis=1), minlength=len(self.files)) if len(x) else np.zeros(len(self.files))
        for b in np.argsort(-nearest, kind="stable").tolist():
            some = np.flatnonzero(bounds[:, b] <= best)
            if not len(some):
                continue
            ids, c = stored_block(self.files[b])
            self.opened, self.measured = self.opened + 1, self.measured + len(some) * len(ids)
            if len(ids):
                found, d2 = Finder(ids, c)(x[some], None if own is None else own[some])
                was, had = labels[some], best[some]
                nearer = (found >= 0) & ((was < 0) | (d2 < had) | ((d2 == had) & (found < was)))
                labels[some[nearer]], best[some[nearer]] = found[nearer], d2[nearer]
        return labels, best


@dataclass(frozen=True)
class Centroids:
    """What tasks measure points with: one broadcast block, or the files of a table beyond its bound.

    The points are read once either way, and neither they nor pairs are shuffled.
    """

    data: Broadcast | None
    files: list[str]
    # Centre and radius of each file's centroids, a row of the first and a number.
    balls: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, table: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, distinct: bool = True) -> Centroids:
        n, dims = sized(table, "centroid")
        if n == 0:
            raise ValueError("there are no centroids to measure to")
        max_bytes = min(max_bytes, GATHERED_BYTES)
        if n <= rows_per_block(dims, max_bytes):
            return cls(Block.of(table.sparkSession, *loaded(table, "cluster_id", "centroid"), distinct).data, [])
        return cls(None, *ball_blocks(table, max_bytes, distinct))

    def finder(self) -> Finder | StoredFinder:
        return StoredFinder(self.files, *self.balls) if self.data is None else Finder(*self.data.value)

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches without empty ones; big enough to be worth reading all files."""
        return in_chunks(batches, CHUNK_BYTES if self.data is None else 0)

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, matrix) of each block, one at a time."""
        if self.data is not None:
            yield self.data.value
        for file in self.files:
            yield stored_block(file)

    def release(self) -> None:
        """The executors forget a broadcast block."""
        if self.data is not None:
            self.data.destroy()


def ball_blocks(table: DataFrame, max_bytes: int, distinct: bool) -> tuple[list[str], tuple[np.ndarray, np.ndarray]]:
    """Files of centroids that lie together, with the centre and radius of each.

    Centroids go to the nearest of as many sampled ones as there will be blocks; a block beyond
    ``max_bytes`` becomes several files.  The driver sees the samples and the centres only.
    """
    n, dims = sized(table, "centroid")
    wanted = min(MOST_BALLS, -(-n // rows_per_block(dims, max_bytes)))
    # At most MOST_BALLS rows.
    ids, chosen = loaded(table.orderBy(F.xxhash64("cluster_id"), "cluster_id").limit(wanted), "cluster_id", "centroid")
    shared = table.sparkSession.sparkContext.broadcast((np.sort(ids), chosen[np.argsort(ids)]))
    near = _assign_to(table.withColumnRenamed("cluster_id", "_id"), Centroids(shared, []), "_id", "centroid", carry=True)
    files = stored_blocks(near, "_id", "centroid", max_bytes, distinct, by="cluster_id")

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                held = stored_block(file)[1]
                centre = held.mean(axis=0) if len(held) else np.zeros(dims)
                diff = held - centre
                radius = float(np.sqrt(np.einsum("ij,ij->i", diff, diff).max())) if len(held) else 0.0
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius])], names=["file", "centre", "radius"])

    spark = table.sparkSession
    names = spark.createDataFrame([(f,) for f in files], "file string").repartition(min(len(files), spark.sparkContext.defaultParallelism), "file")
    balls = {r.file: r for r in names.mapInArrow(run, "file string, centre array<double>, radius double").collect()}
    shared.destroy()
    return files, (np.array([balls[f].centre for f in files]), np.array([balls[f].radius for f in files]))


def _assign_to(points: DataFrame, centroids: Centroids, key: str, vec: str, carry: bool = False) -> DataFrame:
    held = [key, vec] if carry else [key]

    def run(batches):
        find = centroids.finder()
        for batch in centroids.chunks(batches):
            labels, d2 = find(matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(held)], pa.array(labels.astype(np.int32)), pa.array(d2)],
                names=[*held, "cluster_id", "d2"],
            )

    source = points.filter(F.col(vec).isNotNull()).select(key, vec)
    kinds = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in held]
    return source.mapInArrow(run, ", ".join([*kinds, "cluster_id int", "d2 double"]))


def assign_nearest(
    points: DataFrame,
    centroids: DataFrame,
    key: str = "row_id",
    vec: str = "embedding",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(key, cluster_id, d2): the centroid with the least squared L2 distance, ties to the lowest id."""
    return _assign_to(points, Centroids.of(centroids, max_bytes), key, vec)


def assign_carrying(points: DataFrame, centroids: DataFrame, key: str = "row_id", vec: str = "embedding") -> DataFrame:
    """As assign_nearest, with the vector kept in the row."""
    return _assign_to(points, Centroids.of(centroids), key, vec, carry=True)


def distance_to_own(
    labelled: DataFrame, centroids: DataFrame, key: str = "row_id", vec: str = "embedding", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """(key, cluster_id, d2): the squared distance of every labelled point to the centroid of its cluster.

    Vectors are not shuffled by cluster, so a hot one is no single task's work; every block of
    centroids measures the points of its own clusters.  Points of an unknown cluster are left out.
    """
    held = Centroids.of(centroids, max_bytes, distinct=False)
    labelled = labelled.filter(F.col(vec).isNotNull() & F.col("cluster_id").isNotNull()).select(key, vec, "cluster_id")

    def run(batches):
        for batch in held.chunks(batches):
            label, x = batch.column(2).to_numpy(), matrix(batch.column(1))
            known, d2 = np.zeros(len(x), bool), np.zeros(len(x))
            for ids, c in held.blocks():
                if len(ids):
                    at = np.minimum(np.searchsorted(ids, label), len(ids) - 1)
                    own = np.flatnonzero(ids[at] == label)
                    diff = x[own] - c[at[own]]
                    known[own], d2[own] = True, np.einsum("ij,ij->i", diff, diff)
            there = pa.array(np.flatnonzero(known))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(there), pa.array(label[known], pa.int32()), pa.array(d2[known])],
                names=[key, "cluster_id", "d2"],
            )

    kind = labelled.schema[key].dataType.simpleString()
    return labelled.mapInArrow(run, f"`{key}` {kind}, cluster_id int, d2 double")


def assign_nearest_normalized(points: DataFrame, centroids: DataFrame, **options) -> DataFrame:
    """As assign_nearest, with unit-length centroids; labels may differ from the raw form."""
    unit = centroids.select("cluster_id", l2_normalize(F.col("centroid")).alias("centroid"))
    return assign_nearest(points, unit, **options)


def similarity_to_reference(
    centroids: DataFrame, reference: list[float], normalize: str = "none"
) -> DataFrame:
    """(cluster_id, similarity) with one reference vector, which travels as a literal.

    ``none`` takes the raw centroid against the unit reference; ``both`` scales either side to
    x / (|x| + 1e-8) first.
    """
    ref, raw = literal_vector(reference), F.col("centroid").cast("array<double>")
    if normalize == "none":
        left, right = raw, l2_normalize(ref)
    elif normalize == "both":
        left, right = l2_normalize_eps(raw), l2_normalize_eps(ref)
    else:
        raise ValueError(f"normalize must be 'none' or 'both', not {normalize!r}")
    return centroids.select("cluster_id", dot(left, right).alias("similarity"))
