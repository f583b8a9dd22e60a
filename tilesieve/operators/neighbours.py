"""Vectors in files that lie together, each with its nearest other one, kept over rounds of merging.

A row is a sub-cluster: id, number of points, sum of squares, centroid, and its nearest other row
(ties to the lowest id) with the squared distance.  A file holds rows of one ball; a row is measured
only with files whose ball may hold something as near as what it has.  What a round changes is marked:
``near`` is null where it has to be looked for again, ``fresh`` rows have a new centroid, and all
other rows are measured with the fresh ones only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import MAX_BROADCAST_BYTES, scratch_path
from .blocks import list_array, loaded, matrix, rows_per_block, sized
from .nearest import MOST_BALLS, Finder

# Vectors of a file, at most; the least rows that a file is made for.
FILE_BYTES = 2 * 1024 * 1024
LEAST = 1_024

_KINDS = {"cluster_id": "bigint", "n": "bigint", "sse": "double", "centroid": "array<double>", "near": "bigint", "d2": "double"}
SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _KINDS.items())


class Rows(NamedTuple):
    """Sub-clusters in memory, in order of their ids; ``near`` is -1 where it is not known."""

    ids: np.ndarray
    n: np.ndarray
    sse: np.ndarray
    c: np.ndarray
    near: np.ndarray
    d2: np.ndarray

    def take(self, at: np.ndarray) -> Rows:
        return Rows(*(column[at] for column in self))

    def batch(self) -> pa.RecordBatch:
        near = pa.array(self.near, mask=self.near < 0)
        columns = [pa.array(self.ids), pa.array(self.n), pa.array(self.sse), list_array(self.c), near, pa.array(self.d2)]
        return pa.RecordBatch.from_arrays(columns, names=list(_KINDS))

    @classmethod
    def of(cls, table: pa.Table) -> Rows:
        ids = table["cluster_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        near, d2 = table["near"].fill_null(-1).to_numpy(), table["d2"].fill_null(np.inf).to_numpy()
        return cls(ids, table["n"].to_numpy(), table["sse"].to_numpy(), matrix(table["centroid"]), near, d2).take(order)

    @classmethod
    def joined(cls, parts: list[Rows]) -> Rows:
        """Rows of several parts, each id once."""
        parts = [p for p in parts if len(p.ids)] or parts[:1]
        held = cls(*(np.concatenate(column) for column in zip(*parts)))
        return held.take(np.unique(held.ids, return_index=True)[1])

    @property
    def nbytes(self) -> int:
        return sum(column.nbytes for column in self)


def none(dims: int) -> Rows:
    whole, real = np.empty(0, np.int64), np.empty(0)
    return Rows(whole, whole, real, np.empty((0, dims)), whole, real)


def _table(path: str, columns: list[str] | None = None) -> pa.Table:
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    where, name = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return pq.read_table(name, filesystem=where, partitioning=None, columns=columns)


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are among those in order."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def lengths(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """The squared distance of every row to one point, from differences."""
    diff = x - point
    return np.einsum("ij,ij->i", diff, diff)


def squares(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances of all rows to all points by a product, and how far each may be off."""
    shift = points.mean(axis=0)
    x, points = x - shift, points - shift
    x2, p2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", points, points)
    error = 4.0 * (x.shape[1] + 8) * np.finfo(float).eps * float(np.sqrt(x2.max()) + np.sqrt(p2.max())) ** 2
    return np.maximum(x2[:, None] + p2 - 2.0 * (x @ points.T), 0.0), error


def beyond(x: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each row and ball a distance below which nothing in the ball lies from the row."""
    away = np.empty((len(x), len(centres)))
    for b, centre in enumerate(centres):
        away[:, b] = np.sqrt(lengths(x, centre))
    # Less than rounding can add to either side.
    return np.maximum(away - radii - 1e-12 * max(1, x.shape[1]) * (away + radii), 0.0)


@dataclass(frozen=True)
class Stored:
    """The files of a table of sub-clusters with all nearest ones known, and what changed since they were written.

    ``gone`` are ids of rows in the files that no longer hold, ``extra`` the rows that came in their place.
    """

    spark: SparkSession
    path: str
    files: list[str]
    centres: np.ndarray
    radii: np.ndarray
    rows: int
    gone: np.ndarray
    extra: Rows

    def frame(self) -> DataFrame:
        """All rows as a table."""
        table = self.spark.read.schema(SCHEMA).parquet(self.path)
        if not len(self.gone):
            return table
        # As many ids as were changed since the files were written, at most the bound of what is held beside them.
        gone = self.spark.createDataFrame(pa.table({"cluster_id": pa.array(self.gone)}))
        table = table.join(F.broadcast(gone), "cluster_id", "left_anti")
        if not len(self.extra.ids):
            return table
        return table.unionByName(self.spark.createDataFrame(pa.Table.from_batches([self.extra.batch()]), SCHEMA))

    def changed(self, gone: np.ndarray, rows: Rows, fewer: int) -> Stored:
        """With other rows in place of ``gone``; the files stay as they are."""
        extra = self.extra.take(~is_in(self.extra.ids, gone))
        return replace(self, rows=self.rows - fewer, gone=np.union1d(self.gone, gone), extra=Rows.joined([rows, extra]))

    def scan(self, job: Callable[[Rows], Iterator[pa.RecordBatch]], schema: str, near_to: np.ndarray | None = None, reach: np.ndarray | None = None) -> pa.Table:
        """What the job finds in each file and in the rows beside the files, gathered; the job keeps it small.

        Only files that may hold rows within ``reach`` of one of the points are read, where these are given.
        """
        which = np.arange(len(self.files) + 1)
        if near_to is not None:
            open_to = (beyond(near_to, self.centres, self.radii) <= reach[:, None]).any(axis=0)
            which = np.append(np.flatnonzero(open_to), len(self.files))
        sc = self.spark.sparkContext
        # Plain arrays: a broadcast is pickled by reference, and executors have no copy of this package.
        shared = sc.broadcast(([self.files[i] for i in which[:-1]], self.gone, tuple(self.extra)))

        def run(batches):
            files, gone, beside = shared.value
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    rows = Rows.of(_table(files[i])) if i < len(files) else Rows(*beside)
                    if i < len(files) and len(gone):
                        rows = rows.take(~is_in(rows.ids, gone))
                    if len(rows.ids):
                        yield from job(rows)

        tasks = self.spark.range(0, len(which), 1, min(len(which), 2 * sc.defaultParallelism))
        found = tasks.mapInArrow(run, schema).toArrow()
        shared.destroy()
        return found


def _laid_out(rows: DataFrame, n: int, dims: int, centres: np.ndarray | None, max_bytes: int) -> list[str]:
    """Files of rows that lie together: each goes to the nearest of the given or of some sampled vectors."""
    spark = rows.sparkSession
    parallel = spark.sparkContext.defaultParallelism
    limit = min(rows_per_block(dims, min(max_bytes, FILE_BYTES)), max(LEAST, n // (4 * parallel)))
    wanted = min(MOST_BALLS, -(-n // limit))
    if centres is None:
        # At most MOST_BALLS rows.
        centres = loaded(rows.orderBy(F.xxhash64("cluster_id"), "cluster_id").limit(wanted), "cluster_id", "centroid")[1]
    elif len(centres) > wanted:
        centres = centres[np.linspace(0, len(centres) - 1, wanted).astype(int)]
    shared = spark.sparkContext.broadcast(centres)

    def run(batches):
        find = Finder(np.arange(len(shared.value)), shared.value)
        for batch in batches:
            if batch.num_rows:
                ball = find(matrix(batch.column(3)))[0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball.astype(np.int32))], names=[*_KINDS, "fresh", "ball"])

    held = rows.select(*(F.col(name).cast(kind).alias(name) for name, kind in _KINDS.items()), "fresh")
    path = scratch_path(spark, "balls")
    tasks = max(1, min(wanted, 4 * parallel), -(-n * 8 * dims // (64 * 1024 * 1024)))
    dealt = held.mapInArrow(run, f"{SCHEMA}, fresh boolean, ball int").repartition(tasks, "ball")
    dealt.write.option("maxRecordsPerFile", limit).partitionBy("ball").parquet(path)
    shared.destroy()
    return sorted(spark.read.schema(f"{SCHEMA}, fresh boolean").parquet(path).inputFiles())


def _balls(spark: SparkSession, files: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, radius and number of fresh rows of each file."""
    shared = spark.sparkContext.broadcast(files)

    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                table = _table(shared.value[i], ["centroid", "fresh"])
                held = matrix(table["centroid"])
                centre = held.mean(axis=0)
                radius = float(np.sqrt(lengths(held, centre).max()))
                columns = [pa.array([i]), list_array(centre[None]), pa.array([radius]), pa.array([int(table["fresh"].to_numpy().sum())])]
                yield pa.RecordBatch.from_arrays(columns, names=["i", "centre", "radius", "fresh"])

    tasks = spark.range(0, len(files), 1, min(len(files), 2 * spark.sparkContext.defaultParallelism))
    # One row a file.
    found = tasks.mapInArrow(run, "i bigint, centre array<double>, radius double, fresh bigint").toArrow().sort_by("i")
    shared.destroy()
    return matrix(found["centre"]), found["radius"].to_numpy(), found["fresh"].to_numpy()


def _look(i: int, files: list[str], centres: np.ndarray, radii: np.ndarray, fresh: np.ndarray) -> Rows:
    """The rows of one file with their nearest other ones, from the files that may hold them."""
    rows = Rows.of(_table(files[i]))
    labels, best, open_ = rows.near.copy(), rows.d2.copy(), rows.near < 0
    best[open_] = np.inf
    bounds = np.square(beyond(rows.c, centres, radii))
    away = lengths(centres, rows.c.mean(axis=0))
    away[i] = -1.0
    for b in np.argsort(away, kind="stable").tolist():
        may = bounds[:, b] <= best
        if not fresh[b]:
            may &= open_
        if not may.any():
            continue
        table = _table(files[b], ["cluster_id", "centroid", "fresh"])
        ids, c, new = table["cluster_id"].to_numpy(), matrix(table["centroid"]), table["fresh"].to_numpy()
        at = np.argsort(ids, kind="stable")
        ids, c, new = ids[at], c[at], new[at]
        for some, among in ((may & open_, slice(None)), (may & ~open_, new)):
            some = np.flatnonzero(some)
            if not len(some) or not len(ids[among]):
                continue
            found, d2 = Finder(ids[among], c[among])(rows.c[some], rows.ids[some] if b == i else None)
            was, had = labels[some], best[some]
            nearer = (found >= 0) & ((was < 0) | (d2 < had) | ((d2 == had) & (found < was)))
            labels[some[nearer]], best[some[nearer]] = found[nearer], d2[nearer]
    return rows._replace(near=labels, d2=best)


def with_nearest(rows: DataFrame, n: int, dims: int, centres: np.ndarray | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> Stored:
    """Rows of ``SCHEMA`` and ``fresh`` with all nearest others: those that are null are looked for, the others compared with fresh rows."""
    spark = rows.sparkSession
    files = _laid_out(rows, n, dims, centres, max_bytes)
    balls = _balls(spark, files)
    shared = spark.sparkContext.broadcast((files, *balls))

    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield _look(i, *shared.value).batch()

    path = scratch_path(spark, "nearest")
    spark.range(0, len(files), 1, len(files)).mapInArrow(run, SCHEMA).write.option("maxRecordsPerFile", 0).parquet(path)
    shared.destroy()
    # A task writes the rows of one file, and its name begins with the number of the task.
    done = sorted(spark.read.schema(SCHEMA).parquet(path).inputFiles())
    if len(done) != len(files):
        raise RuntimeError(f"{len(done)} files were written for {len(files)}")
    empty = none(dims)
    return Stored(spark, path, done, balls[0], balls[1], n, empty.ids, empty)


def nearest_other(features: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(a, b, d2): for every row of (cluster_id, centroid) the nearest other row, ties to the lowest id."""
    found = with_nearest(unsearched(features.withColumns({"n": F.lit(1), "sse": F.lit(0.0)})), *sized(features, "centroid"), max_bytes=max_bytes).frame()
    return found.filter("near IS NOT NULL").select(F.col("cluster_id").alias("a"), F.col("near").alias("b"), "d2")


def unsearched(features: DataFrame) -> DataFrame:
    """(cluster_id, n, sse, centroid) with nothing known of the nearest ones."""
    return features.withColumns({"near": F.lit(None).cast("bigint"), "d2": F.lit(None).cast("double"), "fresh": F.lit(True)})
