"""k-means by Spark jobs: assign and add up inside the tasks, combine one row per cluster."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import MAX_BROADCAST_BYTES, written
from .blocks import Block, list_array, matrix, rows_per_block, sized
from .nearest import Centroids, assign_nearest
from .ranking import rank_within
from .sampling import BROADCAST_KEYS, sample_exact, shuffle_key, truncate
from .starts import oversampled_start

_PARTIAL = "cluster_id int, n bigint, mean array<double>"


class _Sums:
    """Sums per cluster within a task; memory stays below the bound, whatever the number of clusters."""

    def __init__(self, max_bytes: int) -> None:
        self.max_bytes = max_bytes
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @staticmethod
    def _grouped(labels: np.ndarray, n: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(labels, kind="stable")
        ids, start = np.unique(labels[order], return_index=True)
        return ids, np.add.reduceat(n[order], start), np.add.reduceat(x[order], start, axis=0)

    def _heavy(self) -> bool:
        return sum(part[2].nbytes for part in self.parts) > self.max_bytes

    def add(self, labels: np.ndarray, x: np.ndarray):
        """Take in a batch; yields the sums collected so far where they outgrow the bound."""
        self.parts.append(self._grouped(labels, np.ones(len(labels), np.int64), x))
        if self._heavy():
            self._compact()
            if self._heavy():
                yield from self.drain()

    def _compact(self) -> None:
        if len(self.parts) > 1:
            self.parts = [self._grouped(*(np.concatenate(column) for column in zip(*self.parts)))]

    def drain(self):
        """One row per cluster that was met, and start again."""
        self._compact()
        for ids, n, total in self.parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int32)), pa.array(n), list_array(total / n[:, None])],
                names=["cluster_id", "n", "mean"],
            )
        self.parts = []


def _combine(partial: DataFrame) -> DataFrame:
    """One row per cluster: the mean of the partial means, weighted with their sizes."""
    vector = array_to_vector(F.col("mean"))
    return (
        partial.groupBy("cluster_id")
        .agg(
            F.sum("n").alias("n"),
            Summarizer.metrics("mean").summary(vector, F.col("n").cast("double")).alias("_s"),
        )
        .select("cluster_id", "n", vector_to_array("_s.mean").alias("mean"))
    )


def _nearest_means(points: DataFrame, centroids: Centroids, vec: str, max_bytes: int) -> DataFrame:
    """(cluster_id, n, mean) of the points nearest to each centroid, found and added up in one pass."""

    def run(batches):
        find, sums = centroids.finder(), _Sums(max_bytes)
        for batch in centroids.chunks(batches):
            x = matrix(batch.column(0))
            yield from sums.add(find(x)[0], x)
        yield from sums.drain()

    return _combine(points.select(vec).mapInArrow(run, _PARTIAL))


def label_means(points: DataFrame, label: str = "cluster_id", vec: str = "embedding", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(cluster_id, n, mean) of labelled points; every task sends one row per cluster it holds."""

    def run(batches):
        sums = _Sums(max_bytes)
        for batch in batches:
            if batch.num_rows:
                yield from sums.add(batch.column(0).to_numpy(), matrix(batch.column(1)))
        yield from sums.drain()

    return _combine(points.select(F.col(label).cast("int"), vec).mapInArrow(run, _PARTIAL))


@dataclass
class Centres:
    """Current centres: arrays on the driver while they fit one block, a written table beyond."""

    spark: SparkSession
    max_bytes: int
    ids: np.ndarray | None = None
    values: np.ndarray | None = None
    weight: np.ndarray | None = None
    table: DataFrame | None = None
    # Centres that got no point in the last round, as a table (cluster_id).
    empty: DataFrame | None = None

    @classmethod
    def of(cls, table: DataFrame, k: int, dims: int, max_bytes: int) -> Centres:
        if k > rows_per_block(dims, max_bytes):
            held = table.select("cluster_id", "centroid", F.lit(0).cast("bigint").alias("weight"))
            return cls(table.sparkSession, max_bytes, table=written(held, "centres"))
        local = table.select("cluster_id", "centroid").toArrow()
        ids, values = local["cluster_id"].to_numpy(), matrix(local["centroid"])
        order = np.argsort(ids)
        return cls(table.sparkSession, max_bytes, ids[order], values[order], np.zeros(len(ids), np.int64))

    def sent(self) -> Centroids:
        if self.table is None:
            return Centroids(Block.of(self.spark, self.ids, self.values, distinct=True).data, [])
        return Centroids.of(self.table, self.max_bytes)

    def round(self, points: DataFrame, vec: str, keep_weight: bool = False) -> None:
        """One pass over the points; the executors forget its centres afterwards."""
        centroids = self.sent()
        self._move(_nearest_means(points, centroids, vec, self.max_bytes), keep_weight)
        centroids.release()

    def _move(self, means: DataFrame, keep_weight: bool) -> None:
        """Move every centre to the mean of its points; a centre without points stays.

        With ``keep_weight`` the points of earlier rounds keep their share, so the rate of a
        centre falls with the number of points it has seen.
        """
        if self.table is None:
            found = means.toArrow()
            at = np.searchsorted(self.ids, found["cluster_id"].to_numpy())
            self.empty = self._ids(np.delete(self.ids, at))
            if not found.num_rows:
                return
            n = found["n"].to_numpy()
            rate = (n / (self.weight[at] + n) if keep_weight else np.ones(len(n)))[:, None]
            self.values = self.values.copy()
            self.values[at] = self.values[at] * (1.0 - rate) + matrix(found["mean"]) * rate
            if keep_weight:
                self.weight[at] += n
            return
        joined = self.table.join(means, "cluster_id", "left")
        rate = F.col("n") / (F.col("weight") + F.col("n")) if keep_weight else F.lit(1.0)
        mixed = joined.withColumn("_r", rate).withColumn(
            "centroid",
            F.when(F.col("n").isNull(), F.col("centroid")).otherwise(
                F.zip_with(
                    F.transform("centroid", lambda a: a * (1 - F.col("_r"))),
                    F.transform("mean", lambda m: m * F.col("_r")),
                    lambda a, b: a + b,
                )
            ),
        )
        seen = F.col("weight") + F.coalesce(F.col("n"), F.lit(0)) if keep_weight else F.col("weight")
        self.table = written(mixed.select("cluster_id", "centroid", seen.alias("weight"), F.col("n").isNull().alias("empty")), "centres")
        self.empty = self.table.filter("empty").select("cluster_id")

    def _ids(self, ids: np.ndarray) -> DataFrame:
        return self.spark.createDataFrame(pa.table({"cluster_id": pa.array(ids.astype(np.int32))}))

    def refill(self, points: DataFrame, key: str, vec: str) -> None:
        """Move every centre that got no point onto the point farthest from its own centre, one of each cluster.

        Equal points have the same nearest centre, so no two centres get equal vectors.  Where there
        are more such centres than clusters with a distance above 0, the others wait for the next round.
        """
        n = self.empty.count()
        if not n:
            return
        label = assign_nearest(points, self.frame(), key, vec, self.max_bytes)
        far = label.groupBy("cluster_id").agg(F.max(F.struct("d2", (-F.col(key)).alias("k"))).alias("_far"))
        far = far.select(F.col("_far.d2").alias("d2"), (-F.col("_far.k")).alias(key)).filter("d2 > 0")
        self._replace(self.empty, n, far, [F.desc("d2"), key], points, key, vec)

    def reassign(self, batch: DataFrame, ratio: float, seed: int, key: str, vec: str) -> None:
        """Move centres with less than ``ratio`` of the heaviest centre's weight onto random points of the batch.

        At most half the batch is used, for the lightest centres; they get the least weight of the others.
        """
        if self.table is None:
            light = np.flatnonzero(self.weight < ratio * self.weight.max())
            # The lightest first.
            light = light[np.lexsort((self.ids[light], self.weight[light]))]
            rest, n = np.delete(self.weight, light), min(len(light), batch.count() // 2) if len(light) else 0
            ids, least = self._ids(self.ids[light[:n]]), int(rest.min()) if len(rest) else 0
        else:
            heaviest = self.table.agg(F.max("weight")).first()[0]
            is_light = F.col("weight") < ratio * heaviest
            found = self.table.agg(F.sum(is_light.cast("long")).alias("n"), F.min(F.when(~is_light, F.col("weight"))).alias("least")).first()
            least, n = found.least or 0, min(found.n, batch.count() // 2) if found.n else 0
            ids = self.table.filter(is_light).orderBy("weight", "cluster_id").limit(n).select("cluster_id")
        if n:
            drawn = sample_exact(batch.select(key), n, key, seed)
            self._replace(ids, n, drawn, [shuffle_key(key, seed), key], batch, key, vec, least)

    def _replace(self, ids: DataFrame, n: int, chosen: DataFrame, order: list, points: DataFrame, key: str, vec: str, weight: int = 0) -> None:
        """The i-th of ``n`` centres by id becomes the i-th chosen row in order."""
        numbered = rank_within(ids, [], ["cluster_id"], "_rn", size=n)
        keys = rank_within(chosen.select(key, *[c for c in chosen.columns if c != key]), [], order, "_rn", size=self._size()).select(key, "_rn")
        pairs = numbered.join(keys, "_rn").select("cluster_id", key)
        new = points.select(key, vec).join(F.broadcast(pairs) if n <= BROADCAST_KEYS else pairs, key)
        new = new.select("cluster_id", F.col(vec).cast("array<double>").alias("_new"))
        if self.table is None:
            found = new.toArrow()
            if found.num_rows:
                at = np.searchsorted(self.ids, found["cluster_id"].to_numpy())
                self.values, self.weight = self.values.copy(), self.weight.copy()
                self.values[at], self.weight[at] = matrix(found["_new"]), weight
            return
        moved = F.col("_new").isNotNull()
        self.table = written(
            self.table.join(new, "cluster_id", "left").select(
                "cluster_id", F.coalesce("_new", "centroid").alias("centroid"), F.when(moved, F.lit(weight)).otherwise(F.col("weight")).cast("bigint").alias("weight"), "empty"
            ),
            "centres",
        )

    def _size(self) -> int:
        return len(self.ids) if self.table is None else self.table.count()

    def frame(self) -> DataFrame:
        if self.table is not None:
            return self.table.select("cluster_id", "centroid")
        data = pa.table({"cluster_id": pa.array(self.ids.astype(np.int32)), "centroid": list_array(self.values)})
        return self.spark.createDataFrame(data)


def initial_centroids(points: DataFrame, k: int, init: str, seed: int, key: str, vec: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """k starting centres, numbered 0..k-1: the first rows by key, an exact random sample, or rows far from each other.

    They are chosen and numbered on their keys alone, so no task holds all their vectors.
    """
    if init == "oversampled":
        return oversampled_start(points, k, seed, key, vec, max_bytes)
    keys = points.select(key)
    if init == "first":
        chosen, order = truncate(keys, k, key), [key]
    elif init == "sample":
        chosen, order = sample_exact(keys, k, key, seed), [shuffle_key(key, seed), key]
    else:
        raise ValueError(f"init must be 'first', 'sample' or 'oversampled', not {init!r}")
    numbered = rank_within(chosen, [], order, "_rn", size=k)
    # k keys and numbers
    ranked = points.select(key, vec).join(F.broadcast(numbered) if k <= BROADCAST_KEYS else numbered, key)
    return ranked.select((F.col("_rn") - 1).cast("int").alias("cluster_id"), F.col(vec).cast("array<double>").alias("centroid"))


def _checked(points: DataFrame, k: int, key: str, vec: str) -> tuple[DataFrame, int, int]:
    points = points.filter(F.col(vec).isNotNull()).select(key, vec)
    n, dims = sized(points, vec)
    if k < 1 or k > n:
        raise ValueError(f"cannot form {k} clusters from {n} points")
    return points, n, dims


def kmeans(
    points: DataFrame,
    k: int,
    niter: int = 6,
    seed: int = 42,
    init: str = "sample",
    max_points_per_centroid: int | None = None,
    key: str = "row_id",
    vec: str = "embedding",
    max_bytes: int = MAX_BROADCAST_BYTES,
    refill: bool = False,
) -> DataFrame:
    """(cluster_id, centroid) after ``niter`` Lloyd rounds; ids are always 0..k-1.

    All points train, or at most ``max_points_per_centroid`` x k of them, drawn exactly, where that is given.
    With ``refill`` a centre that got no point in a round is moved onto a point far from its own centre;
    without, it stays.
    """
    points, n, dims = _checked(points, k, key, vec)
    if max_points_per_centroid and n > max_points_per_centroid * k:
        points = written(sample_exact(points, max_points_per_centroid * k, key, seed), "train")
    centres = Centres.of(initial_centroids(points, k, init, seed, key, vec, max_bytes), k, dims, max_bytes)
    for _ in range(niter):
        centres.round(points, vec)
        if refill:
            centres.refill(points, key, vec)
    return centres.frame()


def minibatch_kmeans(
    points: DataFrame,
    k: int,
    max_iter: int = 10,
    batch: int = 4096,
    seed: int = 42,
    init: str = "sample",
    key: str = "row_id",
    vec: str = "embedding",
    max_bytes: int = MAX_BROADCAST_BYTES,
    batches: int | None = None,
    reassignment: float = 0.0,
) -> DataFrame:
    """(cluster_id, centroid) after ``max_iter`` passes over all rows, in random batches of about ``batch`` rows.

    The rows are dealt to batches by md5(key-seed-pass), every row once per pass, and the batches
    of a pass are written in one scan, each spread over several tasks; a round then reads its own
    batch only.  ``batches`` sets their number per pass instead of their size.
    After a pass, centres with less than ``reassignment`` of the heaviest one's weight are moved onto random rows of its
    last batch; not after the last pass, so that what is moved is trained.
    """
    points, n, dims = _checked(points, k, key, vec)
    per_epoch = batches or -(-n // batch)
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)), F.col("_epoch").cast("string")))
    dealt_by = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    centres = Centres.of(initial_centroids(points, k, init, seed, key, vec, max_bytes), k, dims, max_bytes)
    for epoch in range(max_iter):
        dealt = points.withColumn("_epoch", F.lit(epoch)).withColumn("_round", F.pmod(dealt_by, F.lit(per_epoch)).cast("int")).drop("_epoch")
        # A range of (batch, key) per task: a batch is read by its files' statistics, and by many tasks.
        held = written(dealt.repartitionByRange("_round", key), "batches")
        for i in range(per_epoch):
            centres.round(held.filter(F.col("_round") == i), vec, keep_weight=True)
        if reassignment and epoch + 1 < max_iter:
            centres.reassign(held.filter(F.col("_round") == per_epoch - 1), reassignment, seed + epoch, key, vec)
    return centres.frame()


def inertia(assign: DataFrame) -> DataFrame:
    """One row: the sum of squared distances."""
    return assign.agg(F.sum("d2").alias("inertia"))


def cluster_centroids(points: DataFrame, assign: DataFrame, k: int, key: str = "row_id", vec: str = "embedding") -> DataFrame:
    """(cluster_id, centroid, n) for 0..k-1: the mean of the members, zeros for an empty cluster."""
    means = label_means(points.select(key, vec).join(assign.select(key, "cluster_id"), key), vec=vec)
    dims = sized(points, vec)[1]
    every = points.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster_id"))
    zeros = F.array_repeat(F.lit(0.0), dims)
    return every.join(means, "cluster_id", "left").select(
        "cluster_id", F.coalesce("mean", zeros).alias("centroid"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )
