"""Clustering by radius: sub-clusters whose root-mean-square radius stays below a threshold.

Every different point starts as a sub-cluster: its number of points, centroid and sum of squared
distances to it.  In a round each sub-cluster looks
for its nearest other one, by centroids, ties to the lowest id, and points to it if the two may merge,
which they may if the merged radius is at most the threshold.  Of two that point to each other the
larger one, of equals that with the lower id, is the root.  Every root, that is whatever is pointed to
and does not point itself, takes in those that point to it, nearest first, for as long as the sum of
squares about the root's own centroid keeps the radius below the threshold, and the first in any case.
Rounds go on until nothing points anywhere; every round but the last merges something.

The result is fixed by the points and the threshold alone, up to the rounding of sums: neither the
order of rows, nor partitions, nor any bound has part in it.  Once ``group_rows`` sub-clusters are left, one task takes
the same rounds over them in memory.

Before, sub-clusters lie in files with their nearest others (``neighbours``), which a round looks for again only where
it changed something.  Where few may merge, and a large sub-cluster may take in one other in each of hundreds of
rounds, the driver gathers what lies around these few and takes rounds as long as it is proved that nothing else
has part in them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from ..session import MAX_BROADCAST_BYTES, written
from .blocks import list_array, matrix, sized
from .nearest import GATHERED_BYTES, Finder, assign_nearest
from .neighbours import SCHEMA, Rows, Stored, is_in, lengths, squares, unsearched, with_nearest
from .ranking import rank_within, running_total

# Sub-clusters that one task merges to the end.
GROUP_ROWS = 4_096
# Pairs that one task forms into stars (seven numbers a pair), and pairs that the driver follows over several rounds.
PAIRS_IN_TASK = 1 << 20
FEW_PAIRS = 256
# Bytes of rows that the driver gathers for these pairs, at most.
FOLLOWED_BYTES = GATHERED_BYTES
LESS = 1 - 1e-6
# Whole numbers that a root's room is counted in, so that its sums do not depend on their order.
UNIT = float(1 << 20)

_FEATURE = "cluster_id bigint, n bigint, sse double, centroid array<double>"


def merged_square(n_a, n_b, sse_a, sse_b, d2):
    """The squared radius of two sub-clusters as one; numbers, arrays or columns."""
    return (sse_a + sse_b + (n_a * n_b) / (n_a + n_b) * d2) / (n_a + n_b)


def weights(n, sse, d2, bound: float):
    """How much of a root's room a member takes, before rounding; numbers, arrays or columns."""
    return ((sse + n * d2) / bound - n) * UNIT


def taken_members(n: np.ndarray, sse: np.ndarray, near: np.ndarray, d2: np.ndarray, points: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Members and their roots of one round, by root: ``points`` marks rows that may merge with row ``near``, rows are in order of ids."""
    me = np.arange(len(n))
    mutual = points & points[near] & (near[near] == me)
    points = points & ~(mutual & ((n > n[near]) | ((n == n[near]) & (me < near))))
    member = np.flatnonzero(points & ~points[near])
    root = near[member]
    order = np.lexsort((member, d2[member], root))
    member, root = member[order], root[order]
    _, first, count = np.unique(root, return_index=True, return_counts=True)
    hubs = root[first]
    takes = np.ceil(weights(n[member], sse[member], d2[member], bound)).astype(np.int64)
    total = np.cumsum(takes)
    total -= np.repeat(total[first] - takes[first], count)
    room = np.floor((n[hubs] - sse[hubs] / bound) * UNIT).astype(np.int64)
    over = total > np.repeat(room, count)
    # Members before the first that is too much, and the first one anyway.
    past = np.cumsum(over)
    past -= np.repeat(past[first] - over[first], count)
    taken = past == 0
    taken[first] = True
    return member[taken], root[taken]


def merged_rows(n: np.ndarray, sse: np.ndarray, c: np.ndarray, d2: np.ndarray, member: np.ndarray, root: np.ndarray):
    """(hubs, their numbers, sums of squares and centroids) once the members are taken in."""
    hubs, first = np.unique(root, return_index=True)
    own = d2[member] * n[member] + sse[member]
    size = n[hubs] + np.add.reduceat(n[member], first)
    mean = (c[hubs] * n[hubs, None] + np.add.reduceat(c[member] * n[member, None], first, axis=0)) / size[:, None]
    moved = np.einsum("ij,ij->i", mean - c[hubs], mean - c[hubs])
    return hubs, size, np.maximum(sse[hubs] + np.add.reduceat(own, first) - size * moved, 0.0), mean


def merge_all(ids: np.ndarray, n: np.ndarray, sse: np.ndarray, c: np.ndarray, threshold: float):
    """All rounds over sub-clusters in memory: ids in order, numbers (as doubles), sums of squares and centroids.

    A sub-cluster's nearest other one is looked for again only where it may have changed.
    """
    bound = threshold * threshold
    near, d2 = np.full(len(ids), -1), np.full(len(ids), np.inf)
    stale = np.arange(len(ids))
    while len(ids) > 1:
        if len(stale):
            found, d2[stale] = Finder(ids, c)(c[stale], ids[stale])
            near[stale] = np.searchsorted(ids, found)
        points = merged_square(n, n[near], sse, sse[near], d2) <= bound
        if not points.any():
            break
        member, root = taken_members(n, sse, near, d2, points, bound)
        hubs, n[hubs], sse[hubs], c[hubs] = merged_rows(n, sse, c, d2, member, root)
        changed = np.zeros(len(ids), bool)
        changed[hubs] = changed[member] = True
        # Stale: what merged, what pointed there, and whatever a new centroid has come as near to.
        old = changed | changed[near]
        keep = np.ones(len(ids), bool)
        keep[member] = False
        place = np.cumsum(keep) - 1
        old |= Finder(ids[hubs], c[hubs])(c)[1] <= d2
        near = np.where(keep[near], place[near], -1)[keep]
        ids, n, sse, c, d2 = ids[keep], n[keep], sse[keep], c[keep], d2[keep]
        stale = np.flatnonzero(old[keep])
    return ids, n, sse, c


def _finished(features: DataFrame, threshold: float) -> DataFrame:
    """All rounds in one task, for a bounded number of sub-clusters."""

    def job(table: pa.Table) -> pa.Table:
        table = table.sort_by("cluster_id")
        held = merge_all(table["cluster_id"].to_numpy().copy(), table["n"].to_numpy().astype(float), table["sse"].to_numpy().copy(), matrix(table["centroid"]).copy(), threshold)
        return pa.table({"cluster_id": pa.array(held[0]), "n": pa.array(held[1].astype(np.int64)), "sse": pa.array(held[2]), "centroid": list_array(held[3])})

    return features.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(job, _FEATURE)


def _taken_in_task(pairs: DataFrame, bound: float) -> DataFrame:
    """(a, b, d2): the members and roots of a round among a bounded number of pairs, in one task."""

    def job(table: pa.Table) -> pa.Table:
        a, b = table["a"].to_numpy(), table["b"].to_numpy()
        ids = np.union1d(a, b)
        n, sse, d2, near = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        points, at, to = np.zeros(len(ids), bool), np.searchsorted(ids, a), np.searchsorted(ids, b)
        n[to], sse[to] = table["n_b"].to_numpy(), table["sse_b"].to_numpy()
        n[at], sse[at], d2[at], near[at], points[at] = table["n_a"].to_numpy(), table["sse_a"].to_numpy(), table["d2"].to_numpy(), to, True
        member, root = taken_members(n, sse, near, d2, points, bound)
        return pa.table({"a": pa.array(ids[member]), "b": pa.array(ids[root]), "d2": pa.array(d2[member])})

    return pairs.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(job, "a bigint, b bigint, d2 double")


def _taken(pairs: DataFrame, bound: float) -> DataFrame:
    """As ``_taken_in_task`` for any number of pairs."""
    back = pairs.select(F.col("a").alias("b"), F.col("b").alias("a"))
    larger = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    roots = pairs.join(back, ["a", "b"], "left_semi").filter(larger).select("a")
    pointing = written(pairs.join(roots, "a", "left_anti"), "pointing")
    stars = pointing.join(pointing.select(F.col("a").alias("b")), "b", "left_anti")
    stars = stars.withColumn("takes", F.ceil(weights(F.col("n_a"), F.col("sse_a"), F.col("d2"), bound)))
    stars = stars.withColumn("room", F.floor((F.col("n_b") - F.col("sse_b") / bound) * UNIT))
    place = F.struct("d2", "a")
    summed = written(running_total(stars, ["b"], ["d2", "a"], "takes", "total"), "stars")
    stops = summed.groupBy("b").agg(F.min(place).alias("_first"), F.min(F.when(F.col("total") > F.col("room"), place)).alias("_stop"))
    taken = summed.join(stops, "b").filter(F.col("_stop").isNull() | (place < F.col("_stop")) | (place == F.col("_first")))
    return taken.select("a", "b", "d2")


class _Around:
    """The rows around the ends of few pairs, with what proves that rows outside have no part in a round.

    ``reach``: everything nearer than this to where the row was when gathered is inside; 0 where that is not known.
    ``cut`` is the same for the ends.  ``known``: rows whose pointers are all inside.  ``slack``: what is this near to
    where an end was is not the nearest one of a row outside.  ``rows`` is None where too many rows point to an end.
    """

    def __init__(self, held: Stored, ends: Rows) -> None:
        self.ends = ends
        # Of all rows that may be gathered: those around the ends, those whose nearest one may become a moved end,
        # those that point to what may merge, and those that may look again, each with four others.
        most = FOLLOWED_BYTES // (8 * ends.c.shape[1] + 48)
        share, watching, pointing, looking = max(8, most // 4 // len(ends.ids)), most // 8, most // 8, most // 8
        # What the files list comes to the driver: less of each, the more files there are.
        files = len(held.files) + 1
        listed, watched = max(2, min(max(8, share // 4), FOLLOWED_BYTES // (16 * files * len(ends.ids)))), max(2, min(128, FOLLOWED_BYTES // (64 * files)))
        looking = max(9, min(looking, 2 * FOLLOWED_BYTES // (60 * files)))

        def near_ends(rows: Rows):
            d2, _ = squares(rows.c, ends.c)
            here = np.flatnonzero(is_in(ends.ids, rows.ids))
            d2[np.searchsorted(rows.ids, ends.ids[here]), here] = np.inf
            margin = np.where(is_in(rows.ids, ends.ids), np.inf, np.sqrt(d2.min(axis=1)) - np.sqrt(rows.d2))
            values, top = [*d2.T, margin], [listed] * len(ends.ids) + [watched]
            at = [np.argpartition(v, k - 1)[:k] if len(v) > k else np.arange(len(v)) for v, k in zip(values, top)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(at)), pa.int32()), pa.array([rows.ids[i] for i in at]), pa.array([v[i] for v, i in zip(values, at)]), pa.array([len(v) > k for v, k in zip(values, top)])],
                names=["e", "ids", "v", "more"],
            )

        table = held.scan(near_ends, "e int, ids array<bigint>, v array<double>, more boolean")
        lists: list[list] = [[] for _ in range(len(ends.ids) + 1)]
        for e, ids, v, more in zip(*(table[c].to_numpy(zero_copy_only=False) for c in ("e", "ids", "v", "more"))):
            lists[e].append((ids, v, more))
        cuts, nearest = [], []
        for some, top in zip(lists, [share] * len(ends.ids) + [watching]):
            ids, v = np.concatenate([s[0] for s in some]), np.concatenate([s[1] for s in some])
            order = np.argsort(v, kind="stable")
            cuts.append(min([v[order[top - 1]] if len(v) > top else np.inf, *(s[1].max() for s in some if s[2])]))
            # As many as leave room for what points to them.
            nearest.append(ids[order[: max(2, looking // 3 // len(ends.ids))]])
        # A little less, so that no number of rows at equal distances is gathered.
        cut, slack = np.array(cuts[:-1]) * LESS, cuts[-1] * LESS
        self.rows, self.slack, self.cut = None, slack, np.sqrt(cut)
        if not slack > (1 - LESS) * self.cut.max(where=np.isfinite(cut), initial=0.0):
            return
        known = np.union1d(ends.ids, np.concatenate(nearest[:-1]))

        def pointers(rows: Rows):
            ids, n = np.unique(rows.near[is_in(rows.near, known)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

        table = held.scan(pointers, "id bigint, n bigint")
        n = np.bincount(np.searchsorted(known, table["id"].to_numpy()), table["n"].to_numpy(), len(known))
        # Rows that very many point to are left out: a round that changes one of them is not followed.
        few = np.argsort(n, kind="stable")
        known = np.sort(known[few[np.cumsum(n[few]) <= pointing]])

        def gathered(rows: Rows):
            d2, error = squares(rows.c, ends.c)
            low = np.maximum(d2 - error, 0.0)
            inside = (low <= cut).any(axis=1) | (np.sqrt(low.min(axis=1)) - np.sqrt(rows.d2) <= slack)
            inside |= is_in(rows.near, known) | is_in(rows.ids, known)
            if inside.any():
                yield rows.take(np.flatnonzero(inside)).batch()

        rows = Rows.joined([ends, Rows.of(held.scan(gathered, SCHEMA))])
        # Those that may look again: the nearest, what points to them, and what an end may come near to.
        away = np.sqrt(squares(rows.c, ends.c)[0].min(axis=1)) - np.sqrt(rows.d2)
        first = np.lexsort((away, ~is_in(rows.near, known), ~is_in(rows.ids, known)))
        asking = rows.take(np.sort(first[~is_in(rows.ids[first], ends.ids)][:looking]))
        reach = np.zeros(len(asking.ids))
        if len(asking.ids):
            # Within the fourth nearest among the rows gathered there are four others at most, wherever they lie.
            fourth = np.empty(len(reach))
            for lo in range(0, len(reach), 64):
                d2, error = squares(rows.c, asking.c[lo : lo + 64])
                fourth[lo : lo + 64] = np.partition(d2, min(4, len(d2) - 1), axis=0)[min(4, len(d2) - 1)] + error

            def nearest_four(part: Rows):
                d2, error = squares(part.c, asking.c)
                best = np.sort(np.partition(d2, 4, axis=0)[:5], axis=0) if len(d2) > 5 else np.sort(d2, axis=0)
                e, k = np.nonzero((best <= fourth + error).T)
                yield pa.RecordBatch.from_arrays([pa.array(e.astype(np.int32)), pa.array(best[k, e])], names=["e", "v"])

            found = held.scan(nearest_four, "e int, v double", asking.c, np.sqrt(fourth))
            e, v = found["e"].to_numpy(), found["v"].to_numpy()
            order = np.lexsort((v, e))
            e, v = e[order], v[order]
            # The row itself is the first, its nearest one the second.
            start = np.searchsorted(e, np.arange(len(reach)))
            last = np.minimum(start + 4, np.searchsorted(e, np.arange(len(reach)), "right") - 1)
            reach = np.where(last >= start, v[np.maximum(last, 0)], 0.0) * LESS

            def within(part: Rows):
                d2, error = squares(part.c, asking.c)
                inside = (d2 <= reach + error).any(axis=1)
                if inside.any():
                    yield part.take(np.flatnonzero(inside)).batch()

            rows = Rows.joined([rows, Rows.of(held.scan(within, SCHEMA, asking.c, np.sqrt(reach)))])
        self.rows = rows
        self.reach = np.zeros(len(rows.ids))
        self.reach[np.searchsorted(rows.ids, asking.ids)] = np.sqrt(reach)
        self.reach[np.searchsorted(rows.ids, ends.ids)] = np.sqrt(cut)
        self.known = is_in(rows.ids, known)


def _followed(held: Stored, ends: Rows, threshold: float) -> tuple[int, Stored, Rows]:
    """Rounds taken in the driver as long as it is proved that only the rows around the ends have part in them.

    Returns their number, the sub-clusters after them, and the ends of the pairs that may merge then.
    """
    bound, around = threshold * threshold, _Around(held, ends)
    if around.rows is None:
        return 0, held, ends
    ids, n, sse, c, near, d2 = around.rows
    n, was = n.astype(float), c

    def from_ends(x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([lengths(x, end) for end in ends.c], axis=1))

    alive, touched, rounds = np.ones(len(ids), bool), np.zeros(len(ids), bool), 0
    while True:
        inside = alive & is_in(near, ids)
        at = np.where(inside, np.searchsorted(ids, near).clip(max=len(ids) - 1), 0)
        points = inside & (merged_square(n, n[at], sse, sse[at], d2) <= bound)
        if not points.any():
            break
        member, root = taken_members(n, sse, at, d2, points, bound)
        hubs, size, square, mean = merged_rows(n, sse, c, d2, member, root)
        changed = np.zeros(len(ids), bool)
        changed[hubs] = changed[member] = True
        moved = from_ends(mean).min(axis=1)
        if not around.known[changed].all() or not (moved < around.slack * (1 - 1e-9)).all():
            break
        left, new = alive.copy(), c.copy()
        left[member], new[hubs] = False, mean
        stale = np.flatnonzero(left & (changed | (inside & changed[at])))
        live = np.flatnonzero(left)
        found, away = Finder(ids[live], new[live])(new[stale], ids[stale])
        # Nothing outside is nearer than what a ball that is known whole leaves, about the row itself or about an end.
        sure = around.reach[stale] - np.sqrt(np.einsum("ij,ij->i", new[stale] - was[stale], new[stale] - was[stale]))
        sure = np.maximum(sure, (around.cut - from_ends(new[stale])).max(axis=1))
        if not (np.isinf(sure) | (np.sqrt(away) < sure * (1 - 1e-9))).all():
            break
        other = np.setdiff1d(live, stale)
        hub, to_hub = Finder(ids[hubs], mean)(new[other])
        nearer = (to_hub < d2[other]) | ((to_hub == d2[other]) & (hub < near[other]))
        near, d2, n, sse = near.copy(), d2.copy(), n.copy(), sse.copy()
        near[stale], d2[stale] = found, away
        near[other[nearer]], d2[other[nearer]] = hub[nearer], to_hub[nearer]
        n[hubs], sse[hubs], c, alive = size, square, new, left
        touched[stale] = touched[other[nearer]] = touched[member] = True
        rounds += 1
    now = Rows(ids, n.astype(np.int64), sse, c, near, d2)
    if rounds:
        held = held.changed(ids[touched], now.take(np.flatnonzero(touched & alive)), int((~alive).sum()))
    return rounds, held, now.take(np.union1d(np.flatnonzero(points), at[points]))


def rounds_among_few(held: Stored, ends: Rows, threshold: float) -> Stored:
    """The sub-clusters after the rounds that can be followed while few pairs may merge; the same ones where none can."""
    while 0 < len(ends.ids) <= min(2 * FEW_PAIRS, FOLLOWED_BYTES // (8 * ends.c.shape[1] + 48) // 16) and held.extra.nbytes + held.gone.nbytes <= GATHERED_BYTES:
        rounds, held, ends = _followed(held, ends, threshold)
        if not rounds:
            break
    return held


def _round(held: Stored, threshold: float, max_bytes: int) -> Stored | None:
    """The sub-clusters after a distributed round, or after several where few may merge; None where nothing may."""
    bound = threshold * threshold
    features = held.frame()
    sizes = features.select("cluster_id", F.col("n").cast("double").alias("n"), "sse")
    from_a = features.filter("near IS NOT NULL").select(F.col("cluster_id").alias("a"), F.col("near").alias("b"), "d2", F.col("n").cast("double").alias("n_a"), F.col("sse").alias("sse_a"))
    pairs = from_a.join(sizes.toDF("b", "n_b", "sse_b"), "b")
    square = merged_square(*(F.col(c) for c in ("n_a", "n_b", "sse_a", "sse_b", "d2")))
    pairs = written(pairs.filter(square <= bound), "pairs")
    m = pairs.count()
    if m == 0:
        return None
    if m <= FEW_PAIRS:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("cluster_id")).distinct()
        after = rounds_among_few(held, Rows.of(features.join(F.broadcast(ends), "cluster_id").toArrow()), threshold)
        if after.rows < held.rows:
            return after
    taken = written(_taken_in_task(pairs, bound) if m <= PAIRS_IN_TASK else _taken(pairs, bound), "taken")
    fewer = taken.count()
    few = F.broadcast if 48 * fewer <= GATHERED_BYTES else (lambda df: df)
    into = taken.select(F.col("a").alias("cluster_id"), F.col("b").alias("into"), F.col("d2").alias("away"))
    into = into.unionByName(taken.select(F.col("b").alias("cluster_id"), F.col("b").alias("into"), F.lit(0.0).alias("away")).distinct())
    merging = features.join(few(into), "cluster_id")
    summary = Summarizer.metrics("mean").summary(array_to_vector("centroid"), F.col("n").cast("double"))
    was = F.max(F.when(F.col("into") == F.col("cluster_id"), F.col("centroid"))).alias("_was")
    sums = merging.groupBy("into").agg(F.sum("n").alias("n"), F.sum(F.col("sse") + F.col("n") * F.col("away")).alias("_about"), summary.alias("_s"), was)
    sums = sums.select("into", "n", "_about", vector_to_array("_s.mean").alias("centroid"), "_was")
    moved = F.aggregate(F.zip_with("centroid", "_was", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    sse = F.greatest(F.col("_about") - F.col("n") * moved, F.lit(0.0))
    merged = unsearched(sums.select(F.col("into").alias("cluster_id"), "n", sse.alias("sse"), "centroid"))
    # A row that pointed to what merged looks again; all others keep their nearest one unless a new centroid is nearer.
    changed = into.select("cluster_id")
    alone = features.join(few(changed), "cluster_id", "left_anti")
    alone = alone.join(few(changed.select(F.col("cluster_id").alias("near"), F.lit(True).alias("_old"))), "near", "left")
    alone = alone.withColumns({c: F.when(F.col("_old").isNull(), F.col(c)) for c in ("near", "d2")}).withColumn("fresh", F.lit(False)).drop("_old")
    return with_nearest(alone.unionByName(merged), held.rows - fewer, held.centres.shape[1], held.centres, max_bytes)


def distinct_points(points: DataFrame, key: str = "row_id", vec: str = "embedding") -> DataFrame:
    """The sub-clusters to start from: every different point, named by its smallest key, written."""
    held = points.filter(F.col(vec).isNotNull()).select(F.col(key).cast("bigint").alias("_key"), F.col(vec).cast("array<double>").alias("centroid"))
    one = held.groupBy("centroid").agg(F.min("_key").alias("cluster_id"), F.count(F.lit(1)).alias("n"))
    features = written(one.select("cluster_id", "n", F.lit(0.0).alias("sse"), "centroid"), "features")
    if features.isEmpty():
        raise ValueError("threshold clustering found zero clusters")
    return features


class Start:
    """The distinct points that clustering starts from; their nearest others are looked for once, for all thresholds."""

    def __init__(self, features: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> None:
        self.features, self.max_bytes = features, max_bytes
        self.rows, self.dims = sized(features, "centroid")
        self._held: Stored | None = None

    def held(self) -> Stored:
        if self._held is None:
            rows = self.features
            # Different points may have one key, or none: the searches tell rows apart by their id.
            if rows.agg(F.countDistinct("cluster_id")).first()[0] < self.rows:
                rows = rank_within(rows, [], [F.asc_nulls_last("cluster_id"), "centroid"], "_rn").withColumn("cluster_id", F.col("_rn").cast("bigint")).drop("_rn")
            self._held = with_nearest(unsearched(rows), self.rows, self.dims, max_bytes=self.max_bytes)
        return self._held


def threshold_centroids(
    points: DataFrame,
    threshold: float,
    key: str = "row_id",
    vec: str = "embedding",
    group_rows: int = GROUP_ROWS,
    start: Start | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(cluster_id, centroid, n, radius): the sub-clusters of radius <= threshold, numbered 0..m-1.

    ``start`` are the ``distinct_points``, where they were made before.  They are numbered by size,
    then by their points' sum of squared lengths.
    """
    start = start or Start(distinct_points(points, key, vec), max_bytes)
    features, held = start.features, None
    if start.rows > group_rows:
        held = start.held()
        while held.rows > group_rows and (merged := _round(held, threshold, max_bytes)) is not None:
            held = merged
        features = held.frame().select("cluster_id", "n", "sse", "centroid")
    if held is None or held.rows <= group_rows:
        features = written(_finished(features, threshold), "features")
    squares = F.col("sse") + F.col("n") * F.aggregate("centroid", F.lit(0.0), lambda acc, x: acc + x * x)
    numbered = rank_within(features.withColumn("_ss", squares), [], [F.desc("n"), "_ss", "cluster_id"], "_rn")
    return numbered.select(
        (F.col("_rn") - 1).cast("int").alias("cluster_id"), "centroid", "n", F.sqrt(F.col("sse") / F.col("n")).alias("radius")
    )


def threshold_clusters(
    points: DataFrame,
    threshold: float,
    key: str = "row_id",
    vec: str = "embedding",
    max_bytes: int = MAX_BROADCAST_BYTES,
    **options,
) -> DataFrame:
    """(key, cluster_id, d2): every point with the nearest sub-cluster."""
    centroids = written(threshold_centroids(points, threshold, key, vec, max_bytes=max_bytes, **options), "subclusters")
    return assign_nearest(points, centroids, key, vec, max_bytes)


def cluster_number(centroids: DataFrame) -> int:
    return centroids.count()


def threshold_search(
    points: DataFrame,
    target: int,
    threshold: float = 0.25,
    min_threshold: float = 1e-6,
    decay: float = 0.5,
    attempts: int = 8,
    key: str = "row_id",
    vec: str = "embedding",
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lower the threshold until at least ``target`` sub-clusters come out.

    Returns (log, centroids, assignment); the log holds one row per attempt.  The search ends when
    the target, the lowest threshold or the last attempt is reached.
    """
    rows, current = [], threshold
    start = Start(distinct_points(points, key, vec), options.get("max_bytes", MAX_BROADCAST_BYTES))
    while True:
        centroids = written(threshold_centroids(points, current, key, vec, start=start, **options), "subclusters")
        found = cluster_number(centroids)
        rows.append((len(rows) + 1, float(current), found))
        if found >= target or current <= min_threshold or len(rows) >= attempts:
            break
        current = max(current * decay, min_threshold)
    log = points.sparkSession.createDataFrame(rows, "attempt int, threshold double, n_clusters bigint")
    return log, centroids, assign_nearest(points, centroids, key, vec)


def threshold_sweep(
    sample: DataFrame, thresholds: Sequence[float], key: str = "row_id", vec: str = "embedding", **options
) -> DataFrame:
    """(threshold, n_clusters) per threshold, ending with the first that leaves one cluster."""
    sample = written(sample.select(key, vec), "sample")
    start = Start(distinct_points(sample, key, vec), options.get("max_bytes", MAX_BROADCAST_BYTES))
    rows = []
    for threshold in thresholds:
        found = cluster_number(threshold_centroids(sample, float(threshold), key, vec, start=start, **options))
        rows.append((float(threshold), found))
        if found == 1:
            break
    return sample.sparkSession.createDataFrame(rows, "threshold double, n_clusters bigint")
