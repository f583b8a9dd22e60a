"""Hard negatives by angular triangle filtering.

A vector becomes integers, floor(``scale`` * x), and a row's score is its integer inner product with
an anchor.  Every row is stored with its norm and its angles to a few reference directions.  For two
vectors whose angles to a reference are p and q, their own angle lies between |p - q| and
min(p + q, 2 pi - p - q); over all references this gives an interval of cosines, which times both
norms, widened by more than what rounding can cost, bounds the score from both sides.  Only pairs
whose bounds overlap the window of wanted scores are scored, in exact integer arithmetic; whole
batches are passed over where even their smallest and largest angles rule them out.

Two passes over the rows: the first finds each anchor's best rows of its own label (its positives),
the second the best rows of other labels between ``least`` per cent and all of a positive's score.
The window of a pass narrows as better rows are found.  Anchors go to the tasks in blocks of
``BLOCK_BYTES``, one job per block; each task returns its best rows per anchor, and these are ranked.

The references are chosen from ``SAMPLE`` rows, each farthest from those before; they decide how many
pairs are scored, never the result.

Rows with a null id or label, a null vector or a component that is null or not finite take no part;
a shorter vector counts as filled up with zeros.  Ties go to the smaller id.  Rows that repeat an
id are rows of their own, never partners of each other.  Where a score might not fit 64 bits the job
stops with an error.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

SCALE, POSITIVES, NEGATIVES, LEAST = 256, 5, 5, 80
# Rows that references are chosen from, and their number.
SAMPLE, REFERENCES = 1_000, 8
# Anchors of one job; anchors whose bounds a task computes at once; rows of a batch.
BLOCK_BYTES, AT_ONCE, BATCH = 16 * 1024 * 1024, 64, 2_048
# Radians by which angles are widened: more than arc cosines lose near 0 and pi.
SLACK = 1e-7
# Beyond every score.
ANYTHING = 1 << 62


def eligible(vector: str = "embedding", label: str = "label", id_col: str = "vec_id") -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.coalesce(sound, F.lit(False))


def references(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Unit vectors out of a sample, each farthest from those before it."""
    norms = np.linalg.norm(sample, axis=1)
    unit = sample[norms > 0] / norms[norms > 0, None]
    if not len(unit):
        return np.zeros((0, sample.shape[1]))
    chosen, near = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles(vectors: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to each direction; those of the zero vector, whose score is always 0, are 0."""
    norms = np.linalg.norm(vectors, axis=1)
    cosine = np.divide(vectors @ directions.T, norms[:, None], out=np.ones((len(vectors), len(directions))), where=norms[:, None] > 0)
    return norms, np.arccos(np.clip(cosine, -1, 1))


def score_bounds(norm_a: np.ndarray, angle_a: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (rows of the result) with rows, or with batches of rows.

    ``low`` and ``high`` are the smallest and largest angles, ``least`` and ``most`` the norms; for a
    single row both are the same.
    """
    nearest = np.zeros((len(norm_a), len(least)))
    farthest = np.full(nearest.shape, np.pi)
    for r in range(angle_a.shape[1]):
        own = angle_a[:, r, None]
        np.maximum(nearest, np.maximum(own - high[None, :, r], low[None, :, r] - own), out=nearest)
        np.minimum(farthest, np.minimum(own + high[None, :, r], 2 * np.pi - own - low[None, :, r]), out=farthest)
    top, bottom = np.cos(np.maximum(nearest - SLACK, 0)), np.cos(np.minimum(farthest + SLACK, np.pi))
    large = norm_a[:, None] * most[None, :]
    small = norm_a[:, None] * least[None, :]
    slack = large * 1e-9 + 0.5  # scores are whole numbers
    return np.minimum(bottom * large, bottom * small) - slack, np.maximum(top * large, top * small) + slack


def exact_scores(rows: np.ndarray, anchor: np.ndarray, norms: float) -> np.ndarray:
    """Integer inner products; ``norms`` bounds them and, by Cauchy and Schwarz, all sums on the way."""
    if norms < 1 << 52:
        return (rows @ anchor).astype(np.int64)  # whole numbers that doubles hold exactly
    if norms < ANYTHING:
        return rows.astype(np.int64) @ anchor.astype(np.int64)
    raise OverflowError("a score might not fit 64 bits")


class Best:
    """The best ``n`` (score, id) found so far, highest score first and smallest id among equals."""

    def __init__(self, n: int, low: int, high: int) -> None:
        self.n, self.low, self.high = n, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.low) & (scores <= self.high)
        if not fit.any():
            return
        scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((ids, -scores))[: self.n]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.n:
            self.low = max(self.low, int(self.scores[-1]))


def stored(points: DataFrame, vector: str = "embedding", label: str = "label", id_col: str = "vec_id", scale: int = SCALE, n_references: int = REFERENCES) -> DataFrame:
    """(id, label, whole, norm, angles) of the rows that take part, written; ``whole`` are integers as doubles."""
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * scale)
    # Doubles from 2^52 on are whole already.
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    sound = points.filter(eligible(vector, label, id_col))
    own = written(sound.select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("whole")), "vectors")
    width = own.agg(F.max(F.size("whole"))).first()[0] or 0
    sample = own.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("whole").collect()
    directions = references(_matrix([r.whole for r in sample], width), n_references)

    def run(batches):
        for batch in batches:
            vectors = _matrix(batch.column(2).to_pylist(), width)
            norms, found = angles(vectors, directions)
            columns = [pa.array(list(a), pa.list_(pa.float64())) for a in (vectors, found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), columns[0], pa.array(norms), columns[1]], names=["id", "label", "whole", "norm", "angles"])

    return written(own.mapInArrow(run, "id bigint, label bigint, whole array<double>, norm double, angles array<double>"), "angles")


def _matrix(rows: list, width: int) -> np.ndarray:
    filled = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        filled[i, : len(row)] = row
    return filled


def _wide(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _search(rows: DataFrame, block: list, same_label: bool, n: int) -> DataFrame:
    """(anchor, place, id, score): every task's best ``n`` rows for each window of each anchor of a block.

    The block has rows (anchor, id, label, whole, norm, angles, windows), a window being (low, high).
    """
    spark = rows.sparkSession
    shipped = spark.sparkContext.broadcast(
        (
            np.array([r.anchor for r in block], np.int64),
            np.array([r.id for r in block], np.int64),
            np.array([r.label for r in block], np.int64),
            np.array([r.whole for r in block], float).reshape(len(block), -1),
            np.array([r.norm for r in block], float),
            np.array([r.angles for r in block], float).reshape(len(block), -1),
            [r.windows for r in block],
        )
    )

    def run(batches):
        number, own_id, own_label, own, norm_a, angle_a, windows = shipped.value
        best = [[Best(n, low, high) for low, high in w] for w in windows]

        def visit(ids, label, vectors, norms, held):
            most, least = norms.max(), norms.min()
            if norm_a.max() * most >= ANYTHING:
                raise OverflowError("a score might not fit 64 bits")
            at_all = score_bounds(norm_a, angle_a, held.min(axis=0)[None], held.max(axis=0)[None], np.array([least]), np.array([most]))
            low = np.array([min((b.low for b in w), default=np.inf) for w in best], float)
            high = np.array([max((b.high for b in w), default=-np.inf) for w in best], float)
            open_to = np.flatnonzero((at_all[1][:, 0] >= low) & (at_all[0][:, 0] <= high))
            for at in range(0, len(open_to), AT_ONCE):
                some = open_to[at : at + AT_ONCE]
                bottom, top = score_bounds(norm_a[some], angle_a[some], held, held, norms, norms)
                fits = (label[None] == own_label[some, None]) == same_label
                fits &= ids[None] != own_id[some, None]
                overlap = np.zeros(fits.shape, bool)
                for k, a in enumerate(some.tolist()):
                    for b in best[a]:
                        overlap[k] |= (top[k] >= b.low) & (bottom[k] <= b.high)
                overlap &= fits
                for k, a in enumerate(some.tolist()):
                    chosen = np.flatnonzero(overlap[k])
                    if len(chosen):
                        scores = exact_scores(vectors[chosen], own[a], norm_a[a] * most)
                        for b in best[a]:
                            b.offer(scores, ids[chosen])

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                k = part.num_rows
                ids, label, norms = (part.column(i).to_numpy() for i in (0, 1, 3))
                visit(ids, label, _wide(part.column(2), k), norms, _wide(part.column(4), k))
        out = [(number[a], p, i, s) for a, w in enumerate(best) for p, b in enumerate(w) for i, s in zip(b.ids.tolist(), b.scores.tolist())]
        columns = list(zip(*out)) or [()] * 4
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["anchor", "place", "id", "score"])

    return rows.select("id", "label", "whole", "norm", "angles").mapInArrow(run, "anchor bigint, place int, id bigint, score bigint")


def _in_blocks(rows: DataFrame, anchors: DataFrame, same_label: bool, n: int, row_bytes: int, block_bytes: int) -> DataFrame:
    """What ``_search`` finds for all anchors; the driver holds one block at a time.

    Blocks are dealt by hash, so they hold ``block_bytes`` but for chance.
    """
    n_blocks = max(1, -(-anchors.count() * row_bytes // block_bytes))
    found = rows.sparkSession.createDataFrame([], "anchor bigint, place int, id bigint, score bigint")
    for k in range(n_blocks):
        block = anchors.filter(F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)) == k).collect()
        if block:
            found = found.unionByName(_search(rows, block, same_label, n))
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine(
    points: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    label: str = "label",
    id_col: str = "vec_id",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    scale: int = SCALE,
    n_references: int = REFERENCES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``.  A negative's score n and a positive's score p
    satisfy ``least`` * p <= 100 * n <= 100 * p.
    """
    rows = stored(points, vector, label, id_col, scale, n_references)
    anchors = written(rows.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    one = anchors.first()
    row_bytes = 16 * (len(one.whole) + n_references + 8) if one else 1

    anything = F.array(F.struct(F.lit(-ANYTHING).alias("low"), F.lit(ANYTHING).alias("high")))
    best = _in_blocks(rows, anchors.withColumn("windows", anything), True, positives, row_bytes, block_bytes)
    best = best.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = written(best, "positives")

    # The smallest whole number of at least ``least`` per cent of the positive's score.
    low = F.ceil(F.col("positive_score").cast("decimal(20,0)") * least / 100).cast("bigint")
    windows = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", low.alias("low"), F.col("positive_score").alias("high")))).alias("held"))
    windows = windows.select("anchor", F.transform("held", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))).alias("windows"))
    hard = _in_blocks(rows, written(anchors.join(windows, "anchor"), "windows"), False, negatives, row_bytes, block_bytes)
    named = anchors.select("anchor", F.col("id").alias("anchor_id"))
    hard = hard.select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = hard.join(best, ["anchor", "place"]).join(named, "anchor")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
