"""Starting centres that lie far from each other, drawn in few passes over the points.

A pass measures every point to the centres drawn since the last pass only, and draws a point with a
probability in proportion to its squared distance to the nearest centre so far, about
``OVERSAMPLING`` x k points a pass.  The candidates are weighted with the points nearest to them, and
k of them are chosen in the same way: about k / ``REFINE`` a round, without replacement, by weight
times squared distance; so k up to ``REFINE`` are chosen one at a time.

Draws are fixed by md5(key-seed-round), so a start can be repeated.  A state table (key, vector,
weight, distance, nearest centre) is written once a pass; no point is shuffled, and what is broadcast
is one block of new centres.  Where fewer than k different points exist, rows drawn at random fill
up the rest.  Keys are distinct; rows with null vectors have to be left out before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import MAX_BROADCAST_BYTES, written
from .blocks import matrix
from .nearest import Centroids
from .ranking import rank_within
from .sampling import BROADCAST_KEYS, sample_exact, shuffle_key

PASSES, OVERSAMPLING, REFINE = 5, 2, 16
# Hexadecimal digits of a draw: as many bits as a double holds.
_DIGITS = 13

_STATE = "k bigint, v array<double>, weight double, d2 double, near bigint"


def _exponential(seed: int, turn: int) -> Column:
    """An exponential variate of each row: the smallest of those divided by w is drawn with probability w / sum of w."""
    digest = F.md5(F.concat_ws("-", F.col("k").cast("string"), F.lit(str(seed)), F.lit(str(turn))))
    return -F.log((F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / F.lit(float(16**_DIGITS)))


def _fresh(rows: DataFrame, weight: Column) -> DataFrame:
    """Rows that no centre has been measured to yet."""
    return written(rows.select("k", "v", weight.cast("double").alias("weight"), F.lit(float("inf")).alias("d2"), F.lit(-1).cast("bigint").alias("near")), "start")


def _measured(state: DataFrame, chosen: DataFrame, max_bytes: int) -> DataFrame:
    """The state after the rows ``chosen`` have become centres, too; of equal distances the earlier centre counts."""
    centres = Centroids.of(chosen.select(F.col("k").alias("cluster_id"), F.col("v").alias("centroid")), max_bytes)

    def run(batches):
        find = centres.finder()
        for batch in centres.chunks(batches):
            label, d2 = find(matrix(batch.column(1)))
            was, near = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            nearer = d2 < was
            columns = [*batch.columns[:3], pa.array(np.where(nearer, d2, was)), pa.array(np.where(nearer, label, near))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    after = written(state.mapInArrow(run, _STATE), "start")
    centres.release()
    return after


def _lowest(rows: DataFrame, by: Column, n: int) -> DataFrame:
    """(k, draw): the n rows with the smallest draws."""
    return rows.select("k", by.alias("draw")).orderBy("draw", "k").limit(n)


def _rows_of(state: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    return state.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, "k")


def candidates(rows: DataFrame, k: int, seed: int, max_bytes: int, passes: int = PASSES) -> DataFrame:
    """(k, v, weight) of the drawn rows, weighted with the rows nearest to them; equal rows are drawn once."""
    state = _fresh(rows, F.lit(1.0))
    chosen = _rows_of(state, _lowest(state, _exponential(seed, 0), 1), 1)
    state = _measured(state, chosen, max_bytes)
    for turn in range(1, passes + 1):
        total = state.agg(F.sum("d2")).first()[0]
        if not total:
            break
        drawn = _exponential(seed, turn) * F.lit(total) < F.lit(float(OVERSAMPLING * k)) * F.col("d2")
        chosen = written(state.filter(drawn).select("k", "v"), "drawn")
        if not chosen.isEmpty():
            state = _measured(state, chosen, max_bytes)
    weights = state.groupBy("near").agg(F.sum("weight").alias("weight"))
    own = state.filter(F.col("near") == F.col("k")).select("k", "v")
    return own.join(weights.withColumnRenamed("near", "k"), "k")


def chosen_far(weighted: DataFrame, k: int, seed: int, max_bytes: int) -> DataFrame:
    """(k, turn, draw): at most k of the weighted rows, fewer only where fewer are different."""
    state = _fresh(weighted, F.col("weight"))
    parts, have, turn = [], 0, PASSES + 1
    while have < k:
        want = 1 if have == 0 else min(-(-k // REFINE), k - have)
        share = F.col("weight") if have == 0 else F.col("weight") * F.col("d2")
        keys = written(_lowest(state.filter(F.col("d2") > 0), _exponential(seed, turn) / share, want), "drawn")
        found = keys.count()
        if not found:
            break
        parts.append(keys.withColumn("turn", F.lit(turn)))
        have, turn = have + found, turn + 1
        if have < k:
            state = _measured(state, _rows_of(state, keys, want), max_bytes)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def oversampled_start(points: DataFrame, k: int, seed: int = 42, key: str = "row_id", vec: str = "embedding", max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(cluster_id, centroid): k rows that lie far from each other, numbered 0..k-1 as they were chosen."""
    rows = points.select(F.col(key).cast("bigint").alias("k"), F.col(vec).cast("array<double>").alias("v"))
    keys = chosen_far(candidates(rows, k, seed, max_bytes), k, seed, max_bytes)
    missing = k - keys.count()
    if missing:
        rest = rows.select("k").join(keys.select("k"), "k", "left_anti")
        filled = sample_exact(rest, missing, "k", seed).select("k", F.lit(0.0).alias("draw"), F.lit(np.iinfo(np.int32).max).alias("turn"))
        keys = keys.unionByName(filled)
    numbered = rank_within(written(keys, "chosen"), [], ["turn", "draw", shuffle_key("k", seed), "k"], "_rn", size=k)
    return _rows_of(rows, numbered, k).select((F.col("_rn") - 1).cast("int").alias("cluster_id"), F.col("v").alias("centroid"))
