"""Distances between all ordered pairs of a sample, counted inside the tasks.

A pair never becomes a row.  The vectors lie in files of bounded size, and a task reads the two files
of each of its pairs of files, measures every unordered pair once and passes on counts, gathered over
all its pairs of files; each stands for both orders.  Neither vectors nor distances pass through the
driver.  The work grows with the square of the sample, as all its distances are asked for; memory does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import written
from .blocks import STORED_BYTES, rows_per_block, sized, stored_block, stored_blocks
from .nearest import CELLS

# Points of either side that are measured at once, and the least number in a file.
SIDE, LEAST = 512, 512
# Pairs of files for each core, where files may be as small as that; tasks for each core.
PAIRS_PER_CORE, TASKS_PER_CORE = 8, 4
# Whole numbers that are counted in one array, and distances that a task holds before it passes them on.
DENSE, HELD = 1 << 22, 1 << 20
# Bits behind the first that distances are counted by, and distances that are counted by value at once.
FIRST, KEPT = 35, 1_000_000
# The percentiles that are reported.
PROFILE = (("min", 0.0), ("p5", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95), ("max", 1.0))
# Percentile to use for an aimed number of clusters.
RECOMMENDED = (("1k", 0.99), ("10k", 0.95), ("100k", 0.85), ("1M", 0.50))


def _files(sample: DataFrame, key: str, vec: str, max_bytes: int) -> list[str]:
    """The sample in files of at most ``max_bytes``, and enough of them that all cores have pairs of files."""
    sample = written(sample.filter(F.col(key).isNotNull() & F.col(vec).isNotNull()).select(key, vec), "sample")
    n, dims = sized(sample, vec)
    wanted = int((2 * PAIRS_PER_CORE * sample.sparkSession.sparkContext.defaultParallelism) ** 0.5)
    rows = min(rows_per_block(dims, max_bytes), max(LEAST, -(-n // wanted)))
    return stored_blocks(sample, key, vec, rows * (8 * dims + 8)) if n else []


def _squares(keys: np.ndarray, x: np.ndarray, ids: np.ndarray, c: np.ndarray, same: bool) -> Iterator[np.ndarray]:
    """Positive squared distances between the rows of x and c, a tile at a time; of one file (``same``) each pair once.

    Points with equal keys are no pair.  Pairs whose matrix-product distance is within rounding error
    of zero are measured directly.
    """
    x2, c2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", c, c)
    rows = np.column_stack([x, x2, np.ones(len(x))])
    table = np.column_stack([-2.0 * c, np.ones(len(c)), c2]).T.copy()
    repeated = len(np.unique(keys)) < len(keys) if same else bool(np.isin(keys, ids).any())
    stride = max(1, CELLS // c.shape[1]) if c.ndim == 2 and c.shape[1] else 1
    for lo in range(0, len(x), SIDE):
        for at in range(lo if same else 0, len(c), SIDE):
            d2 = rows[lo : lo + SIDE] @ table[:, at : at + SIDE]
            a, b = x2[lo : lo + SIDE], c2[at : at + SIDE]
            near = d2.min() <= 1e-6 * (a.max() + b.max())
            if near:
                row, col = np.nonzero(d2 <= 1e-6 * (a[:, None] + b[None, :]))
                for s in range(0, len(row), stride):
                    r, k = row[s : s + stride], col[s : s + stride]
                    diff = x[lo + r] - c[at + k]
                    d2[r, k] = np.einsum("ij,ij->i", diff, diff)
            if repeated:
                d2[keys[lo : lo + SIDE, None] == ids[None, at : at + SIDE]] = 0.0
            if same and at == lo:
                d2[np.tril_indices(len(d2))] = 0.0
            # Elsewhere all distances are positive.
            found = d2[d2 > 0] if near or repeated or (same and at == lo) else d2.reshape(-1)
            if len(found):
                yield found


def _each(spark: SparkSession, files: list[str], summarize: Callable[[Iterator[np.ndarray]], Iterator[tuple]]) -> DataFrame:
    """(value, n): what ``summarize`` makes of the squared distances of a task's pairs of files, summed, written."""
    # Pairs (a, b) with a <= b, numbered in the order of a and then b.
    first = np.concatenate([[0], np.cumsum(np.arange(len(files), 0, -1))])
    total = int(first[-1])

    def squares(numbers: Iterator[int]) -> Iterator[np.ndarray]:
        now, left = -1, None
        for number in numbers:
            a = int(np.searchsorted(first, number, side="right")) - 1
            b = a + int(number - first[a])
            if a != now:
                now, left = a, stored_block(files[a])
            right = left if a == b else stored_block(files[b])
            if len(left[0]) and len(right[0]):
                yield from _squares(*left, *right, a == b)

    def run(batches):
        numbers = (int(i) for batch in batches for i in batch.column(0).to_numpy())
        for value, n in summarize(squares(numbers)):
            # Either order of a pair counts.
            yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(2 * n.astype(np.int64))], names=["value", "n"])

    tasks = max(1, min(total, TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    counts = spark.range(0, total, 1, tasks).mapInArrow(run, "value bigint, n bigint")
    return written(counts.groupBy("value").agg(F.sum("n").alias("n")), "counts")


def _counted(numbers: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """How often whole numbers occur: in one array while they lie together, each by itself where they do not."""
    low, n = 0, np.zeros(0, np.int64)

    def taken():
        there = np.flatnonzero(n)
        return there + low, n[there]

    for values in numbers:
        least, most = int(values.min()), int(values.max())
        if most - least >= DENSE:
            yield np.unique(values, return_counts=True)
            continue
        start, end = (min(low, least), max(low + len(n), most + 1)) if len(n) else (least, most + 1)
        if end - start > DENSE:
            yield taken()
            start, end, n = least, most + 1, np.zeros(0, np.int64)
        if not len(n) or start < low or end > low + len(n):
            grown = np.zeros(end - start, np.int64)
            if len(n):
                grown[low - start : low - start + len(n)] = n
            low, n = start, grown
        found = np.bincount(values - least)
        n[least - low : least - low + len(found)] += found
    if len(n):
        yield taken()


def _listed(values: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """How often values occur that are few, or few different ones."""
    held, n, more = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def merged():
        every = np.concatenate([held, *more])
        weight = np.concatenate([n, np.ones(len(every) - len(held), np.int64)])
        order = np.argsort(every, kind="stable")
        every, weight = every[order], weight[order]
        start = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        return every[start], np.add.reduceat(weight, start)

    for part in values:
        more.append(part)
        if sum(map(len, more)) >= HELD:
            held, n = merged()
            more = []
            if len(held) >= HELD:
                yield held, n
                held, n = held[:0], n[:0]
    if len(held) or sum(map(len, more)):
        yield merged()


def pairwise_distances(
    sample: DataFrame,
    key: str = "row_id",
    vec: str = "embedding",
    digits: int = 4,
    max_bytes: int = STORED_BYTES,
) -> DataFrame:
    """(distance, n_pairs): positive Euclidean distances of all ordered pairs, rounded and counted."""
    spark, files = sample.sparkSession, _files(sample, key, vec, max_bytes)
    scale = 10**digits

    def steps(d2):
        d = np.sqrt(d2)
        d *= scale
        d += 0.5
        return d.astype(np.int64)

    counted = _each(spark, files, lambda tiles: _counted(map(steps, tiles)))
    return counted.select((F.col("value") / F.lit(float(scale))).alias("distance"), F.col("n").alias("n_pairs"))


def pair_percentiles(
    sample: DataFrame,
    probs: Sequence[float],
    key: str = "row_id",
    vec: str = "embedding",
    max_bytes: int = STORED_BYTES,
) -> list[float]:
    """Exact percentiles (linear interpolation) of the positive pair distances, in two passes over the pairs.

    The bits of positive doubles are in the order of their values, and squares in that of distances.
    The first pass counts squared distances by their first bits, the second lists, with all bits, those
    that share the first bits of a wanted rank.  Ranks are found in the written counts, by 16 bits at a
    time; what comes to the driver is at most 65,536 counts per wanted rank or ``KEPT`` ones, however
    large the sample.
    """
    spark, files = sample.sparkSession, _files(sample, key, vec, max_bytes)

    def narrowed(counts: DataFrame, unit: int, shift: int, above: int | None, at: dict) -> dict:
        """rank -> (part of ``shift``, number of distances below it) of counts by bits without the last ``unit``."""
        if above is not None:
            counts = counts.filter(F.shiftright("value", above - unit).isin(sorted({part for part, _ in at.values()})))
        found = counts.groupBy(F.shiftright("value", shift - unit).alias("part")).agg(F.sum("n").alias("n")).toArrow().sort_by("part")
        parts, sizes = found["part"].to_numpy(), found["n"].to_numpy()
        result = {}
        for rank, (part, below) in at.items():
            mine = np.arange(len(parts)) if above is None else np.flatnonzero(parts >> (above - shift) == part)
            reach = below + np.cumsum(sizes[mine])
            i = min(int(np.searchsorted(reach, rank, side="right")), len(mine) - 1)
            result[rank] = int(parts[mine[i]]), int(reach[i] - sizes[mine[i]])
        return result

    counts = _each(spark, files, lambda tiles: _counted(d2.view(np.int64) >> FIRST for d2 in tiles))
    total, lowest, highest = counts.agg(F.sum("n"), F.min("value"), F.max("value")).first()
    if not total:
        return [float("nan")] * len(probs)
    position = np.asarray(probs, dtype=float) * (total - 1)
    low, high = np.floor(position).astype(np.int64), np.ceil(position).astype(np.int64)
    at = {rank: (0, 0) for rank in np.unique(np.concatenate([low, high])).tolist()}
    at = narrowed(counts, FIRST, FIRST + 16, None, at)
    at = narrowed(counts, FIRST, FIRST, FIRST + 16, at)
    wanted = np.array(sorted({part for part, _ in at.values()}))

    def chosen(tiles):
        dense = highest - lowest < DENSE
        there = np.zeros(highest - lowest + 1 if dense else 0, bool)
        if dense:
            there[wanted - lowest] = True
        for d2 in tiles:
            bits = d2.view(np.int64)
            part = bits >> FIRST
            yield bits[there.take(part - lowest, mode="clip") if dense else np.isin(part, wanted)]

    counts = _each(spark, files, lambda tiles: _listed(chosen(tiles)))
    above, few = FIRST, counts.count() <= KEPT
    while above:
        shift = 0 if few else max(0, above - 16)
        at, above = narrowed(counts, 0, shift, above, at), shift
    value = {rank: float(np.sqrt(np.int64(part).view(np.float64))) for rank, (part, _) in at.items()}
    return [value[a] + (value[b] - value[a]) * float(p - a) for a, b, p in zip(low.tolist(), high.tolist(), position)]


def distance_profile(sample: DataFrame, **options) -> DataFrame:
    """(metric, distance): min, p5, p25, p50, p75, p95, max of the positive pair distances."""
    values = pair_percentiles(sample, [p for _, p in PROFILE], **options)
    rows = [(name, value) for (name, _), value in zip(PROFILE, values)]
    return sample.sparkSession.createDataFrame(rows, "metric string, distance double")


def recommend_thresholds(sample: DataFrame, **options) -> DataFrame:
    """(n_clusters, threshold): suggested clustering threshold for an aimed number of clusters."""
    values = pair_percentiles(sample, [p for _, p in RECOMMENDED], **options)
    rows = [(name, value) for (name, _), value in zip(RECOMMENDED, values)]
    return sample.sparkSession.createDataFrame(rows, "n_clusters string, threshold double")
