"""Quality scores by a regularised quadratic discriminant over transformed document statistics.

Every whole text gives a vector of statistics, transformed towards a normal shape.  Both classes
are described by their mean and a covariance that is shrunk towards the pooled one and its
diagonal.  The score is the logistic function of the difference of the classes' log densities,
each from a Mahalanobis distance by the cached Cholesky factor of its covariance.

The fit takes sums over all labelled rows, inside the tasks, and holds nothing else.

Null text counts as empty and has a score.  Labels: rows whose quality is neither 0 nor 1 or whose
id is null are left out; a label given twice counts twice.  Without labels of both classes every
score is 0.5.  Other columns pass ``keep_good`` untouched.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, slices, texts_of

# Weight of the pooled covariance in each class's, and of its diagonal in the result.
POOLED, DIAGONAL = 0.1, 0.05
# Log-density differences are divided by this before the logistic function: statistics are correlated.
TEMPERATURE = 8.0

# Classes of bytes: lower, upper, digit, white space, line end, stop or comma, other ASCII mark, beyond ASCII.
_KIND = np.full(256, 7, np.uint8)
_KIND[:128] = 6
for _first, _last, _kind in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (0, 32, 3)):
    _KIND[_first : _last + 1] = _kind
_KIND[10] = 4
_KIND[[44, 46]] = 5

NAMES = (
    "length words word_length upper digits marks stops beyond lines line_length distinct "
    "repeated_words repeated_lines longest marked_words"
).split()


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``NAMES``; all are finite."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    lower, upper, digit, _, ends, stops, marks, beyond = np.bincount(_KIND[data], minlength=8).tolist()
    words = text.split()
    n, w = len(data) + 1, len(words) + 1
    lines = text.split("\n")
    letters = lower + upper + beyond + 1
    same = sum(map(operator.eq, words, words[1:]))
    marked = sum(1 for x in words if not x[-1].isalnum() and x[-1] not in ".,")
    return [
        np.log(n),
        np.log(w),
        np.log((n - w) / w + 1),
        np.sqrt(upper / letters),
        np.sqrt(digit / n),
        np.sqrt(marks / n),
        np.sqrt(stops / w),
        np.sqrt(beyond / n),
        np.log(ends + 1),
        np.log(n / (ends + 1)),
        np.log(len(set(words)) + 1) / np.log(w + 1),
        np.sqrt(same / w),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.log(max(map(len, words), default=0) + 1),
        np.sqrt(marked / w),
    ]


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors and constants of the classes 0 and 1; empty where a class had no rows."""

    mean: np.ndarray
    factor: np.ndarray
    constant: np.ndarray

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included."""
        if not len(self.mean):
            return np.zeros(len(x))
        density = []
        for mean, factor, constant in zip(self.mean, self.factor, self.constant):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(constant - 0.5 * np.einsum("ij,ij->j", z, z))
        return density[1] - density[0]

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        d = self.difference(np.array([statistics(t) for t in texts])) / TEMPERATURE
        return 1.0 / (1.0 + np.exp(-np.clip(d, -700, 700)))


def from_sums(n: np.ndarray, total: np.ndarray, outer: np.ndarray, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Model:
    """The model from each class's count, sum and sum of outer products."""
    if (n < 1).any():
        return Model(np.zeros((0,)), np.zeros((0,)), np.zeros((0,)))
    mean = total / n[:, None]
    own = outer / n[:, None, None] - np.einsum("ci,cj->cij", mean, mean)
    both = np.einsum("c,cij->ij", n / n.sum(), own)
    factors, constants = [], []
    for c in range(2):
        cov = (1 - pooled) * own[c] + pooled * both
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        factors.append(factor)
        constants.append(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum())
    return Model(mean, np.array(factors), np.array(constants))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> Model:
    """Fit on all rows of ``docs`` that have a label; texts are read once and not shuffled."""
    d = len(NAMES)
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches):
        for batch in slices(batches):
            found = [statistics(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], names=["_id", "_x"])

    def add_up(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            y = batch.column(0).to_numpy()
            for c in range(2):
                z = x[y == c]
                total[c] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["_at", "_v"])

    given = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
    given = given.filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1))
    measured = bounded(docs).filter(F.col(id_col).isNotNull()).select(id_col, "text").mapInArrow(measure, f"_id {kind}, _x array<double>")
    # A join by sorting ends the measuring tasks before the sums begin: one Python process per core, not two.
    parts = measured.join(given.hint("merge"), "_id").select("_y", "_x").mapInArrow(add_up, "_at bigint, _v double")
    sums = np.zeros(2 * (1 + d + d * d))
    for at, value in parts.groupBy("_at").agg(F.sum("_v")).collect():  # as many rows as the model has sums
        sums[at] = value
    n, total, outer = np.split(sums.reshape(2, -1), [1, 1 + d], axis=1)
    return from_sums(n[:, 0], total, outer.reshape(2, d, d))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id, score, predicted) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            s = model.score(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[id_col, "score", "predicted"]
            )

    return bounded(docs).select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, least: float = 0.02) -> DataFrame:
    """The rows, with all their columns, whose score is at least ``least``."""

    def run(batches):
        for batch in slices(batches):
            yield batch.filter(pa.array(model.score(texts_of(batch)) >= least))

    return bounded(docs).mapInArrow(run, docs.schema)
