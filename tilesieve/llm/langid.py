"""Language identification by the nearest of several centroids per language.

A text is the vector of its hashed byte trigrams (letters lower-cased, everything else in ASCII a
space), weighted by square root of the count times inverse document frequency, of length one.
Document frequencies are counted over all learning rows.  The vectors of each language, of at
most ``sample`` rows with the smallest hashes, are clustered by cosine; a text gets the language
of the nearest centroid.  Each centroid has a radius, and a text farther than that from its
nearest one is rejected.

A text that is null or has no letter is ``und`` with score 0 and is rejected.  Rows without
language, and rows of ``und`` texts, are not learned from; without any learned language every
text is ``und``.  Ties go to the smaller language, then to the earlier centroid.  Other columns
pass ``keep_known`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import bounded, slices, texts_of

DIMS = 4096
# Learning rows per language for the centroids, centroids per language, rounds of clustering.
SAMPLE, CENTROIDS, ROUNDS = 1_000, 4, 8
# The radius of a language's centroids: this quantile of its cosine distances times a slack, below a bound.
QUANTILE, SLACK, FARTHEST = 0.99, 1.3, 0.93
UNKNOWN = "und"
# Texts of a task whose vectors are held at a time.
ROWS = 64

_LETTER = np.arange(256, dtype=np.uint32)
_LETTER[[i for i in range(128) if not chr(i).isalpha()]] = 32


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def counts(texts: list[str]) -> np.ndarray:
    """One row of hashed trigram counts per text."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, text in enumerate(texts):
        b = _LETTER[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
        if len(b) > 2:
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            kept = code[code != 0x202020]
            slot = (kept * np.uint32(2654435761)) >> np.uint32(20)
            out[row] = np.bincount(slot, minlength=DIMS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(length > 0, length, 1)[:, None]


@dataclass(frozen=True)
class Model:
    """Weights per dimension; centroids with their language and radius, ordered by language."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    radius: np.ndarray

    def vectors(self, texts: list[str]) -> np.ndarray:
        return _unit(np.sqrt(counts(texts)) * self.idf)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is accepted, of each text."""
        known = np.array([bool(t) and has_letter(t) for t in texts], bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        cosine = self.vectors([t or "" for t in texts]) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best].astype(float), 0, 1)
        accepted = known & (1 - score <= self.radius[best])
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0), accepted


def cluster(x: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and radii of unit vectors by cosine, started from rows spread evenly by their nearness to the mean."""
    order = np.argsort(x @ _unit(x.mean(axis=0, keepdims=True))[0], kind="stable")
    centroids = x[order[np.unique((np.arange(1, k + 1) * len(x)) // (k + 1))]]
    for _ in range(rounds):
        label = (x @ centroids.T).argmax(axis=1)
        centroids = _unit(np.array([x[label == c].mean(axis=0) if (label == c).any() else centroids[c] for c in range(len(centroids))]))
    distance = 1 - (x @ centroids.T).max(axis=1)
    radius = min(float(np.quantile(distance, QUANTILE)) * SLACK, FARTHEST)
    return centroids, np.full(len(centroids), radius)


def fit(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS, id_col: str = "doc_id", lang: str = "lang") -> Model:
    """Learn from all rows with a language: frequencies from every one, centroids from a bounded sample."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull())

    def frequencies(batches):
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in slices(batches, ROWS):
            texts = [t for t in texts_of(batch) if has_letter(t)]
            total += (counts(texts) > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(np.append(total, n))], names=["_at", "_n"])

    seen = np.zeros(DIMS + 1)
    # One row per dimension.
    for at, n in bounded(rows).select("text").mapInArrow(frequencies, "_at bigint, _n bigint").groupBy("_at").agg(F.sum("_n")).collect():
        seen[at] = n
    idf = (np.log((1 + seen[DIMS]) / (1 + seen[:DIMS])) + 1).astype(np.float32)

    def centroids(group: pa.Table) -> pa.Table:
        texts = [t for t in group["text"].to_pylist() if has_letter(t)]
        if not texts:
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.list_(pa.float32())), "radius": pa.array([], pa.float64())})
        found, radius = cluster(_unit(np.sqrt(counts(texts)) * idf), k)
        name = group["lang"][0].as_py()
        return pa.table(
            {"lang": [name] * len(found), "centroid": pa.array(list(found), pa.list_(pa.float32())), "radius": pa.array(radius, pa.float64())}
        )

    # Rows whose hash lies below a bound, set so that about twice the sample does; of these the smallest hashes.
    # Only those rows are shuffled, however many tasks and rows there are.
    sizes = rows.groupBy(F.col(lang).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("_rows"))
    bounds = sizes.select("lang", (F.lit(2.0 * sample) / F.col("_rows")).alias("_share"))  # one row per language
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit(42)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    drawn = rows.select(id_col, F.col(lang).cast("string").alias("lang"), "text", chance.alias("_chance"))
    drawn = drawn.join(F.broadcast(bounds), "lang").filter(F.col("_chance") < F.col("_share"))
    chosen = (
        drawn.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_chance", id_col)))
        .filter(F.col("_rank") <= sample)
        .select("lang", "text")
    )
    # At most k rows per language.
    found = chosen.groupBy("lang").applyInArrow(centroids, "lang string, centroid array<float>, radius double").collect()
    found.sort(key=lambda r: r["lang"])
    matrix = np.array([r["centroid"] for r in found], np.float32).reshape(-1, DIMS)
    return Model(idf, matrix, [r["lang"] for r in found], np.array([r["radius"] for r in found]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, accepted) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, ROWS):
            texts = batch.column(1).to_pylist()
            names, score, accepted = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(accepted)],
                names=[id_col, "lang_pred", "score", "accepted"],
            )

    return bounded(docs).select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, accepted boolean")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, with all their columns, whose language is accepted."""

    def run(batches):
        for batch in slices(batches, ROWS):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(model.predict(texts)[2]))

    return bounded(docs).mapInArrow(run, docs.schema)
