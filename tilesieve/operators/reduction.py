"""Principal components with Spark ML; projection as one map over the points."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from .blocks import list_array, matrix, sized
from .sampling import sample_exact


def fit_pca(df: DataFrame, k: int, vec: str = "embedding") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, components (dims, k), explained variance shares).

    Spark ML adds up the covariance (dims x dims) on the executors.  The sign of a component is
    fixed so that its largest absolute loading is positive.
    """
    data = df.filter(F.col(vec).isNotNull()).select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="reduced").fit(data)
    mean = data.select(Summarizer.mean(F.col("features"))).first()[0].toArray()
    loadings = model.pc.toArray()
    peak = loadings[np.argmax(np.abs(loadings), axis=0), np.arange(loadings.shape[1])]
    return mean, loadings * np.where(peak < 0, -1.0, 1.0), model.explainedVariance.toArray()


def project(df: DataFrame, mean: np.ndarray, loadings: np.ndarray, vec: str = "embedding", key: str = "row_id") -> DataFrame:
    """(key, vec): the centred vectors in component space."""
    model = df.sparkSession.sparkContext.broadcast((mean, loadings))  # dims x k numbers

    def run(batches):
        centre, pc = model.value
        for batch in batches:
            if batch.num_rows:
                reduced = (matrix(batch.column(1)) - centre) @ pc
                yield pa.RecordBatch.from_arrays([batch.column(0), list_array(reduced)], names=[key, vec])

    kind = df.schema[key].dataType.simpleString()
    source = df.filter(F.col(vec).isNotNull()).select(key, vec)
    return source.mapInArrow(run, f"`{key}` {kind}, `{vec}` array<double>")


def pca_fit_transform(df: DataFrame, k: int, vec: str = "embedding", key: str = "row_id") -> tuple[DataFrame, float]:
    """Reduced vectors and the share of variance they explain."""
    mean, loadings, shares = fit_pca(df, k, vec)
    return project(df, mean, loadings, vec, key), float(shares.sum())


def pca_cumulative_variance(df: DataFrame, vec: str = "embedding") -> DataFrame:
    """(component, ratio, cumulative) for all min(dims, rows) components."""
    rows, dims = sized(df, vec)
    shares = fit_pca(df, min(dims, rows), vec)[2]
    table = df.sparkSession.createDataFrame(
        [(i + 1, float(r)) for i, r in enumerate(shares)], "component int, ratio double"
    )
    upto = Window.partitionBy(F.lit(0)).orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table.withColumn("cumulative", F.sum("ratio").over(upto))


def variance_marks(curve: DataFrame, at: int = 128, levels: tuple[float, ...] = (0.90, 0.95)) -> DataFrame:
    """One row: cumulative share at a component and the first component reaching every level."""
    firsts = [
        F.min(F.when(F.col("cumulative") >= level, F.col("component"))).alias(f"reach_{round(level * 100)}")
        for level in levels
    ]
    return curve.agg(F.max(F.when(F.col("component") == at, F.col("cumulative"))).alias(f"cumulative_{at}"), *firsts)


def minmax_scale(df: DataFrame, col: str, out: str = "scaled", eps: float = 1e-6) -> DataFrame:
    """(v - min) / (max - min + eps) over the table; both bounds are scalar subqueries."""
    low = df.select(F.min(col)).scalar()
    high = df.select(F.max(col)).scalar()
    return df.withColumn(out, (F.col(col) - low) / (high - low + F.lit(eps)))


def pca_scatter(df: DataFrame, max_samples: int | None = None, seed: int = 42, vec: str = "embedding", key: str = "row_id") -> DataFrame:
    """(key, pc1, pc2, pc3, color): four components of a capped sample, the fourth scaled to 0..1."""
    sample = df.select(key, vec) if max_samples is None else sample_exact(df.select(key, vec), max_samples, key, seed)
    reduced, _ = pca_fit_transform(sample, 4, vec, key)
    parts = reduced.select(key, *[F.col(vec)[i].alias(f"pc{i + 1}") for i in range(4)])
    return minmax_scale(parts, "pc4", "color").drop("pc4")
