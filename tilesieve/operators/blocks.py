"""Bounded broadcast blocks of a vector table, and the array helpers used inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import MAX_BROADCAST_BYTES, scratch_path, written

# Vectors of a stored block, and points of a chunk that meets all stored blocks, that a task holds.
STORED_BYTES = 64 * 1024 * 1024
CHUNK_BYTES = 64 * 1024 * 1024


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column without nulls as a (rows, dims) float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if rows and len(set(np.diff(column.offsets.to_numpy()).tolist())) > 1:
        raise ValueError("vectors of different lengths in one column")
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(rows, -1) if rows else np.empty((0, 0))


def list_array(values: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    """A (rows, dims) matrix as an Arrow list column."""
    rows, dims = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dims)
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1), kind))


def sized(df: DataFrame, vec: str) -> tuple[int, int]:
    """(rows, dimensions) of a vector table."""
    row = df.agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
    return int(row[0]), int(row[1] or 0)


def rows_per_block(dims: int, max_bytes: int = MAX_BROADCAST_BYTES) -> int:
    return max(1, max_bytes // (8 * dims + 8))


@dataclass(frozen=True)
class Block:
    """One broadcast piece: ``value`` is (ids, matrix), ordered by id."""

    data: Broadcast
    rows: int

    @classmethod
    def of(cls, spark: SparkSession, ids: np.ndarray, values: np.ndarray, distinct: bool = False) -> Block:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        if distinct:
            keep = np.sort(np.unique(values, axis=0, return_index=True)[1])
            ids, values = ids[keep], values[keep]
        return cls(spark.sparkContext.broadcast((ids, values)), len(ids))


def loaded(df: DataFrame, key: str, vec: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of a vector table whose size is known to be bounded."""
    table = df.select(F.col(key).cast("bigint").alias("k"), F.col(vec).cast("array<double>").alias("v")).toArrow()
    return table["k"].to_numpy(), matrix(table["v"])


def vector_blocks(
    df: DataFrame, key: str, vec: str, max_bytes: int = MAX_BROADCAST_BYTES, distinct: bool = False
) -> list[Block]:
    """Split a vector table into broadcast blocks of at most ``max_bytes`` each.

    One block at a time passes through the driver.  Rows are dealt to blocks by a hash of the key
    and the split is refined until every block is below the bound.
    """
    spark = df.sparkSession
    n, dims = sized(df, vec)
    if n == 0:
        return []
    limit = rows_per_block(dims, max_bytes)
    if n <= limit:
        return [Block.of(spark, *loaded(df, key, vec), distinct)]
    df = written(df.select(key, vec), "blocks")
    pieces = -(-n // limit)
    while True:
        bucket = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(pieces))
        if df.groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0] <= limit:
            break
        pieces = pieces + max(1, pieces // 4)
    blocks = []
    for b in range(pieces):
        ids, values = loaded(df.filter(bucket == b), key, vec)
        if len(ids):
            blocks.append(Block.of(spark, ids, values, distinct))
    return blocks


def stored_blocks(df: DataFrame, key: str, vec: str, max_bytes: int = STORED_BYTES, distinct: bool = False, by: str | None = None) -> list[str]:
    """The files of a written copy of a vector table, none with more than ``max_bytes`` of vectors.

    Rows with the same value of ``by`` share files of their own, where it is given.

    Tasks read them with ``stored_block``; only their names come to the driver.  Of equal vectors
    ``distinct`` keeps that of the smallest key.
    """
    n, dims = sized(df, vec)
    limit = rows_per_block(dims, max_bytes)
    group = (F.lit(0) if by is None else F.col(by)).cast("int").alias("g")
    held = df.select(group, F.col(key).cast("bigint").alias("k"), F.col(vec).cast("array<double>").alias("v"))
    if distinct:
        held = held.groupBy("v").agg(F.min("k").alias("k"), F.min("g").alias("g")).select("g", "k", "v")
    path = scratch_path(df.sparkSession, "blocks")
    pieces = max(1, -(-n // limit))
    if by is None:
        held.drop("g").repartition(pieces, "k").write.option("maxRecordsPerFile", limit).parquet(path)
    else:
        held.repartition(pieces, "g").write.option("maxRecordsPerFile", limit).partitionBy("g").parquet(path)
    return df.sparkSession.read.schema("k bigint, v array<double>").parquet(path).inputFiles()


def stored_block(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of one file of ``stored_blocks``, ordered by id."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    where, name = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    table = pq.read_table(name, filesystem=where, partitioning=None)
    ids = table["k"].to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix(table["v"])[order]


def in_chunks(batches: Iterator[pa.RecordBatch], max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``max_bytes``, put together from smaller ones; none is empty."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.nbytes for b in held) >= max_bytes:
                yield _together(held)
                held = []
    if held:
        yield _together(held)


def _together(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
