"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows of an Arrow batch that a task works on together; bounds its scratch memory.
SLICE_ROWS = 256
# Rows of texts that are sent to a Python process in one batch.
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(doc_id: str = "doc_id") -> Column:
    """True for ids whose crc32 (of the id as text) leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def process_state() -> dict:
    """A dictionary that lives as long as the Python process.

    The package's functions travel with the tasks by value, so module globals start afresh with
    every task; what is costly to load (a tokenizer) is kept here instead.
    """
    return sys.modules.setdefault("_tilesieve_process", types.ModuleType("_tilesieve_process")).__dict__


def bounded(rows: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The same rows, in a session whose Arrow batches hold at most ``batch_rows``.

    Texts are kilobytes per row: a batch of the usual 10,000 rows takes as much memory several times
    over, in the executor and in each of its Python processes.
    """
    conf = rows.sparkSession.conf
    now = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < now <= batch_rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    return rows


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, without copying; empty ones are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The strings of a column, null as the empty string."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]
