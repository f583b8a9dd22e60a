"""Harmonic packing of documents into sequences of a fixed number of tokens.

A document gives full sequences and a rest, which stays whole: rests of more than C/(k+1) and at most
C/k tokens are class k, and a bin of that class takes exactly k of them.  What such a bin then lacks is
cut off the front of the next document, so that one document a bin is cut and no bin is padded.  Every
task fills the bins of its own rows, class by class, without any shuffle; what its open bins hold at
the end is poured into full sequences and, of the last of them, sequences of a power of two, which
need no padding either.  There are about 2 * sqrt(C) classes and one open bin each in a task's memory.

Null text counts as empty: such a document is its end token alone.  Repeated rows are packed as
often as they come.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import bounded, slices, texts_of
from .wordbpe import WordBpe

CAPACITY = 2048
END = 1
# Sequences of a task are numbered from its partition's number times this.
STRIDE = 1 << 33
# Pieces of closed sequences that a task holds before it hands them on.
HELD = 1024

_FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("sequence_tokens", pa.int64()),
]


def powers(tokens: int) -> list[int]:
    """The powers of two that add up to a number, largest first."""
    return [1 << b for b in reversed(range(tokens.bit_length())) if tokens >> b & 1]


class Bins:
    """The open bins of one task, one per class; a piece is (document, start, length, ids, tokens of its document)."""

    def __init__(self, first: int, capacity: int) -> None:
        self.next, self.capacity = first, capacity
        self.open: dict[int, list[tuple]] = {}
        # The bin that has its count of rests but lacks tokens; there is one at most.
        self.short: list[tuple] = []
        self.lack = 0
        self.done: list[tuple] = []

    def add(self, doc, ids: bytes) -> None:
        """Cut off what the short bin lacks and full sequences; put the rest into its class."""
        tokens, at, capacity = len(ids) // 4, 0, self.capacity
        if self.lack:
            at = min(self.lack, tokens)
            self.short.append((doc, 0, at, ids[: at * 4], tokens))
            self.lack -= at
            if not self.lack:
                self._close(self.short)
                self.short = []
        while tokens - at >= capacity:
            self._close([(doc, at, capacity, ids[at * 4 : (at + capacity) * 4], tokens)])
            at += capacity
        if at < tokens:
            count = capacity // (tokens - at)
            held = self.open.setdefault(count, [])
            held.append((doc, at, tokens - at, ids[at * 4 :], tokens))
            if len(held) == count:
                self._full(self.open.pop(count))

    def _full(self, pieces: list[tuple]) -> None:
        lack = self.capacity - sum(p[2] for p in pieces)
        if lack:
            self.short, self.lack = pieces, lack
        else:
            self._close(pieces)

    def _close(self, pieces: list[tuple]) -> None:
        total, offset = sum(p[2] for p in pieces), 0
        for doc, start, length, ids, tokens in pieces:
            self.done.append((doc, start, length, zlib.crc32(ids), tokens, self.next, offset, total, ids))
            offset += length
        self.next += 1

    def finish(self) -> None:
        """Pour what is open into full sequences and sequences of a power of two."""
        left = [*self.short, *(p for count in sorted(self.open) for p in self.open[count])]
        total = sum(p[2] for p in left)
        left.reverse()
        for size in [self.capacity] * (total // self.capacity) + powers(total % self.capacity):
            held = []
            while size:
                doc, start, length, ids, tokens = left.pop()
                if length > size:
                    left.append((doc, start + size, length - size, ids[size * 4 :], tokens))
                    length, ids = size, ids[: size * 4]
                held.append((doc, start, length, ids, tokens))
                size -= length
            self._close(held)
        self.open, self.short, self.lack = {}, [], 0


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens[, ids]).

    ``capacity`` is a power of two; a sequence holds ``sequence_tokens`` ids, ``capacity`` or
    another power of two.  ``ids`` are little-endian unsigned 32-bit integers.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two, not {capacity}")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"`{n}` bigint" for n, _ in _FIELDS) + (", ids binary" if with_ids else "")

    def run(batches):
        bpe = WordBpe.of(path)
        last = end.to_bytes(4, "little")
        bins = Bins(TaskContext.get().partitionId() * STRIDE, capacity)
        id_type = None

        def drained():
            done, bins.done = bins.done, []
            *columns, ids = zip(*done)
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, t) for c, (_, t) in zip(columns[1:], _FIELDS))]
            names = [id_col, *(n for n, _ in _FIELDS)]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids, pa.binary())], [*names, "ids"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in slices(batches):
            id_type = batch.column(0).type
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode(texts_of(batch))):
                bins.add(doc, ids + last)
                if len(bins.done) >= HELD:
                    yield drained()
        bins.finish()
        if bins.done:
            yield drained()

    return bounded(docs).select(id_col, "text").mapInArrow(run, schema)
