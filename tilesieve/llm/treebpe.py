"""BPE of whole texts by tree concatenation, and back.

A long text is cut at its middle, wherever that falls, until the parts are short.  The parts are
encoded on their own and joined again pairwise: a window around the join is encoded anew and
grows until at least one whole chunk on either side has the same ids in the window as in the part
(or the window reaches the end of the part).  Outside the window the ids of the parts hold, inside
those of the window.  White space always ends a piece of this tokenizer, so agreement on a chunk
between white space makes the joined ids exactly those of the whole text.

Texts beyond ``spread`` characters are first cut into parts of that size, which Spark deals out
to tasks; one task per text then joins their ids in the same way.

Null text counts as empty; an empty text has no ids.  Rows may repeat; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded, slices, texts_of
from .wordbpe import WordBpe

# Characters that are encoded in one go, around a join at first, and in one task.
LEAF, WINDOW, SPREAD = 16_384, 64, 1_048_576


class TreeEncoder:
    """Tree concatenation with one vocabulary; a part is the list of its chunks' ids."""

    def __init__(self, bpe: WordBpe, leaf: int = LEAF, window: int = WINDOW) -> None:
        self.bpe, self.leaf, self.window = bpe, leaf, window

    def part(self, text: str) -> list[bytes]:
        return self.bpe.entries([self.bpe.chunks(text)])[0]

    def parts(self, texts: list[str]) -> list[list[bytes]]:
        """The parts of many texts; all leaves are encoded together, then joined text by text."""
        cuts = [self._leaves(0, len(t)) for t in texts]
        leaves = [self.bpe.chunks(t[a:b]) for t, c in zip(texts, cuts) for a, b in c]
        encoded = iter(self.bpe.entries(leaves))
        return [self._joined(t, 0, len(t), encoded) for t in texts]

    def _leaves(self, lo: int, hi: int) -> list[tuple[int, int]]:
        if hi - lo <= self.leaf:
            return [(lo, hi)]
        mid = (lo + hi) // 2
        return self._leaves(lo, mid) + self._leaves(mid, hi)

    def _joined(self, text: str, lo: int, hi: int, encoded) -> list[bytes]:
        if hi - lo <= self.leaf:
            return next(encoded)
        mid = (lo + hi) // 2
        left = self._joined(text, lo, mid, encoded)
        right = self._joined(text, mid, hi, encoded)
        return self.join(text[lo:mid], text[mid:hi], left, right)

    def join(self, before: str, after: str, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The part of ``before + after`` from the parts of both."""
        width = self.window
        while True:
            a, b = before[-width:], after[:width]
            whole_left, whole_right = len(a) == len(before), len(b) == len(after)
            seen = self.part(a + b)
            # Chunks of either side inside the window: the outermost may be cut by the window and the
            # innermost by the join, so only those between can agree.
            n, m = len(self.bpe.chunks(a)), len(self.bpe.chunks(b))
            agrees_left = whole_left or (n > 2 and left[len(left) - n + 1 : -1] == seen[1 : n - 1])
            agrees_right = whole_right or (m > 2 and right[1 : m - 1] == seen[len(seen) - m + 1 : -1])
            if agrees_left and agrees_right:
                head = [] if whole_left else left[: len(left) - n + 1]
                tail = [] if whole_right else right[m - 1 :]
                return head + seen[(0 if whole_left else 1) : (None if whole_right else -1)] + tail
            width *= 2


def _encoder(path: str, leaf: int) -> TreeEncoder:
    return TreeEncoder(WordBpe.of(path), leaf)


def _encoded(rows: DataFrame, path: str, leaf: int, spread: int, decoded: bool, id_col: str) -> DataFrame:
    """(id, ids, text again) of each row; texts beyond ``spread`` through parts in several tasks."""
    kind = rows.schema[id_col].dataType.simpleString()
    out = f"`{id_col}` {kind}, ids binary" + (", decoded string" if decoded else "")

    def finished(names, keys, ids, bpe):
        columns = [keys, pa.array(ids, pa.binary())]
        if decoded:
            columns.append(pa.array([bpe.decode(i) for i in ids], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "ids", "decoded"][: 3 if decoded else 2]

    def encode(batches):
        tree = _encoder(path, leaf)
        for batch in slices(batches):
            ids = [b"".join(p) for p in tree.parts(texts_of(batch))]
            yield finished(names, batch.column(0), ids, tree.bpe)

    def cut(batches):
        for batch in slices(batches, 1):
            text = texts_of(batch)[0]
            starts = range(0, len(text), spread)
            for part, at in enumerate(starts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array([part], pa.int32()), pa.array([text[at : at + spread]])],
                    names=[id_col, "_row", "_part", "text"],
                )

    def encode_parts(batches):
        tree = _encoder(path, leaf)
        for batch in slices(batches, 1):
            part = tree.parts(texts_of(batch))[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part], pa.list_(pa.binary()))], names=[*batch.schema.names, "_ids"])

    def join_parts(group: pa.Table) -> pa.Table:
        tree = _encoder(path, leaf)
        group = group.sort_by("_part")
        parts = [(t, e) for t, e in zip(group["text"].to_pylist(), group["_ids"].to_pylist())]
        while len(parts) > 1:  # pairwise, as the halves inside a task
            pairs = [(a[0] + b[0], tree.join(a[0], b[0], a[1], b[1])) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(parts) & ~1 :]
        done = finished(names, group[id_col].combine_chunks().slice(0, 1), [b"".join(parts[0][1])], tree.bpe)
        return pa.Table.from_batches([done])

    short = F.coalesce(F.length("text") <= spread, F.lit(True))
    near = bounded(rows).filter(short).select(id_col, "text").mapInArrow(encode, out)
    far = (
        rows.filter(~short)
        .select(id_col, "text", F.monotonically_increasing_id().alias("_row"))
        .mapInArrow(cut, f"`{id_col}` {kind}, _row bigint, _part int, text string")
        .repartition("_row", "_part")
        .mapInArrow(encode_parts, f"`{id_col}` {kind}, _row bigint, _part int, text string, _ids array<binary>")
        .groupBy("_row")
        .applyInArrow(join_parts, out)
    )
    return near.unionByName(far)


def encode(rows: DataFrame, path: str, leaf: int = LEAF, spread: int = SPREAD, id_col: str = "doc_id") -> DataFrame:
    """(id, ids): the ids of ``text`` as little-endian unsigned 32-bit integers, one row per row."""
    return _encoded(rows, path, leaf, spread, False, id_col)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, decoded) of rows (id, ids); null ids give the empty text."""

    def run(batches):
        bpe = WordBpe.of(path)
        for batch in slices(batches):
            found = [bpe.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=[id_col, "decoded"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, decoded string")


def encode_decode(rows: DataFrame, path: str, leaf: int = LEAF, spread: int = SPREAD, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the ids of ``text``, and the text that they decode to, in one pass."""
    return _encoded(rows, path, leaf, spread, True, id_col)
