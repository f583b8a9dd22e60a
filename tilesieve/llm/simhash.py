"""Near duplicates by SimHash, with pivot distance tables.

A fingerprint is the bitwise majority of the XXH64 values of all word shingles.  Equal
fingerprints are one row from then on.  Every fingerprint has a row in a table of its Hamming
distances to fixed reference fingerprints.  By the triangle inequality two fingerprints within
``reach`` bits differ by at most ``reach`` in every coordinate, so pairs with a larger difference
anywhere are discarded, and those that survive are compared bit by bit.

Only pairs that can survive are looked at together: the bits fall into blocks, and each wrong bit
spoils one, so linked fingerprints agree on all but ``reach`` blocks.  Rows meet under each choice
of that many agreeing blocks.  Where a group of those is large, it is split into parts and each
pair of parts is a task's work.  No pair becomes a row: a group gives, for each of its
fingerprints, the smallest one it is connected with inside the group.

Null text counts as empty and has the fingerprint 0, which links like any other.  Rows without id
count as members, but a component's name is its smallest id that is not null.  An empty table
gives no rows; other columns pass ``keep_first`` untouched.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written
from .common import bounded, slices, texts_of
from .components import connected

SHINGLE, SEED, REACH = 3, 42, 3
# Blocks of bits, reference fingerprints, and fingerprints of a group that are compared at once.
BLOCKS, PIVOTS, GROUP = 5, 16, 2_048


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints far from each other: rows of the 64 x 64 Hadamard matrix, as bits."""
    bits = np.arange(64, dtype=np.uint64)
    rows = np.bitwise_count(bits[1 : n + 1, None] & bits[None, :]) % 2
    return (rows.astype(np.uint64) << bits).sum(axis=1, dtype=np.uint64)


def block_masks(blocks: int, reach: int) -> list[int]:
    """The bits of every choice of ``blocks - reach`` blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(one, blocks - reach)]


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of words; a text of fewer words is one shingle, one of none has none."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z only, ASCII white space only
    if len(words) < size:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())]


def majority(hashes: list[int]) -> int:
    """The bits that are set in over half of the hashes."""
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    data = np.array(hashes, "<u8").view(np.uint8)
    for at in range(0, len(data), 1 << 20):  # bounds the unpacked bits
        ones += np.unpackbits(data[at : at + (1 << 20)].reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """(id, fp): the fingerprint of every row as a signed 64-bit integer."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in slices(batches):
            found = np.array([majority(shingle_hashes(t, size, seed)) for t in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fp"])

    return bounded(docs).select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def smallest_linked(fps: np.ndarray, table: np.ndarray, reach: int) -> np.ndarray:
    """For each distinct fingerprint of a group the position of the first it is connected with.

    ``table`` has the distances to the references, a row per fingerprint; ``fps`` are in order.
    """
    root = np.arange(len(fps))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    step = max(1, (1 << 20) // len(fps))
    for at in range(0, len(fps), step):
        mine = slice(at, at + step)
        near = np.ones((len(fps[mine]), len(fps)), bool)
        near[:, : at + 1] = False  # pairs once
        for pivot in range(table.shape[1]):
            # The table's largest coordinate difference discards a pair as soon as one is too large.
            near &= np.abs(table[mine, pivot, None] - table[None, :, pivot]) <= reach
        a, b = np.nonzero(near)
        a += at
        linked = np.bitwise_count(fps[a] ^ fps[b]) <= reach
        for i, j in zip(a[linked].tolist(), b[linked].tolist()):
            i, j = find(i), find(j)
            root[max(i, j)] = min(i, j)
    return np.array([find(i) for i in range(len(fps))])


def links(fps: DataFrame, reach: int = REACH, blocks: int = BLOCKS, n_pivots: int = PIVOTS, group: int = GROUP) -> DataFrame:
    """(a, b) edges that connect all distinct fingerprints (column fp) within ``reach`` bits of each other."""
    masks = block_masks(blocks, reach)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("_mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("_bits")) for i, m in enumerate(signed))))
    keys = fps.select("fp", pairs.alias("_k")).select("fp", "_k._mask", "_k._bits")
    # Groups beyond the bound are split into parts; a row goes with its part to each pair of parts.
    large = keys.groupBy("_mask", "_bits").count().filter(F.col("count") > group)
    large = large.select("_mask", "_bits", F.ceil(F.col("count") / (group // 2)).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int")
    joined = keys.join(large, ["_mask", "_bits"], "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    dealt = joined.withColumn("_part", part).select(
        "fp",
        "_mask",
        "_bits",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda j: F.least(j, "_part") * F.col("_parts") + F.greatest(j, "_part"))).alias("_pair"),
    )
    grouped = dealt.repartition("_mask", "_bits", "_pair").sortWithinPartitions("_mask", "_bits", "_pair", "fp")
    references = pivots(n_pivots)

    def run(batches):
        def edges_of(columns):
            mask, bits, pair, fp = (np.concatenate(c) for c in zip(*columns))
            change = (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1]) | (pair[1:] != pair[:-1])
            starts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(fp)]])
            sizes = np.diff(starts)
            a, b = [], []
            for s, n in zip(starts[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                own = fp[s : s + n].view(np.uint64)
                table = np.bitwise_count(own[:, None] ^ references).astype(np.int8)
                root = smallest_linked(own, table, reach)
                other = np.flatnonzero(root != np.arange(n))
                a.append(fp[s + root[other]])
                b.append(fp[s + other])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(4)]
            mask, bits, pair, _ = columns
            # What precedes the batch's last group is complete; that group may go on.
            last = (mask == mask[-1]) & (bits == bits[-1]) & (pair == pair[-1])
            first = len(last) - int(last.sum())
            if first:
                yield from edges_of([*held, [c[:first] for c in columns]])
                held = []
            elif held and any(h[-1] != c[-1] for h, c in zip(held[-1][:3], columns[:3])):
                yield from edges_of(held)
                held = []
            held.append([c[first:] for c in columns])
        if held:
            yield from edges_of(held)

    return grouped.select("_mask", "_bits", "_pair", "fp").mapInArrow(run, "a bigint, b bigint")


def components(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", **how) -> DataFrame:
    """(id, fp, component_id) of every row: the smallest id among all rows its fingerprint is connected with."""
    marked = written(fingerprints(docs, id_col=id_col), "fingerprints")
    # One row per fingerprint: copies, however many, are gathered in the tasks first.
    distinct = written(marked.groupBy("fp").agg(F.min(id_col).alias("_first")), "distinct")
    roots = connected(links(distinct, reach, **how)).select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    names = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(names, "fp").select(id_col, "fp", "component_id")


def keep_first(docs: DataFrame, reach: int = REACH, id_col: str = "doc_id", **how) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id.

    Of several rows with that id the first by their text stays; a row without id stays if its
    component has no id at all.
    """
    return first_rows(docs, components(docs, reach, id_col, **how), id_col)


def first_rows(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``keep_first`` keeps, for components (id, component_id) of all rows."""
    first = found.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy(id_col, "component_id").agg(F.count(F.lit(1)).alias("_rows"))
    kept = docs.join(first.select(F.col(id_col).alias("_kept"), "_rows"), F.col(id_col).eqNullSafe(F.col("_kept")), "inner")
    # The join has brought the rows of an id together; numbering them needs no other shuffle.
    number = F.row_number().over(Window.partitionBy("_kept").orderBy(F.xxhash64("text"), "text"))
    return kept.withColumn("_number", number).filter("_number = 1").select(*docs.columns)
