"""Near duplicates by SimHash with pivot distance tables, checked on sets of word shingles.

A document is the set of its shingles of five words (a text of fewer words is one shingle); two
documents are linked if their sets' Jaccard similarity is at least ``LEAST``.  Documents with equal
sets are one row from then on.  No pair below ``LEAST`` is linked: every pair that meets and is not
connected yet is measured on the sets themselves, which hold 32 bits of each shingle's XXH64 value.

Documents meet by their SimHash fingerprints first, as in ``simhash``: blocks of bits, tables of
distances to pivots, and bit by bit what survives.  All that ``REACH`` bits connect is one group.
A fingerprint is the majority over three-word shingles, each once, so equal sets have equal ones.

Similarity 0.8 is up to 11 bits and more, and no choice of blocks tells these from the 32 bits of
unrelated texts without comparing nearly all pairs.  So documents of different groups also meet in
the bands of a MinHash signature: two of similarity s meet nowhere with probability
(1 - s^ROWS)^BANDS, 3 in a million at 0.8 and less above.  A band within one group adds no pair and
is left out.

Bands with the same members are looked at once.  Members of a large group or band are split into parts, and
each pair of parts is a task's work; no pair becomes a row.  Until then only keys move.  Sets move for
one row of each key that shares a band with another one: a bitmap of fixed size with a bit for each
such row, broadcast, keeps nearly all other sets where they are, and a join by row the rest.

Null, empty and blank texts have the empty set and are copies of each other.  Rows without id count
as members, but the row that stays is that of the smallest id that is not null.  An empty table
gives no rows; other columns pass ``keep_first`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .common import bounded, slices, texts_of
from .components import connected
from .simhash import SEED, first_rows, links as fingerprint_links, majority, shingle_hashes

SHINGLE, LEAST = 5, 0.8
# Bits by which fingerprints may differ, and blocks of bits; a row has a key per choice of two blocks.
REACH, BLOCKS = 5, 7
BANDS, ROWS = 32, 5
# Members of a group or band that are compared in one task; shingles that are permuted at once.
GROUP, STEP = 2_048, 4_096
# Bits of the bitmap of wanted rows (16 MiB), in pieces of the size that Spark's bitmaps have.  Where it
# fills up (about 100 million rows) more sets are moved, and the result is the same.
BITS, PIECE = 1 << 27, 1 << 15


def permutations(n: int = BANDS * ROWS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Fixed masks and odd factors, of one bijection of 64-bit integers each."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 63, (2, n), np.uint64)
    return drawn[0], drawn[1] * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray, masks: np.ndarray, factors: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One signed 64-bit integer per band, from the smallest permuted value of each of its rows."""
    least = np.full(len(masks), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), STEP):
        mixed = (hashes[None, at : at + STEP] ^ masks[:, None]) * factors[:, None]
        least = np.minimum(least, mixed.min(axis=1))
    key = np.arange(len(masks) // rows, dtype=np.uint64)  # the same values in other bands are another key
    for row in least.reshape(-1, rows).T:
        key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def shingle_sets(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, row, key, fp, bands, set) of every row: ``key`` names the set, which is sorted 32-bit integers.

    ``row`` is a number of its own for each row, as long as the table is not computed again.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    masks, factors = permutations()

    def run(batches):
        import xxhash

        at = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            keys, fps, bands, sets = [], [], [], []
            for text in texts_of(batch):
                hashes = np.unique(np.array(shingle_hashes(text, SHINGLE), np.uint64))
                keys.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                fps.append(majority(np.unique(np.array(shingle_hashes(text), np.uint64)).tolist()))
                # Empty sets have one key and need no candidates.
                bands.append(band_keys(hashes, masks, factors) if len(hashes) else [])
                sets.append(np.unique(hashes.astype(np.uint32)).tobytes())
            columns = [
                batch.column(0),
                pa.array(np.arange(at, at + batch.num_rows)),
                pa.array(np.array(keys, np.uint64).view(np.int64)),
                pa.array(np.array(fps, np.uint64).view(np.int64)),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(sets, pa.binary()),
            ]
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "row", "key", "fp", "bands", "set"])

    return bounded(docs).select(id_col, "text").mapInArrow(run, f"`{id_col}` {kind}, row bigint, key bigint, fp bigint, bands array<bigint>, set binary")


def sets_of(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, set) of the rows in ``wanted`` (row, without repeats); the sets of others hardly move."""
    slot = F.pmod(F.xxhash64("row"), F.lit(BITS))
    placed = wanted.select(F.floor(slot / PIECE).alias("_piece"), (slot % PIECE).alias("_bit"))
    bitmap = written(placed.groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmap")
    byte = F.expr("conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10)").cast("int")
    likely = (
        marked.select("row", "set", F.floor(slot / PIECE).alias("_piece"), (slot % PIECE).alias("_bit"))
        .join(F.broadcast(bitmap), "_piece")
        .filter(F.expr("shiftleft(1, cast(_bit % 8 as int))").bitwiseAND(byte) > 0)
    )
    # An inner join: a semi-join would be planned below the bitmap and move all sets.
    return likely.select("row", "set").join(wanted, "row")


def alike(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Whether the Jaccard similarity of two sorted sets is at least ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= least * (len(a) + len(b) - common)


def first_connected(sets: list[np.ndarray], least: float = LEAST) -> np.ndarray:
    """For each set of a group the position of the first it is connected with; connected pairs are not measured again."""
    groups: list[list[int]] = []
    for i, own in enumerate(sets):
        joined, apart = [i], []
        for group in groups:
            if any(alike(own, sets[j], least) for j in group):
                joined = group + joined
            else:
                apart.append(group)
        groups = [*apart, joined]
    root = np.arange(len(sets))
    for group in groups:
        root[group] = min(group)
    return root


def close(one: DataFrame, reach: int = REACH, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """(row, _root, _n) of the rows whose fingerprint is connected with that of other rows; _n rows have that root."""
    roots = connected(fingerprint_links(one.select("fp").distinct(), reach, blocks, group=group))
    rooted = one.select("row", "fp").join(roots, F.col("fp") == F.col("node"), "left").select("row", F.coalesce("root", "fp").alias("_root"))
    return rooted.join(rooted.groupBy("_root").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "_root").select("row", "_root", "_n")


def links(marked: DataFrame, least: float = LEAST, group: int = GROUP) -> DataFrame:
    """(a, b) edges between rows whose sets are alike; of the rows of one key, the first stands for all."""
    one = marked.groupBy("key").agg(F.min("row").alias("row"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    one = written(one.select("row", "fp", "bands"), "bands")
    near = written(close(one, group=group), "close")
    rows = one.select("row", F.explode("bands").alias("_band"))
    bands = rows.groupBy("_band").agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("row")).alias("_who")).filter("_n > 1")
    # Bands with the same members: one of them.
    bands = bands.groupBy("_n", "_who").agg(F.min("_band").alias("_band")).select("_band", "_n")
    met = written(rows.join(bands, "_band"), "met")
    # Bands whose members all have one root go: that group's pairs are measured as a band of its own.
    rooted = met.join(near.select("row", "_root"), "row", "left").groupBy("_band", "_n")
    rooted = rooted.agg(F.count("_root").alias("_rooted"), F.min("_root").alias("_least"), F.max("_root").alias("_most"))
    apart = rooted.filter("_rooted < _n or _least < _most").select("_band")
    groups = near.select("row", F.xxhash64("_root").alias("_band"), "_n")
    members = written(met.join(apart, "_band").select("row", "_band", "_n").unionByName(groups), "members")
    sets = written(sets_of(marked, written(members.select("row").distinct(), "wanted")), "sets")
    parts = F.when(F.col("_n") > group, F.ceil(F.col("_n") / (group // 2))).otherwise(1).cast("int")
    dealt = members.withColumn("_parts", parts).withColumn("_part", F.pmod(F.xxhash64("row"), F.col("_parts")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda j: F.least(j, "_part") * F.col("_parts") + F.greatest(j, "_part"))
    dealt = dealt.select("row", "_band", F.explode(pair).alias("_pair")).join(sets, "row")
    grouped = dealt.repartition("_band", "_pair").sortWithinPartitions("_band", "_pair", "row")

    def run(batches):
        def edges_of(held):
            names, sets = [k for k, _ in held], [np.frombuffer(s, np.uint32) for _, s in held]
            root = first_connected(sets, least)
            other = [i for i, r in enumerate(root.tolist()) if i != r]
            return pa.RecordBatch.from_arrays(
                [pa.array([names[root[i]] for i in other], pa.int64()), pa.array([names[i] for i in other], pa.int64())], names=["a", "b"]
            )

        now, held = None, []
        for batch in slices(batches):
            for band, part, row, values in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, part) != now:
                    if len(held) > 1:
                        yield edges_of(held)
                    now, held = (band, part), []
                held.append((row, values))
        if len(held) > 1:
            yield edges_of(held)

    return bounded(grouped).select("_band", "_pair", "row", "set").mapInArrow(run, "a bigint, b bigint")


def components(docs: DataFrame, id_col: str = "doc_id", least: float = LEAST, group: int = GROUP) -> DataFrame:
    """(id, component_id) of every row: the smallest id among all rows its set is connected with."""
    marked = written(shingle_sets(docs, id_col), "shingles")
    distinct = written(marked.groupBy("key").agg(F.min(id_col).alias("_first"), F.min("row").alias("row")), "distinct")
    roots = connected(links(marked, least, group)).select(F.col("node").alias("row"), "root")
    rooted = distinct.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))
    named = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    names = rooted.join(named, "root").select("key", "component_id")
    return marked.select(id_col, "key").join(names, "key").select(id_col, "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, as in ``simhash.keep_first``."""
    return first_rows(docs, components(docs, id_col, **how), id_col)
