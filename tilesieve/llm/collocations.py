"""Phrase collocations by dynamic itemset counting.

The texts are dealt to ``SHARDS`` shards, which are scanned in a cycle, one job per step.  A scan
counts phrases of all lengths at once: words from the start, a longer phrase from the step after
both of its parts of one word less (without its last, and without its first word) have reached the
threshold in what has been counted so far, and for one full cycle; so every counted phrase has been
counted in every shard exactly once.

What has reached the threshold is kept in a table of hashed slots, one byte each, of a size that is
fixed at the start (at most 2^``MOST_BITS`` for each length): phrases of one slot are added up there,
so a slot may open a phrase early, or one that is too rare in the end, but never keeps one closed.  The counts
themselves are kept by the phrase, as text.  Phrases whose slot stays below the threshold are left
out before the exact counts are added up by Spark.

A candidate is a phrase of 2 to ``longest`` words with at least ``threshold`` occurrences.  Cut after
its first k words it scores floor(10^6 a^2 / (l r)) from its count and those of both sides, in
exact decimals; its lowest cut counts, the smallest k among equals.  A candidate inside a longer one
that has at least ``absorbed`` per cent of its occurrences is dropped.

Everything is per language.  A-Z become a-z; phrases do not cross ``.,;:!?`` or line ends, and words
are separated by spaces and tabs.  Null text counts as empty, null language as ``und``; empty texts and
tables have no phrases; repeated rows count as often as they come; other columns are ignored.
A task holds ``FLUSH`` bytes of text at a time, or one text where it is longer.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path, written
from .common import bounded

LONGEST, THRESHOLD, ABSORBED, TOP = 3, 10, 50, 2_000
SHARDS, FLUSH = 3, 4 * 1024 * 1024
# Slots: about one per eight words for each length of the corpus, within these powers of two; a block of them is summed in one place.
LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 27, 18
# Phrases of a packed row.
PACKED = 2_048
NEVER = 255

_BREAK, _GAP = b"\n", b" "
# What ends a piece, what separates words, and capitals.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 9 + _GAP)
# A row holds the packed phrases of one length, the sums of one block of slots, or (size 0) a number of words.
_SCHEMA = "lang string, size int, n bigint, block int, phrases binary, ends binary, slots binary, sums binary"


def tokens(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Codes of all words in order, -1 where a piece ends, and the words that they stand for."""
    data = _BREAK.join(texts).translate(_BYTES).replace(_BREAK, b" \n ") + _GAP
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    # Every word with the space behind it, without copying; a gap of several spaces gives lone spaces.
    column = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = column.dictionary_encode()
    words = [w[:-1] for w in coded.dictionary.to_pylist()]
    # Codes in the order of the words: phrases in order pack well.
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    codes, words = rank[coded.indices.to_numpy()], [words[i] for i in order]
    names = {w: i for i, w in enumerate(words) if w in (b"", _BREAK)}
    codes = codes[codes != names.get(b"", -1)]
    codes[codes == names.get(_BREAK, -2)] = -1
    return codes, words


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _table_size(longest: int, bits: int) -> int:
    """Slots of all phrases of up to ``longest`` words: an eighth as many for words as for each other length."""
    return (1 << (bits - 3)) + ((longest - 1) << bits)


def _slots(hashes: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Each length has slots of its own, so the last slot of a length is reached one cycle after that of the length before."""
    own = bits - 3 if size == 1 else bits
    return (hashes & np.uint64((1 << own) - 1)).astype(np.int64) + (_table_size(size - 1, bits) if size > 1 else 0)


def count_phrases(codes: np.ndarray, words: list[bytes], lang: str, since: np.ndarray, step: int, shards: int, longest: int, bits: int):
    """For each length the phrases that are counted in this step: (length, phrases, counts, slots).

    ``since`` has for each slot the step from which what lies in it counts as reached.
    """
    import xxhash

    salt = lang.encode() + b"\t"
    hashes = np.array([xxhash.xxh64_intdigest(salt + w) for w in words], np.uint64)
    spaced = pa.array([w + _GAP for w in words], pa.large_binary())
    plain = pa.array(words, pa.large_binary())
    there = codes >= 0
    safe = np.where(there, codes, 0)
    single = hashes[safe] if len(words) else np.zeros(0, np.uint64)
    own, whole, opened = single, there, np.zeros(len(codes), np.int64)
    for size in range(1, longest + 1):
        n = len(codes) - size + 1
        if n <= 0:
            return
        if size > 1:
            # Reached parts: the phrase without its last, and without its first word.
            reached = np.where(whole, since[_slots(own, size - 1, bits)], NEVER)
            opened = np.maximum(reached[:-1], reached[1:])
            own, whole = _mixed(own[:n], single[size - 1 :]), whole[:n] & there[size - 1 :]
        at = np.flatnonzero(whole & (opened <= step) & (opened.astype(np.int64) + shards > step) & (opened < NEVER))
        if not len(at):
            continue
        # Hash tables, not sorting: a phrase is the number of its part before the last word, and that word.
        ids, parts = codes[at], []
        for j in range(1, size):
            coded = pa.array(ids * len(words) + codes[at + j]).dictionary_encode()
            ids = coded.indices.to_numpy().astype(np.int64)
            parts.append(coded.dictionary.to_numpy())
        found = np.bincount(ids)
        one = np.flatnonzero(found)
        columns, left = [], one
        for pairs in reversed(parts):
            left, word = np.divmod(pairs[left], len(words))
            columns.append(word)
        columns = [left, *reversed(columns)]
        order = np.lexsort(columns[::-1])
        columns, counts = [c[order] for c in columns], found[one[order]]
        mixed = hashes[columns[0]]
        for word in columns[1:]:
            mixed = _mixed(mixed, hashes[word])
        texts = [spaced.take(pa.array(c)) for c in columns[:-1]] + [plain.take(pa.array(columns[-1]))]
        phrases = pc.binary_join_element_wise(*texts, pa.scalar(b"", pa.large_binary())) if size > 1 else texts[0]
        yield size, phrases, counts, _slots(mixed, size, bits)


def _packed_places(places: np.ndarray) -> bytes:
    """Places in a block, in order: how many lie in each of its parts of 65,536, and two bytes for each."""
    sizes = np.bincount(places >> 16, minlength=1 << (BLOCK_BITS - 16))
    return sizes.astype("<u4").tobytes() + (places & 0xFFFF).astype("<u2").tobytes()


def _places(packed: bytes) -> np.ndarray:
    parts = 1 << (BLOCK_BITS - 16)
    sizes = np.frombuffer(packed, "<u4", parts)
    return np.frombuffer(packed, "<u2", offset=4 * parts) + (np.repeat(np.arange(parts), sizes) << 16)


def _slot_type(threshold: int) -> np.dtype:
    """The smallest type that can tell whether the threshold is reached."""
    return np.min_scalar_type(threshold)


def _scan(shard: DataFrame, since, step: int, shards: int, longest: int, threshold: int, flush: int, bits: int) -> DataFrame:
    """The counts of one step by task, and their sums by slot, in blocks."""
    cap = np.iinfo(_slot_type(threshold)).max

    kinds = {"lang": pa.string(), "size": pa.int32(), "n": pa.int64(), "block": pa.int32()} | dict.fromkeys(("phrases", "ends", "slots", "sums"), pa.binary())

    def rows(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), t) for c, t in kinds.items()], names=list(kinds))

    def packed(lang, length, phrases, counts, slots):
        for at in range(0, len(phrases), PACKED):
            some = slice(at, at + PACKED)
            part = phrases[some]
            offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
            data = part.buffers()[2][int(offsets[0]) : int(offsets[-1])].to_pybytes()
            ends = (offsets[1:] - offsets[0]).astype("<u4").tobytes()
            yield rows(lang=[lang], size=[length], phrases=[data], ends=[ends], slots=[slots[some].astype("<u4").tobytes()], sums=[counts[some].astype("<u4").tobytes()])

    def by_block(counts, slots):
        order = np.argsort(slots)
        distinct, first = np.unique(slots[order], return_index=True)
        sums = np.minimum(np.add.reduceat(counts[order], first), cap).astype(_slot_type(threshold))
        blocks, starts = np.unique(distinct >> BLOCK_BITS, return_index=True)
        places = distinct & ((1 << BLOCK_BITS) - 1)
        pieces = list(zip(starts.tolist(), [*starts[1:].tolist(), len(distinct)]))
        return rows(block=blocks, slots=[_packed_places(places[a:b]) for a, b in pieces], sums=[sums[a:b].tobytes() for a, b in pieces])

    def run(batches):
        reached = since.value
        held: dict[str, list[bytes]] = {}
        size = 0

        def flushed():
            for lang, texts in held.items():
                codes, words = tokens(texts)
                total = int((codes >= 0).sum())
                if step < shards and total:
                    yield rows(lang=[lang], size=[0], n=[total])
                for length, phrases, counts, slots in count_phrases(codes, words, lang, reached, step, shards, longest, bits):
                    yield from packed(lang, length, phrases, counts, slots)
                    yield by_block(counts, slots)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text.encode()
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= flush:
                    yield from flushed()
                    held, size = {}, 0
        yield from flushed()

    return bounded(shard).select("lang", "text").mapInArrow(run, _SCHEMA)


def _added_slots(totals: DataFrame | None, counts: DataFrame, threshold: int) -> DataFrame:
    """(block, sums, reached): the sums of all slots so far, capped by their type, and a bit for each that is reached; written."""
    kind = _slot_type(threshold)
    cap, n = np.iinfo(kind).max, 1 << BLOCK_BITS

    def run(batches):
        now, total = None, None

        def row():
            values = [pa.array([now], pa.int32()), pa.array([np.minimum(total, cap).astype(kind).tobytes()], pa.binary()), pa.array([np.packbits(total >= threshold).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(values, names=["block", "sums", "reached"])

        for batch in batches:
            for block, slots, sums in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None:
                        yield row()
                    now, total = block, np.zeros(n, np.int64)
                # Sums below the cap are exact, at the cap they are reached for good.
                at = slice(None) if slots is None else _places(slots)
                total[at] += np.frombuffer(sums, kind)
        if now is not None:
            yield row()

    rows = counts.filter("block IS NOT NULL").select("block", "slots", "sums")
    if totals is not None:
        rows = rows.unionByName(totals.select("block", F.lit(None).cast("binary").alias("slots"), "sums"))
    dealt = rows.repartition("block").sortWithinPartitions("block")
    return written(dealt.mapInArrow(run, "block int, sums binary, reached binary"), "slots")


def phrase_counts(
    docs: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, shards: int = SHARDS, bits: int | None = None, flush: int = FLUSH
) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases with at least ``threshold`` occurrences, and (lang, n) of all words."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    own = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.col("text")).filter("text <> ''")
    dealt = own.withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int"))
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    table = spark.read.schema("lang string, text string, shard int").parquet(path)
    if bits is None:
        words = (table.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
        bits = min(max(LEAST_BITS, (words // 8).bit_length()), MOST_BITS)
    since = np.full(_table_size(longest - 1, bits), NEVER, np.uint8)
    reached = np.zeros(_table_size(longest, bits) // 8 + (1 << BLOCK_BITS), np.uint8)
    counted, totals, step, last = [], None, 0, 0
    while step < last + shards:
        shipped = spark.sparkContext.broadcast(since)
        found = _scan(table.filter(F.col("shard") == step % shards), shipped, step, shards, longest, threshold, flush, bits)
        at = scratch_path(spark, "counts")
        found.write.option("compression", "zstd").parquet(at)
        shipped.destroy()
        counted.append(spark.read.schema(_SCHEMA).parquet(at))
        totals = _added_slots(totals, counted[-1], threshold)
        # A bit per slot reaches the driver, in rows of one block.
        step += 1
        width = (1 << BLOCK_BITS) // 8
        for block, bitmap in totals.select("block", "reached").collect():
            reached[block * width : (block + 1) * width] = np.frombuffer(bitmap, np.uint8)
            own = since[block << BLOCK_BITS : (block + 1) << BLOCK_BITS]
            fresh = np.unpackbits(np.frombuffer(bitmap, np.uint8))[: len(own)].astype(bool) & (own == NEVER)
            if fresh.any():
                own[fresh], last = step, step
    return _added_up(counted, reached, threshold)


def _added_up(counted: list[DataFrame], reached: np.ndarray, threshold: int) -> tuple[DataFrame, DataFrame]:
    """The exact counts of all steps; phrases in slots that never reached the threshold are left out first."""
    spark = counted[0].sparkSession
    shipped = spark.sparkContext.broadcast(reached)

    def run(batches):
        reached = shipped.value
        for batch in batches:
            for lang, size, phrases, ends, slots, sums in zip(*(c.to_pylist() for c in batch.columns)):
                slots, ends = np.frombuffer(slots, "<u4"), np.frombuffer(ends, "<u4")
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                texts = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(phrases)])
                counts = pa.array(np.frombuffer(sums, "<u4").astype(np.int64))
                open_slot = pa.array(((reached[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1).astype(bool))
                texts, counts = texts.filter(open_slot), counts.filter(open_slot)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), pa.array(np.full(len(texts), size, np.int32)), texts, counts], names=["lang", "size", "phrase", "n"])

    rows = reduce(DataFrame.unionByName, counted)
    held = rows.filter("size > 0").select("lang", "size", "phrases", "ends", "slots", "sums")
    kept = held.mapInArrow(run, "lang string, size int, phrase string, n bigint")
    frequent = kept.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= threshold)
    sizes = rows.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return written(frequent, "frequent"), written(sizes, "sizes")


def scored(frequent: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, a, k, l, r, score) of every candidate, by its lowest cut."""
    candidates = frequent.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    first = F.expr("substring_index(phrase, ' ', k)")
    cuts = cuts.withColumn("first", first).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    both = both.withColumn("_up", F.lit(1_000_000).cast("decimal(7,0)") * a * a).withColumn("_down", l * r)
    both = both.withColumn("score", F.expr("_up div _down"))
    best = both.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "size", "phrase", "a", "cut.k", "cut.l", "cut.r", "cut.score")


def without_absorbed(candidates: DataFrame, absorbed: int = ABSORBED, longest: int = LONGEST) -> DataFrame:
    """The candidates that no longer one holds with at least ``absorbed`` per cent of their occurrences."""
    words = F.split("phrase", " ", -1)
    starts = F.explode(F.sequence(F.lit(0), F.col("size") - F.col("_size")))
    long = candidates.filter("size > 2").select("lang", "size", F.col("a").alias("_a"), words.alias("_words"))
    parts = long.withColumn("_size", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("_start", starts)
    parts = parts.select("lang", F.array_join(F.slice("_words", F.col("_start") + 1, F.col("_size")), " ").alias("phrase"), "_a")
    most = parts.groupBy("lang", "phrase").agg(F.max("_a").alias("_most"))
    held = candidates.join(most, ["lang", "phrase"], "left")
    return held.filter(F.col("_most").isNull() | (100 * F.col("_most") < absorbed * F.col("a"))).drop("_most")


def collocations(docs: DataFrame, top: int = TOP, longest: int = LONGEST, threshold: int = THRESHOLD, absorbed: int = ABSORBED, **how) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` by score, occurrences and phrase."""
    frequent, sizes = phrase_counts(docs, longest, threshold, **how)
    kept = without_absorbed(written(scored(frequent, longest), "scored"), absorbed, longest)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    found = ranked.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, "lang")
    return found.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
