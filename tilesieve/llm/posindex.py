"""Benchmark decontamination by a positional inverted index, with built-in functions only.

The index holds a posting (key, pos, word) for every occurrence of a word that the tests use, in
the order of the documents, so that it is written by the tasks that read them without a shuffle;
``key`` names a text, so copies share their postings.  A test's windows are runs of ``size``
consecutive words, or the whole test where it has fewer.

A window's words are ranked by how often the corpus has them.  The lists of its ``FIRST`` rarest
ones are adjusted by their offsets in the test and intersected: what remains is a diagonal
(key, test, position of the test's first word).  The other lists are intersected on these diagonals
only, until every word of the window is there: the match is exact.  Windows with a word that the
corpus lacks are never looked up.  ``near`` gives proximity matches: all words of a window at most
``within`` words away from an occurrence of its rarest one, in any order.

Words are runs of 0-9, a-z and characters beyond ASCII, after A-Z became a-z.  Null, empty and
blank texts have no words: such a document has no hit, such a test no window.  Equal texts are one
key and their postings are made distinct in the tasks first, so a group of copies, however large, is
intersected once; repeated document rows each get their row.  Tests that repeat an id add their
windows to that item; a test without id is looked up, marks words and counts as one item with all
others without id, but has no name in the digest.  Empty tables give no matches.  Other columns of
both tables are ignored, whatever their names.

Only tables measured before are broadcast (the tests' words and windows, below ``SMALL`` bytes);
larger ones are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

SIZE, FIRST = 10, 2
# Bytes of a table that may be broadcast.
SMALL = 32 * 1024 * 1024
# What is between words.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text in order, still with their capitals; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def lowered(word: Column) -> Column:
    """A-Z as a-z, and nothing else changed."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def text_key(text: Column) -> Column:
    """16 bytes that name a text; null is named like the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def bounded_broadcast(table: DataFrame, limit: int = SMALL) -> DataFrame:
    """A written table marked for broadcast if its strings and rows are measured to fit ``limit`` bytes."""
    strings = [F.octet_length(f.name) for f in table.schema if f.dataType.simpleString() in ("string", "binary")]
    arrays = [F.size(f.name) * 16 for f in table.schema if f.dataType.simpleString().startswith("array")]
    row = sum((F.coalesce(c, F.lit(0)) for c in [*strings, *arrays]), F.lit(64)).cast("bigint")
    size = table.agg(F.sum(row)).first()[0] or 0
    return F.broadcast(table) if size <= limit else table


def tests_of(items: DataFrame, id_col: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(test, tokens) of every different test with words, and (test, id) of the rows that have it."""
    low = F.transform(words(F.col("text")), lowered)
    held = items.select(F.col(id_col).cast("string").alias("id"), low.alias("tokens")).filter(F.size("tokens") > 0)
    held = written(held, "tests")
    tokens = written(held.select("tokens").distinct().withColumn("test", F.monotonically_increasing_id()), "tokens")
    return tokens, written(held.join(tokens, "tokens").select("test", "id").distinct(), "ids")


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(key, pos, word): the postings of every word of ``vocabulary`` (word), written in the order of the documents."""
    # The key is a column before the words are spread, or it would be computed for each of them.
    held = docs.select(text_key(F.col("text")).alias("key"), words(F.col("text")).alias("words"))
    spread = held.select("key", F.posexplode("words").alias("pos", "word")).select("key", "pos", lowered(F.col("word")).alias("word"))
    return written(spread.join(bounded_broadcast(vocabulary), "word", "left_semi").select("key", "pos", "word"), "postings")


def ranked_windows(tokens: DataFrame, postings: DataFrame, size: int = SIZE, first: int = FIRST) -> DataFrame:
    """(test, start, length, rare) of every window whose words all occur; ``rare`` are places in the test, rarest first."""
    counts = written(postings.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "counts")
    spread = tokens.select("test", F.posexplode("tokens").alias("place", "word")).join(bounded_broadcast(counts), "word", "left")
    lists = spread.groupBy("test").agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("n", F.lit(0)).alias("n")))).alias("held"))
    length = F.least(F.size("held"), F.lit(size))
    starts = lists.select("test", "held", length.alias("length"), F.explode(F.sequence(F.lit(0), F.size("held") - length)).alias("start"))
    own = F.transform(F.slice("held", F.col("start") + 1, F.col("length")), lambda w: F.struct(w["n"].alias("n"), w["place"].alias("place")))
    ordered = starts.withColumn("own", F.array_sort(own)).filter(F.col("own")[0]["n"] > 0)
    return written(ordered.select("test", "start", "length", F.slice("own.place", 1, first).alias("rare")), "windows")


def _bit(place: Column) -> Column:
    """A place of a test as one of 64 bits; places 64 apart share theirs."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place % 64)


def candidates(postings: DataFrame, tokens: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, test, diagonal, start, length) of the windows whose rarest words' lists meet on a diagonal.

    A diagonal's places are held as 64 bits, which is exact for tests of up to 64 words; of longer
    tests some more windows stay, for the other lists to decide.
    """
    rare = windows.select("test", F.size("rare").alias("n"), F.explode("rare").alias("place"))
    wanted = rare.groupBy("test", "place").agg(F.min("n").alias("_n"))
    fewest = windows.groupBy("test").agg(F.min(F.size("rare")).alias("fewest"))
    spread = tokens.select("test", F.posexplode("tokens").alias("place", "word"))
    entries = written(spread.join(wanted, ["test", "place"]).join(fewest, "test").select("test", "place", "word", "fewest"), "entries")
    met = postings.join(bounded_broadcast(entries), "word").select("key", "test", (F.col("pos") - F.col("place")).alias("diagonal"), _bit(F.col("place")).alias("bit"), "fewest")
    # Tasks join the bits of equal diagonals first, so copies of a text are moved once per task.
    held = met.groupBy("key", "test", "diagonal").agg(F.bit_or("bit").alias("bits"), F.min("fewest").alias("fewest"))
    held = held.filter(F.bit_count("bits") >= F.col("fewest"))
    masked = windows.withColumn("mask", F.aggregate("rare", F.lit(0).cast("bigint"), lambda m, p: m.bitwiseOR(_bit(p))))
    found = held.join(bounded_broadcast(masked), "test").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return written(found.select("key", "test", "diagonal", "start", "length"), "candidates")


def matches(postings: DataFrame, tokens: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, test, diagonal, start, length) of every window that occurs: at position diagonal + start of the text."""
    found = candidates(postings, tokens, windows)
    # The remaining lists, for the words of the candidates' windows only.
    place = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))
    probes = found.select("key", "test", "diagonal", place.alias("place")).distinct()
    spread = written(tokens.select("test", F.posexplode("tokens").alias("place", "word")), "spread")
    probes = probes.join(bounded_broadcast(spread), ["test", "place"])
    probes = probes.select("key", "test", "diagonal", "place", "word", (F.col("diagonal") + F.col("place")).alias("pos"))
    keys = written(found.select("key").distinct(), "keys")
    lists = postings.join(bounded_broadcast(keys), "key", "left_semi").distinct()
    met = probes.join(lists, ["key", "pos", "word"]).groupBy("key", "test", "diagonal").agg(F.collect_list("place").alias("places"))
    whole = found.join(met, ["key", "test", "diagonal"])
    inside = F.size(F.filter("places", lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("length")))) == F.col("length")
    return whole.filter(inside).select("key", "test", "diagonal", "start", "length")


def near(postings: DataFrame, tokens: DataFrame, windows: DataFrame, within: int = 20) -> DataFrame:
    """(key, test, start, length, pos) of every proximity match; ``pos`` is that of the window's rarest word.

    Each different word of the window occurs at most ``within`` words away from ``pos``.
    """
    spread = tokens.select("test", F.posexplode("tokens").alias("place", "word"))
    anchors = windows.select("test", "start", "length", F.col("rare")[0].alias("place")).join(spread, ["test", "place"])
    anchors = written(anchors.select("test", "start", "length", "word"), "anchors")
    place = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place")
    others = windows.select("test", "start", place).join(spread, ["test", "place"]).select("test", "start", "word").distinct()
    sizes = others.groupBy("test", "start").agg(F.count(F.lit(1)).alias("n_words"))
    at = postings.join(bounded_broadcast(anchors), "word").select("key", "test", "start", "length", "pos").distinct()
    # Positions meet in steps of ``within``; the words near a position lie in its step or beside it.
    step = (F.col("pos") / F.lit(within + 1)).cast("bigint")
    probes = at.join(others, ["test", "start"]).withColumn("step", F.explode(F.array(step - 1, step, step + 1)))
    keys = written(at.select("key").distinct(), "keys")
    lists = postings.join(bounded_broadcast(keys), "key", "left_semi").distinct()
    lists = lists.select("key", "word", F.col("pos").alias("there"), (F.col("pos") / F.lit(within + 1)).cast("bigint").alias("step"))
    met = probes.join(lists, ["key", "word", "step"]).filter(F.abs(F.col("there") - F.col("pos")) <= within)
    met = met.select("key", "test", "start", "length", "pos", "word").distinct()
    found = met.groupBy("key", "test", "start", "length", "pos").agg(F.count(F.lit(1)).alias("n_met"))
    return found.join(sizes, ["test", "start"]).filter("n_met = n_words").select("key", "test", "start", "length", "pos")


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """(doc_id, n_words, n_hit, items) of every document: words inside matches, and the items' ids, sorted as strings."""
    tokens, ids = tests_of(items, item_id)
    vocabulary = written(tokens.select(F.explode("tokens").alias("word")).distinct(), "vocabulary")
    postings = build_index(docs, vocabulary)
    found = written(matches(postings, tokens, ranked_windows(tokens, postings, size)), "matches")
    first = F.col("diagonal") + F.col("start")
    hit = found.select("key", F.explode(F.sequence(first, first + F.col("length") - 1)).alias("pos")).distinct()
    hits = hit.groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.select("key", "test").distinct().join(bounded_broadcast(ids), "test").select("key", "id").distinct()
    # collect_list leaves ids that are null out, the count does not.
    listed = named.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("id")).alias("items"))
    result = written(hits.join(listed, "key"), "hits")
    own = docs.select(F.col(doc_id), text_key(F.col("text")).alias("key"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    return own.join(bounded_broadcast(result), "key", "left").select(
        doc_id,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
