"""Document fingerprints from closed syncmers, with built-in functions only.

The tokens of a text are its lower-cased words; longer ones are cut every ``WORD`` characters, so
a text without white space has tokens too.  Of every k = 5 tokens in a row the four pairs of
neighbours are hashed; the five are an anchor if the smallest of the four hashes is the first or
the last.  Whether they are depends on nothing but these five tokens, so a passage has the same
anchors wherever it stands, and anchors of two texts can be matched by position.

The fingerprint is all anchors of the whole text in order, each a 64-bit integer: the hash in the
upper half, the position of its first token in the lower.  Anchors of two texts match one to one by
hash, the first of several with the first, the second with the second; the likeness of two
fingerprints is the share of anchors that have a match, 2 |matches| / (|A| + |B|).

Null text counts as empty.  A text without tokens has the empty fingerprint, and a text whose
tokens have no anchor has one at position 0, the hash of all its tokens.  Two empty fingerprints have the
likeness 1.  Equal texts have equal fingerprints.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

WORD, K = 16, 5


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), rf"\s+|(?<=\G\S{{{WORD}}})"), "")


def _with_pairs(df: DataFrame, text: str) -> DataFrame:
    """Adds _t, the hashes of the tokens, and _s, those of neighbouring tokens."""
    hashed = df.withColumn("_t", F.transform(_tokens(F.coalesce(F.col(text), F.lit(""))), lambda t: F.xxhash64(t)))
    return hashed.withColumn(
        "_s", F.expr("transform(slice(_t, 1, greatest(size(_t) - 1, 0)), (a, i) -> xxhash64(a, get(_t, i + 1)))")
    )


# Over the first of each four pairs in a row: the 32-bit hash of the five tokens if they are an anchor.
_FOURS = "slice(_s, 1, greatest(size(_s) - 3, 0))"
_IS_ANCHOR = "least(a, get(_s, i + 3)) <= least(get(_s, i + 1), get(_s, i + 2))"
_ANCHOR = "hash(a, get(_s, i + 2), get(_s, i + 3))"


def anchors(df: DataFrame, text: str = "text", out: str = "anchors") -> DataFrame:
    """Adds the anchors of the whole text in order: array of (hash, position of the first token)."""
    found = _with_pairs(df, text).withColumn(
        out,
        F.expr(
            f"filter(transform({_FOURS}, (a, i) -> if({_IS_ANCHOR}, named_struct('hash', {_ANCHOR}, 'position', i), null)), x -> x is not null)"
        ),
    )
    return found.drop("_t", "_s")


def matches(a: Column, b: Column) -> Column:
    """Pairs of positions (in a, in b) of anchors with one hash; each of a's with the first of b's."""
    hashes = F.transform(b, lambda x: x["hash"])
    paired = F.transform(
        a, lambda x: F.struct(x["position"].alias("a"), F.get(b, (F.array_position(hashes, x["hash"]) - 1).cast("int"))["position"].alias("b"))
    )
    return F.filter(paired, lambda p: p["b"].isNotNull())


def fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the fingerprint of a whole text as an array of integers."""
    packed = f"shiftleft(cast({_ANCHOR} as bigint), 32) + i"
    chosen = _with_pairs(df, text).withColumn(
        "_c", F.expr(f"filter(transform({_FOURS}, (a, i) -> if({_IS_ANCHOR}, {packed}, null)), x -> x is not null)")
    )
    whole = F.when(F.size("_t") > 0, F.array(F.shiftleft(F.hash("_t").cast("bigint"), 32))).otherwise(F.array().cast("array<bigint>"))
    return chosen.withColumn(out, F.when(F.size("_c") > 0, F.col("_c")).otherwise(whole)).drop("_t", "_s", "_c")


def as_text(fingerprint: Column) -> Column:
    """Sixteen hexadecimal digits per anchor: its hash and its position."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def n_matches(a: Column, b: Column) -> Column:
    """How many anchors of two fingerprints match one to one, by one pass over both, sorted by hash."""
    sides = F.transform(a, lambda x: F.shiftright(x, 32) * 2), F.transform(b, lambda x: F.shiftright(x, 32) * 2 + 1)
    # Of each hash those of a come first: ``open`` of them are without a match so far.
    start = F.struct(F.lit(None).cast("bigint").alias("hash"), F.lit(0).alias("open"), F.lit(0).alias("found"))

    def step(s, x):
        same, second = s["hash"].eqNullSafe(F.shiftright(x, 1)), x.bitwiseAND(F.lit(1)) == 1
        still = F.when(same, s["open"]).otherwise(0)
        return F.struct(
            F.shiftright(x, 1).alias("hash"),
            F.when(second, F.greatest(still - 1, F.lit(0))).otherwise(still + 1).alias("open"),
            F.when(second & (still > 0), s["found"] + 1).otherwise(s["found"]).alias("found"),
        )

    return F.aggregate(F.sort_array(F.concat(*sides)), start, step, lambda s: s["found"])


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the share of anchors that have a match; 1 for two empty fingerprints."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 1.0).otherwise(2 * n_matches(a, b) / both)


def _name(id_col: Column) -> Column:
    """An id as text; a null id has a name too."""
    return F.coalesce(F.concat(F.lit("="), id_col.cast("string")), F.lit("-"))


def in_order(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, _h, n_chars, _next_id, _next_h): each document and the next by descending id, the first after the last.

    A document is an id and a text, known here by its hash; several texts of one id are ordered by
    hash, and a null id comes last.  Only keys are sorted, in slices; what follows the end of a
    slice is the first of the next slice.
    """
    text = F.coalesce("text", F.lit(""))
    keys = docs.select(id_col, F.xxhash64(text).alias("_h"), F.length(text).alias("n_chars")).distinct()
    order = [F.col(id_col).desc_nulls_last(), F.col("_h")]
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = written(keys.repartitionByRange(count, *order).withColumn("_slice", F.spark_partition_id()), "order")
    within = Window.partitionBy("_slice").orderBy(*order)
    me = F.struct(F.col(id_col).alias("id"), F.col("_h").alias("h"))
    placed = sliced.withColumn("_next", F.lead(me).over(within)).withColumn("_at", F.row_number().over(within))
    # One row per slice.
    heads = placed.filter("_at = 1").select("_slice", me.alias("_head"))
    ring = Window.partitionBy(F.lit(0)).orderBy("_slice")
    everything = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("_slice", F.coalesce(F.lead("_head").over(ring), F.first("_head").over(everything)).alias("_after"))
    joined = placed.join(F.broadcast(heads), "_slice")  # as many rows as partitions
    following = F.coalesce("_next", "_after")
    return joined.select(id_col, "_h", "n_chars", following["id"].alias("_next_id"), following["h"].alias("_next_h"))


def with_edited(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row: (id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last half of a text (rounded down) replaced by as many first characters
    of the next document.  The neighbour's text is moved and its fingerprint taken again: that is
    less than the fingerprint would be.
    """
    text = F.coalesce("text", F.lit(""))
    # One key, equal also where the id is null: the joins and the grouping below share their partitioning,
    # and as both joins take all its columns, the texts are shuffled once.
    marked = docs.select(_name(F.col(id_col)).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("text"))
    wanted = written(in_order(docs, id_col), "next").select(
        _name(F.col("_next_id")).alias("_id"),
        F.col("_next_h").alias("_h"),
        _name(F.col(id_col)).alias("_for_id"),
        F.col(id_col).alias("_given_id"),
        F.col("_h").alias("_for_h"),
        "n_chars",
        (F.col("n_chars") / 2).cast("int").alias("_half"),
    )
    given = marked.join(wanted, ["_id", "_h"]).select(
        F.col("_for_id").alias("_id"), F.col("_for_h").alias("_h"), "_given_id", "n_chars", "_half", F.col("text").alias("_next_text")
    )
    # A repeated row hands on its text once.
    given = given.groupBy("_id", "_h").agg(*(F.first(c).alias(c) for c in ("_given_id", "n_chars", "_half", "_next_text")))
    both = marked.join(given, ["_id", "_h"])
    edited = both.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - _half)"), F.expr("substring(_next_text, 1, _half)")))
    found = fingerprint(edited, "text", "fingerprint").drop("text")
    found = fingerprint(found, "_next_text", "_next_fingerprint").drop("_next_text")
    found = found.withColumn("near_next", likeness(F.col("fingerprint"), F.col("_next_fingerprint"))).drop("_next_fingerprint")
    found = fingerprint(found, "edited", "edited_fingerprint")
    return found.select(
        F.col("_given_id").alias(id_col),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        "near_next",
    )
