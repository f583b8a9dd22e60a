"""Running totals, ranks and top-n per group that hold when one group owns a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import hinted, written

# Largest group that one task sorts by itself; the slices give the same ranks.
LARGE_GROUP = 100_000
# Largest n for which the group-limit form of top-n is used.
TOP_N_LIMIT = 10_000
# A group is first cut to n rows in this many independent pieces.
SALTS = 32

Order = Sequence[str | Column]


def _columns(order: Order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def running_total(
    df: DataFrame, by: Sequence[str], order: Order, weight: str | None = None, out: str = "running"
) -> DataFrame:
    """Inclusive running sum of ``weight`` (of 1 where absent) per group, without a task per group.

    Rows are range-partitioned on (group, order), so a hot group is spread over as many slices as
    its size asks for.  The slices are written once, which fixes which row lies in which slice;
    each slice sums its own rows and adds the total of the slices before it.  (group, order) has
    to identify a row; null groups count as groups.
    """
    keys, sort = [F.col(c) for c in by], _columns(order)
    amount = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    staged = written(
        df.repartitionByRange(*keys, *sort).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and group: at most (number of slices + number of groups) rows.
    offsets = (
        staged.groupBy(*by, "_slice")
        .agg(F.sum(amount).alias("_sum"))
        .select(*by, "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    renamed = offsets.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_slice").alias("_of"), "_before")
    same = F.col("_slice") == F.col("_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return (
        staged.join(renamed, same)
        .withColumn(out, F.sum(amount).over(inside) + F.col("_before"))
        .drop("_slice", "_before", "_of", *[f"_by{i}" for i in range(len(by))])
    )


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Row count of the biggest group (of the table where ``by`` is empty)."""
    if not by:
        return df.count()
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def rank_within(
    df: DataFrame, by: Sequence[str], order: Order, out: str = "rn", large: int | None = None, size: int | None = None
) -> DataFrame:
    """1-based rank per group; the window form while every group is small, slices beyond that.

    ``size`` is an upper bound of the group size, where the caller knows one without a count.
    """
    if (largest_group(df, by) if size is None else size) > (LARGE_GROUP if large is None else large):
        return running_total(df, by, order, None, out)
    window = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)])).orderBy(*_columns(order))
    return df.withColumn(out, F.row_number().over(window).cast("bigint"))


def top_n_per_group(
    df: DataFrame, by: Sequence[str], order: Order, n: int, out: str = "rn", limit: int | None = None
) -> DataFrame:
    """First ``n`` rows per group with their rank.

    Up to ``limit`` the rank filter is a literal, so Spark cuts every map partition to n rows per
    group before the shuffle; a second, salted cut keeps the last task at SALTS x n rows however
    many partitions feed a hot group.  Larger n rank the whole table in slices.
    """
    if n > (TOP_N_LIMIT if limit is None else limit):
        return rank_within(df, by, order, out).filter(F.col(out) <= n)
    sort, keys = _columns(order), [F.col(c) for c in by]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*sort), F.lit(SALTS)).cast("int"))
    piece = Window.partitionBy(*keys, "_salt").orderBy(*sort)
    whole = Window.partitionBy(*keys).orderBy(*sort)
    return (
        salted.withColumn(out, F.row_number().over(piece))
        .filter(F.col(out) <= n)
        .drop(out, "_salt")
        .withColumn(out, F.row_number().over(whole).cast("bigint"))
        .filter(F.col(out) <= n)
    )


def first_per_group(df: DataFrame, by: Sequence[str], order: Order) -> DataFrame:
    """The first row of every group; an aggregate, so map tasks already reduce a hot group."""
    rest = [c for c in df.columns if c not in by]
    return (
        df.groupBy(*by)
        .agg(F.min_by(F.struct(*rest), F.struct(*_columns(order))).alias("_first"))
        .select(*by, *[F.col(f"_first.`{c}`").alias(c) for c in rest])
    )


def describe(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None
) -> DataFrame:
    """Per group: count, mean, std (sample), min, max and exact percentiles, linearly interpolated.

    Equal values are counted first (map-side), then a running total over the distinct values
    locates the two neighbours of every wanted rank.  No task holds a whole group, and the table
    itself is read once.
    """
    names = list(names or [f"p{round(p * 100):02d}" for p in probs])
    by = list(by) or ["_all"]
    frame = df if by != ["_all"] else df.withColumn("_all", F.lit(0))
    counted = (
        frame.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = running_total(counted, by, ["_v"], "_n", "_cum")
    spans = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    totals = (
        placed.groupBy(*by)
        .agg(F.max("_cum").alias("_total"), (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("_mean"))
        .withColumn("_ranks", F.array_distinct(F.array(*[f(pos) for pos in spans for f in (F.floor, F.ceil)])))
    )
    # Ranks are 0-based; a distinct value covers the ranks [cum - n, cum).
    covered = F.filter("_ranks", lambda r: (F.col("_cum") - F.col("_n") <= r) & (r < F.col("_cum")))
    hits = F.transform(covered, lambda r: F.struct(r.alias("rank"), F.col("_v").alias("value")))
    gap = F.col("_v") - F.col("_mean")
    found = placed.join(hinted(totals), by).withColumn("_hits", hits).groupBy(*by, "_total", "_mean").agg(
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.sum(F.col("_n") * gap * gap).alias("_spread"),
        # two ranks per probability, whatever the size of the group
        F.map_from_entries(F.flatten(F.collect_list(F.when(F.size("_hits") > 0, F.col("_hits"))))).alias("_at"),
    )

    def between(pos: Column) -> Column:
        low, high = F.col("_at")[F.floor(pos)], F.col("_at")[F.ceil(pos)]
        return low + (high - low) * (pos - F.floor(pos))

    result = found.select(
        *by,
        F.col("_total").alias("count"),
        F.col("_mean").alias("mean"),
        F.when(F.col("_total") > 1, F.sqrt(F.col("_spread") / (F.col("_total") - 1))).alias("std"),
        "min",
        *[between(pos).alias(name) for pos, name in zip(spans, names)],
        "max",
    )
    return result.drop("_all")


def exact_percentiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None
) -> DataFrame:
    """The percentile columns of describe."""
    return describe(df, value, probs, by, names).drop("count", "mean", "std", "min", "max")
