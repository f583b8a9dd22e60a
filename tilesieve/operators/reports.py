"""Reports about clusters, missing data, metadata and coverage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import BYTES_PER_SAMPLE, TILE_BANDS, TILE_SIDE
from ..functions.bands import is_black_tile, zero_value_pct
from ..session import hinted
from .ranking import describe
from .sampling import first_matching, first_matching_in_waves, sample_per_group, semi_sample

# Tiers of the cluster size table, as (label, largest size).
TIERS = (
    ("0", 0),
    ("1-9", 9),
    ("10-99", 99),
    ("100-999", 999),
    ("1,000-9,999", 9_999),
    ("10,000-99,999", 99_999),
    ("100,000+", None),
)
# Percentiles of the no-data report, per class.
CLASS_PERCENTILES = {
    "garbage": (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95),
    "good": (0.50, 0.75, 0.80, 0.90, 0.95, 0.99),
}
PROFILED = ("cloud_cover", "nodata", "centre_lat", "centre_lon")


def size_tiers(stats: DataFrame) -> DataFrame:
    """(tier_no, tier, n_clusters) in order, empty tiers included; one aggregate without a join."""
    size, counts, low = F.col("n_candidates"), [], None
    for _, high in TIERS:
        inside = F.lit(True) if low is None else size > low
        if high is not None:
            inside = inside & (size <= high)
        counts.append(F.count_if(inside))
        low = high
    lines = [
        F.struct(F.lit(i + 1).alias("tier_no"), F.lit(label).alias("tier"), F.col(f"_t{i}").alias("n_clusters"))
        for i, (label, _) in enumerate(TIERS)
    ]
    totals = stats.agg(*[c.alias(f"_t{i}") for i, c in enumerate(counts)])
    return totals.select(F.inline(F.array(*lines)))


def size_histogram(df: DataFrame, col: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """([by,] bin, low, high, n): equal-width bins over the range of the group, the last one closed, empty bins with n = 0.

    A group whose values are all equal gets a range of one around them.
    """
    by = list(by)
    values = df.filter(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("_v"))
    edges = values.groupBy(*by).agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    if by:
        ranged = values.join(hinted(edges), by)
    else:
        one = lambda c: edges.select(c).scalar()
        ranged = values.withColumns({"_a": one("_a"), "_b": one("_b")})
    flat = F.col("_a") == F.col("_b")
    ranged = ranged.withColumns(
        {
            "_low": F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")),
            "_width": F.when(flat, F.lit(1.0)).otherwise(F.col("_b") - F.col("_a")) / bins,
        }
    )
    bin_no = F.least(F.floor((F.col("_v") - F.col("_low")) / F.col("_width")), F.lit(bins - 1)).cast("int")
    counted = ranged.groupBy(*by, "_low", "_width", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # One row per group from here on: its counts, and 0 for the bins that no value fell into.
    held = counted.groupBy(*by, "_low", "_width").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    every = held.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.select(
        *by,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("high"),
        F.coalesce(F.col("_n")[F.col("bin")], F.lit(0)).cast("bigint").alias("n"),
    )


def _long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    lines = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value")) for m in metrics])
    return df.select(*ids, F.inline(lines))


def describe_by_class(
    df: DataFrame, col: str, by: str, percentiles: Mapping[object, Sequence[float]] | None = None
) -> DataFrame:
    """(by, metric, value): count, mean, sample std, min, percentiles, max; each class has its own set."""
    wanted = percentiles or CLASS_PERCENTILES
    probs = sorted({p for ps in wanted.values() for p in ps})
    names = {p: f"p{round(p * 100):02d}" for p in probs}
    full = describe(df, col, probs, [by], [names[p] for p in probs])
    lines = _long(full, [by], ["count", "mean", "std", "min", *names.values(), "max"])
    keep = F.col("metric").isin("count", "mean", "std", "min", "max")
    for value, ps in wanted.items():
        keep = keep | ((F.col(by) == F.lit(value)) & F.col("metric").isin([names[p] for p in ps]))
    return lines.filter(keep)


def profile_metadata(df: DataFrame) -> DataFrame:
    """(column, metric, value): row and column count, nulls per column, describe of known columns."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def missing(name: str) -> Column:
        return F.col(name).isNull() | F.isnan(name) if name in numeric else F.col(name).isNull()

    nulls = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(c)).alias(f"_null_{c}") for c in df.columns])
    lines = [
        F.struct(F.lit("*").alias("column"), F.lit("rows").alias("metric"), F.col("_rows").cast("double").alias("value")),
        F.struct(F.lit("*").alias("column"), F.lit("columns").alias("metric"), F.lit(float(len(df.columns))).alias("value")),
        *[
            F.struct(F.lit(c).alias("column"), F.lit("nulls").alias("metric"), F.col(f"_null_{c}").cast("double").alias("value"))
            for c in df.columns
        ],
    ]
    general = nulls.select(F.inline(F.array(*lines)))
    present = [c for c in PROFILED if c in df.columns]
    if not present:
        return general
    tall = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x")) for c in present]))
    )
    full = describe(tall, "_x", (0.25, 0.5, 0.75), ["column"], ["25%", "50%", "75%"])
    return general.unionByName(_long(full, ["column"], ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]))


def top_values(df: DataFrame, col: str = "cluster_id", n: int = 5) -> DataFrame:
    """(col, n_rows) of the most frequent values; ties to the smaller value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), col).limit(n)


def similarity_counts(sims: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, n_above, n_total): clusters with a similarity strictly above each threshold."""
    totals = sims.agg(
        F.count(F.lit(1)).alias("n_total"),
        *[F.count_if(F.col("similarity") > float(t)).alias(f"_a{i}") for i, t in enumerate(thresholds)],
    )
    lines = [
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_a{i}").alias("n_above"), F.col("n_total"))
        for i, t in enumerate(thresholds)
    ]
    return totals.select(F.inline(F.array(*lines)))


def subset_size_estimate(subset: DataFrame, total: DataFrame) -> DataFrame:
    """One row: tiles, bytes and TB before compression, and the share of all tiles in percent."""
    per_tile = TILE_SIDE * TILE_SIDE * TILE_BANDS * BYTES_PER_SAMPLE
    n_total = total.select(F.count(F.lit(1))).scalar()
    counted = subset.agg(F.count(F.lit(1)).alias("n_tiles"))
    return counted.select(
        "n_tiles",
        (F.col("n_tiles") * F.lit(per_tile).cast("bigint")).alias("bytes"),
        (F.col("n_tiles") * F.lit(per_tile).cast("bigint") / F.lit(1e12)).alias("uncompressed_tb"),
        (F.lit(100.0) * F.col("n_tiles") / n_total).alias("selected_pct"),
    )


def geo_density(df: DataFrame, step: float = 1.0) -> DataFrame:
    """(lat_cell, lon_cell, n_tiles): tiles per cell of ``step`` degrees."""
    held = df.dropna(subset=["centre_lat", "centre_lon"])
    return held.groupBy(
        F.floor(F.col("centre_lat") / F.lit(step)).cast("int").alias("lat_cell"),
        F.floor(F.col("centre_lon") / F.lit(step)).cast("int").alias("lon_cell"),
    ).agg(F.count(F.lit(1)).alias("n_tiles"))


def garbage_clusters(sims: DataFrame, threshold: float = 0.90) -> DataFrame:
    """Ids of the clusters whose similarity to the reference is above the threshold."""
    return sims.filter(F.col("similarity") > threshold).select("cluster_id").distinct()


def dark_clusters(
    tiles: DataFrame, assign: DataFrame, low: float = 30, high: float = 70, most: int | None = None, seed: int = 42, within: int | None = None
) -> DataFrame:
    """Distinct clusters of the half-dark tiles: of all, or of the first ``most`` in shuffled order, or inside a sample."""
    share = zero_value_pct(F.col("B04"), F.col("B03"), F.col("B02"))
    held = tiles.dropna(subset=["B04", "B03", "B02"])
    dark = (share > low) & (share < high)
    if most is None:
        pool = held if within is None else semi_sample(held, within, "row_id", seed)
        return assign.join(pool.filter(dark).select("row_id"), "row_id", "left_semi").select("cluster_id").distinct()
    hits = first_matching(held, dark, most, "row_id", seed, within).select("row_id")
    # at most ``most`` rows
    return assign.join(F.broadcast(hits), "row_id", "left_semi").select("cluster_id").distinct()


def black_tiles(tiles: DataFrame, most: int = 1, seed: int = 42, within: int | None = None) -> DataFrame:
    """The first purely black tiles in shuffled order, optionally inside a sample."""
    black = is_black_tile(F.col("B04"), F.col("B03"), F.col("B02"))
    return first_matching(tiles, black, most, "row_id", seed, within)


def black_tiles_of(
    manifest: DataFrame, read: Callable[[DataFrame], DataFrame], most: int = 1, seed: int = 42, within: int | None = None
) -> DataFrame:
    """As ``black_tiles``, of the tiles that ``read`` fetches for rows of the manifest; it fetches no more than the hits ask for."""
    black = is_black_tile(F.col("B04"), F.col("B03"), F.col("B02"))
    return first_matching_in_waves(manifest, read, black, most, "row_id", seed, within)


def dark_clusters_of(
    manifest: DataFrame, read: Callable[[DataFrame], DataFrame], assign: DataFrame, most: int, low: float = 30, high: float = 70, seed: int = 42, within: int | None = None
) -> DataFrame:
    """As ``dark_clusters`` with ``most``, of the tiles that ``read`` fetches for rows of the manifest."""
    share = zero_value_pct(F.col("B04"), F.col("B03"), F.col("B02"))
    whole = lambda rows: read(rows).dropna(subset=["B04", "B03", "B02"])
    hits = first_matching_in_waves(manifest, whole, (share > low) & (share < high), most, "row_id", seed, within).select("row_id")
    # at most ``most`` rows
    return assign.join(F.broadcast(hits), "row_id", "left_semi").select("cluster_id").distinct()


def split_garbage(assign: DataFrame, garbage: DataFrame) -> DataFrame:
    """(row_id, cluster_id, is_garbage): membership of every tile's cluster in the garbage set."""
    marked = hinted(garbage.select("cluster_id").withColumn("_g", F.lit(True)))
    return assign.select("row_id", "cluster_id").join(marked, "cluster_id", "left").select(
        "row_id", "cluster_id", F.coalesce("_g", F.lit(False)).alias("is_garbage")
    )


def garbage_tally(split: DataFrame) -> DataFrame:
    return split.groupBy("is_garbage").agg(F.count(F.lit(1)).alias("n_tiles"))


def labelled_sample(
    split: DataFrame, tiles: DataFrame, garbage: int | None = None, good: int | None = None, seed: int = 42
) -> DataFrame:
    """(idx, cluster, is_garbage, black_pct) of all tiles, or of a sample of both classes where both sizes are given."""
    if (garbage is None) != (good is None):
        raise ValueError("give the sizes of both classes or of none")
    chosen = split if garbage is None else F.broadcast(sample_per_group(split, "is_garbage", {True: garbage, False: good}, "row_id", seed))
    share = zero_value_pct(F.col("B04"), F.col("B03"), F.col("B02"))
    # a sample is broadcast: at most garbage + good rows, and the pixels of other tiles are not looked at
    drawn = tiles.join(chosen, "row_id").dropna(subset=["B04", "B03", "B02"])
    return drawn.select(
        F.col("row_id").alias("idx"), F.col("cluster_id").alias("cluster"), "is_garbage", share.alias("black_pct")
    )
