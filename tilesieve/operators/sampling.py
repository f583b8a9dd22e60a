"""Seeded samples.  Random order means the order of md5(key-seed), which any engine can repeat."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .ranking import running_total, top_n_per_group

# Up to this many rows a global top-n is taken directly.
DIRECT_LIMIT = 1_000
# Up to this many sampled keys are broadcast to the table they were drawn from.
BROADCAST_KEYS = 1_000_000
# Rows of a first wave for each wanted one, and how many times as far the next wave reaches.
FIRST_WAVE, WAVE_GROWTH = 16, 4


def shuffle_key(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def _hash_bucket(key: str, seed: int) -> Column:
    return F.conv(F.substring(shuffle_key(key, seed), 1, 4), 16, 10).cast("int")


def sample_exact(df: DataFrame, n: int, key: str = "row_id", seed: int = 42, direct: int = DIRECT_LIMIT) -> DataFrame:
    """Exactly n rows without replacement (all rows where the table has no more than n).

    Beyond ``direct`` rows no task sees the sample as a whole: the rows are counted in 65,536
    buckets of the hash, all buckets below the one that holds the n-th row are kept by a filter,
    and only that one bucket is sorted.
    """
    if n <= direct:
        return df.withColumn("_h", shuffle_key(key, seed)).orderBy("_h", key).limit(n).drop("_h")
    histogram = df.groupBy(_hash_bucket(key, seed).alias("b")).count().toPandas().sort_values("b")
    reach = np.cumsum(histogram["count"].to_numpy())
    if len(reach) == 0 or reach[-1] <= n:
        return df
    i = int(np.searchsorted(reach, n))
    edge, missing = int(histogram["b"].iloc[i]), n - (int(reach[i - 1]) if i else 0)
    below = df.filter(_hash_bucket(key, seed) < edge)
    rest = df.filter(_hash_bucket(key, seed) == edge).withColumn("_h", shuffle_key(key, seed))
    return below.unionByName(rest.orderBy("_h", key).limit(missing).drop("_h"))


def sample_fraction(df: DataFrame, fraction: float, key: str = "row_id", seed: int = 42) -> DataFrame:
    """int(N x fraction) rows; the table itself where the fraction is 1 or more."""
    if fraction >= 1.0:
        return df
    return sample_exact(df, int(df.count() * fraction), key, seed)


def sample_per_group(
    df: DataFrame, group: str, caps: Mapping[object, int], key: str = "row_id", seed: int = 42
) -> DataFrame:
    """Up to caps[g] random rows of every listed group."""
    cap = F.lit(None).cast("bigint")
    for value, most in caps.items():
        cap = F.when(F.col(group) == F.lit(value), F.lit(most)).otherwise(cap)
    hashed = df.withColumn("_h", shuffle_key(key, seed))
    ranked = top_n_per_group(hashed, [group], ["_h", key], max(caps.values()), "_rn")
    return ranked.filter(F.col("_rn") <= cap).drop("_h", "_rn")


def semi_sample(df: DataFrame, n: int, key: str = "row_id", seed: int = 42) -> DataFrame:
    """The rows of an exact sample, drawn on the key column alone: payload is read only for hits."""
    drawn = sample_exact(df.select(key), n, key, seed)
    return df.join(F.broadcast(drawn) if n <= BROADCAST_KEYS else drawn, key, "left_semi")


def first_matching(
    df: DataFrame, predicate: Column, k: int, key: str = "row_id", seed: int = 42, within: int | None = None
) -> DataFrame:
    """First k rows in shuffled order that satisfy the predicate, optionally inside a sample."""
    pool = df if within is None else semi_sample(df, within, key, seed)
    return pool.filter(predicate).withColumn("_h", shuffle_key(key, seed)).orderBy("_h", key).limit(k).drop("_h")


def first_matching_in_waves(
    keys: DataFrame,
    read: Callable[[DataFrame], DataFrame],
    predicate: Column,
    k: int,
    key: str = "row_id",
    seed: int = 42,
    within: int | None = None,
    first: int | None = None,
) -> DataFrame:
    """As ``first_matching``, for rows whose payload ``read`` fetches by their keys: few are fetched for few hits.

    The keys are taken in waves of the shuffled order.  A wave ends where the next ``WAVE_GROWTH``
    times as many keys are reached, and only its rows are fetched and tested; every hit of a wave
    comes before all rows of later ones, so the search ends with the wave that holds the k-th hit.
    Without enough hits every row is fetched once.  ``first`` is the size of the first wave.
    """
    pool = keys if within is None else written(sample_exact(keys, within, key, seed), "pool")
    total = keys.count()
    most = total if within is None else min(within, total)
    place = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("bigint")
    size, lower, span = max(1, first or FIRST_WAVE * k), 0, 16**8
    hits, missing = [], k
    while True:
        upper = span if size >= most else max(lower + 1, span * size // total)
        wave = pool.filter((place >= lower) & (place < upper))
        found = read(wave).filter(predicate).withColumn("_h", shuffle_key(key, seed)).orderBy("_h", key).limit(missing).drop("_h")
        hits.append(written(found, "hits"))
        missing -= hits[-1].count()
        if not missing or upper == span:
            break
        lower, size = upper, size * WAVE_GROWTH
    result = hits[0]
    for more in hits[1:]:
        result = result.unionByName(more)
    return result


def truncate(df: DataFrame, n: int, key: str = "row_id", direct: int = DIRECT_LIMIT) -> DataFrame:
    """First n rows by position; large n look up the n-th key and filter, so payload never moves."""
    if n <= direct:
        return df.orderBy(key).limit(n)
    reached = running_total(df.select(key), [], [key], None, "_rn").filter(F.col("_rn") <= n)
    last = reached.agg(F.max(key)).first()[0]
    return df.filter(F.col(key) <= F.lit(last))


def pick_clusters(assign: DataFrame, min_size: int = 5, k: int = 3, seed: int = 42) -> DataFrame:
    """k random clusters among those with at least min_size members."""
    sizes = assign.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return sample_exact(sizes.filter(F.col("n") >= min_size), k, "cluster_id", seed)


__all__ = ["first_matching", "first_matching_in_waves", "pick_clusters", "sample_exact", "sample_fraction", "sample_per_group", "shuffle_key", "truncate"]
