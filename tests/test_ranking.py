"""Ranks, running totals and percentiles; one group holds a third of all rows."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tilesieve.operators import ranking, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; cluster 0 has a third of them, all at one distance."""
    return (
        spark.range(3000)
        .withColumnRenamed("id", "row_id")
        .withColumn("cluster_id", F.when(F.col("row_id") % 3 == 0, 0).otherwise((F.col("row_id") % 97 + 1).cast("int")))
        .withColumn("d2", F.when(F.col("cluster_id") == 0, 0.5).otherwise((F.col("row_id") * 7919 % 1009) / 1009.0))
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("by", [["cluster_id"], []])
def test_running_total_is_the_window(spark, skewed, by):
    window = Window.partitionBy(*(by or [F.lit(0)])).orderBy("d2", "row_id")
    want = skewed.withColumn("running", F.sum("row_id").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    got = ranking.running_total(skewed, by, ["d2", "row_id"], "row_id")
    assert rows(got.select(want.columns)) == rows(want)


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_rank_forms_agree(spark, skewed, partitions):
    df = skewed.repartition(partitions)
    plain = ranking.rank_within(df, ["cluster_id"], ["d2", "row_id"])
    sliced = ranking.rank_within(df, ["cluster_id"], ["d2", "row_id"], large=10)
    assert rows(plain.select("row_id", "rn")) == rows(sliced.select("row_id", "rn"))


def test_top_n_forms_agree(spark, skewed):
    a = ranking.top_n_per_group(skewed, ["cluster_id"], ["d2", "row_id"], 40)
    b = ranking.top_n_per_group(skewed, ["cluster_id"], ["d2", "row_id"], 40, limit=1)
    assert rows(a.select("row_id", "rn")) == rows(b.select("row_id", "rn"))
    assert a.filter("cluster_id = 0").count() == 40


def test_top_n_is_cut_before_the_shuffle(spark, skewed):
    plan = ranking.top_n_per_group(skewed, ["cluster_id"], ["d2", "row_id"], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_first_per_group(spark, skewed):
    got = ranking.first_per_group(skewed, ["cluster_id"], ["d2", "row_id"])
    want = ranking.top_n_per_group(skewed, ["cluster_id"], ["d2", "row_id"], 1).drop("rn")
    assert rows(got.select(want.columns)) == rows(want)


def test_exact_percentiles_with_many_equal_values(spark, skewed):
    probs = [0.0, 0.05, 0.3, 0.5, 0.77, 1.0]
    data = np.array([r[0] for r in skewed.select("d2").collect()])
    got = ranking.exact_percentiles(skewed, "d2", probs).first()
    assert np.allclose(list(got), np.percentile(data, [100 * p for p in probs]), atol=1e-12)
    groups = skewed.withColumn("hot", F.col("cluster_id") == 0)
    for row in ranking.exact_percentiles(groups, "d2", probs, ["hot"]).collect():
        part = np.array([r[0] for r in groups.filter(F.col("hot") == row["hot"]).select("d2").collect()])
        assert np.allclose(list(row)[1:], np.percentile(part, [100 * p for p in probs]), atol=1e-12)


@pytest.mark.parametrize("n", [1, 50, 1000, 2999, 3000, 5000])
def test_sample_forms_agree(spark, skewed, n):
    direct = sampling.sample_exact(skewed, n, direct=10**6)
    bucketed = sampling.sample_exact(skewed, n, direct=0)
    assert rows(direct) == rows(bucketed)
    assert bucketed.count() == min(n, 3000)


@pytest.mark.parametrize("n", [1, 77, 3000, 4000])
def test_truncate_forms_agree(spark, skewed, n):
    assert rows(sampling.truncate(skewed, n)) == rows(sampling.truncate(skewed, n, direct=0))


def test_sample_per_group_caps(spark, skewed):
    marked = skewed.withColumn("hot", F.col("cluster_id") == 0)
    got = sampling.sample_per_group(marked, "hot", {True: 5, False: 12})
    assert {r["hot"]: r["count"] for r in got.groupBy("hot").count().collect()} == {True: 5, False: 12}


def test_fraction_of_one_is_the_table(spark, skewed):
    assert sampling.sample_fraction(skewed, 1.0) is skewed
    assert sampling.sample_fraction(skewed, 0.1234).count() == int(3000 * 0.1234)


def test_null_groups_are_ranked_alike_in_both_forms(spark):
    from tilesieve.operators.ranking import rank_within

    frame = spark.createDataFrame([(None if i % 2 else 1, i) for i in range(10)], "g int, v int")
    plain = sorted((r.g or 0, r.v, r.rn) for r in rank_within(frame, ["g"], ["v"]).collect())
    assert plain == sorted((r.g or 0, r.v, r.rn) for r in rank_within(frame, ["g"], ["v"], large=1).collect()) and len(plain) == 10
