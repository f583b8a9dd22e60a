"""Queries against their SQL on tables larger than the smallest given ones."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare


@pytest.fixture(scope="module")
def larger(spark, sf_dir, tmp_path_factory):
    """Eight shifted copies of the given embeddings, the elements of each rotated, so that no two are equal."""
    path = str(tmp_path_factory.mktemp("larger"))
    held = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    span = held.agg(F.max("vec_id")).first()[0] + 1
    copies = held.crossJoin(spark.range(8).withColumnRenamed("id", "_c"))
    turned = F.expr("concat(slice(embedding, 7 * _c + 1, 64 - 7 * _c), slice(embedding, 1, 7 * _c))")
    made = copies.select((F.col("vec_id") + F.col("_c") * span).cast("bigint").alias("vec_id"), turned.alias("embedding"), "label")
    made.coalesce(1).write.parquet(f"{path}/parts")
    (file,) = [f for f in spark.read.parquet(f"{path}/parts").inputFiles()]
    (tmp_path_factory.getbasetemp() / path / "embeddings.parquet").symlink_to(file.replace("file://", ""))
    return path


@pytest.mark.parametrize("name", ["describe_by_class", "write_labelled_sample_csv"])
def test_more_tiles_than_the_sample_takes(spark, larger, name):
    """Both classes have more tiles than the SQL samples."""
    db = compare.connect(larger)
    assert compare.check(spark, db, contract.queries()[name], contract.oracle_sql()[name], larger) is None


def test_turned_tiles_tie_as_in_the_sql(spark, larger):
    """A turned tile has the channel means of the tile itself, so the smaller row_id is chosen."""
    db = compare.connect(larger)
    assert compare.check(spark, db, contract.queries()["run_steps"], contract.oracle_sql()["run_steps"], larger) is None
