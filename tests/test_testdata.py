"""Reading of the input tables: rows over the cores."""

import pytest
from pyspark.sql import functions as F

from flowlens.sources import testdata


def _one_row_group(spark, path, rows):
    spark.range(rows).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("t")).coalesce(1).write.parquet(path)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_row_group_of_many_splits_is_dealt_out(spark, tmp_path, small_splits, monkeypatch):
    """Splits by bytes look even, but one task reads the whole row group."""
    _one_row_group(spark, str(tmp_path / "t.parquet"), 20_000)
    cores = spark.sparkContext.defaultParallelism
    raw = testdata.read_table(spark, str(tmp_path), "t")
    assert raw.rdd.getNumPartitions() > cores
    assert max(raw.rdd.glom().map(len).collect()) == 20_000
    df = testdata.read_table(spark, str(tmp_path), "t", key="k")
    sizes = df.rdd.glom().map(len).collect()
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / cores
    monkeypatch.setattr(testdata, "SPREAD_ROWS", 1000)
    sizes = testdata.read_table(spark, str(tmp_path), "t", key="k").rdd.glom().map(len).collect()
    assert len(sizes) == 20 and sum(sizes) == 20_000


def test_even_and_empty_inputs_are_left_alone(spark, tmp_path):
    even = spark.range(8000, numPartitions=8).withColumnRenamed("id", "k")
    assert testdata.spread(even, "k") is even
    none = spark.range(0, numPartitions=8).withColumnRenamed("id", "k")
    assert testdata.spread(none, "k").count() == 0
