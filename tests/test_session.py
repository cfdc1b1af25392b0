from flowlens.operators.sampling import exact_percentile
from flowlens.session import DEFAULT_CONF, build_session


def test_shuffle_partitions_stay_the_cluster_s(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        build_session(master=None)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "37"
        assert "spark.sql.shuffle.partitions" not in DEFAULT_CONF
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_percentile_with_nan_and_infinity(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),), (None,)], "x double")
    assert exact_percentile(df, "x", 0.5, band_rows=3) == 4.5
    inf = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    assert exact_percentile(inf, "x", 0.5, band_rows=1) == 1.5
    assert exact_percentile(inf, "x", 1.0, band_rows=1) == float("inf")
