"""Physical-plan shape: native expressions, broadcast lookups, no pair explosions."""

from flowlens.operators import windows
from flowlens.plans import catalog as C


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_live_scoring_has_no_python_and_broadcasts(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan_text(C.q_live_score(spark, sf_small))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "BroadcastHashJoin" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_exploded_joinback_is_an_equi_join(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = C._timed(spark, sf_small)
        g = windows.window_features(t, "frame_time", "1 hour", "20 minutes", keys=["frame_protocols"])
        p = plan_text(windows.join_back(t, g, "frame_time", "1 hour", "20 minutes", how="inner"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "_pane" in p


def test_narrow_schema_reaches_the_json_scan(spark, tmp_path):
    """The JSON source prunes top-level columns only, so jobs pass the narrow
    packet schema of the leaves they read; the scan then parses only those."""
    from pyspark.sql import functions as F
    from flowlens.schema import SCORING_PACKET
    from flowlens.sources import files
    path = str(tmp_path / "p")
    spark.createDataFrame([('{"timestamp":"1","layers":{"ip":{"ip_ip_src":"1.1.1.1","ip_ip_len":"5"}}}',)],
                          "value string").write.text(path)
    df = files.read_packets_ndjson(spark, path, SCORING_PACKET).select(F.col("layers.ip.ip_ip_src"))
    assert df.first()[0] == "1.1.1.1"
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        p = plan_text(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = p[p.index("ReadSchema"):].split("\n")[0]
    assert "ip_ip_src" in schema
    assert "dns" not in schema and "eth_eth_src" not in schema
