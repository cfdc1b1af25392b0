"""End-to-end jobs: train models into tables, then score streams with them."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.plans import catalog as C
from flowlens.plans import jobs
from flowlens.schema import PACKET_CSV
from flowlens.session import scratch_path
from flowlens.sources import files
from flowlens.sources.testdata import geo_range_dimension, packets, read_table
from flowlens.streaming import jobs as stream_jobs


def test_kmeans_train_then_stream_score(spark, sf_small):
    models = scratch_path(spark, "models")
    cost = jobs.train_kmeans_job(packets(spark, sf_small), models, k=5, n_init=2)
    assert cost > 0
    centers = spark.read.parquet(f"{models}/kmeans")
    assert centers.count() == 5 and "model_version" in centers.columns
    src = C._stage_stream_input(spark, sf_small)
    out, q_out, ckpt = (scratch_path(spark, n) for n in ("js-out", "js-q", "js-ckpt"))
    q = jobs.live_score_job(spark, files.stream_packets_ndjson(spark, src), models,
                            geo_range_dimension(read_table(spark, sf_small, "nation")), out, ckpt,
                            quarantine_path=q_out, available_now=True)
    q.awaitTermination()
    scored = stream_jobs.read_batches(spark, out)
    transport = C.q_transport_filter(spark, sf_small).agg(F.sum("packets")).first()[0]
    assert scored.count() == transport
    assert {r.anomaly for r in scored.select("anomaly").distinct().collect()} <= {"ANOMALY", "NORMAL"}


def test_forest_train_from_csv_then_stream(spark, sf_small):
    csv = scratch_path(spark, "csv")
    files.write_delimited_lines(C.packet_csv_lines(packets(spark, sf_small)), C.CSV_COLUMNS, csv)
    schema = T.StructType([*PACKET_CSV.fields, T.StructField("frame_number", T.LongType(), True)])
    flat = files.read_packet_csv(spark, csv, schema).drop("frame_number")
    models, preds = scratch_path(spark, "fmodels"), scratch_path(spark, "preds")
    cut = jobs.train_forest_job(flat, models, window="1 hour", predictions_path=preds, n_trees=20)
    assert 0 < cut < 1
    p = spark.read.option("header", True).csv(preds)
    assert set(p.columns) == {"timestamp", "features", "predicted_label", "outlier_score"}
    assert p.count() > 0
    src = C._stage_stream_input(spark, sf_small)
    out, ckpt = scratch_path(spark, "fs-out"), scratch_path(spark, "fs-ckpt")
    q = jobs.live_forest_job(spark, files.stream_packets_ndjson(spark, src), models, out, ckpt,
                             length="1 hour", slide="20 minutes", available_now=True)
    q.awaitTermination()
    res = stream_jobs.read_batches(spark, out)
    assert res.count() > 0
    assert {r.anomaly for r in res.select("anomaly").distinct().collect()} <= {0, 1}
    assert "application_protocol" in res.columns
