"""The command line drives the same jobs end to end."""

from flowlens.__main__ import main
from flowlens.plans import catalog as C
from flowlens.session import scratch_path
from flowlens.sources import files
from flowlens.sources.testdata import geo_range_dimension, packets, read_table
from flowlens.streaming import jobs


def test_cli_train_then_score(spark, sf_small, capsys):
    log = C._stage_stream_input(spark, sf_small)
    models, out, ckpt, geo = (scratch_path(spark, n) for n in ("cli-m", "cli-o", "cli-c", "cli-g"))
    geo_range_dimension(read_table(spark, sf_small, "nation")).write.parquet(geo)
    assert main(["train-kmeans", "--input", log, "--models", models, "--n-init", "2"], spark=spark) == 0
    assert "inertia" in capsys.readouterr().out
    assert main(["score", "--input", log, "--models", models, "--out", out, "--checkpoint", ckpt,
                 "--geo", geo, "--available-now"], spark=spark) == 0
    n = jobs.read_batches(spark, out).count()
    assert n == decoded_transport(spark, log)


def decoded_transport(spark, log):
    from flowlens.operators import decode
    return decode.keep_transport(files.read_packets_ndjson(spark, log)).count()


def test_cli_forest(spark, sf_small, capsys):
    from pyspark.sql import functions as F
    csv = scratch_path(spark, "cli-csv")
    lines = C.packet_csv_lines(packets(spark, sf_small)).select(
        F.regexp_replace("value", r"\|[0-9]+$", "").alias("value"))     # the 11-column export
    files.write_delimited_lines(lines, C.CSV_COLUMNS[:-1], csv)
    models = scratch_path(spark, "cli-fm")
    assert main(["train-forest", "--input", csv, "--models", models, "--window", "1 hour"], spark=spark) == 0
    assert "threshold" in capsys.readouterr().out
    log = C._stage_stream_input(spark, sf_small)
    out, ckpt = scratch_path(spark, "cli-fo"), scratch_path(spark, "cli-fc")
    assert main(["score-forest", "--input", log, "--models", models, "--out", out, "--checkpoint", ckpt,
                 "--window", "1 hour", "--slide", "20 minutes", "--available-now"], spark=spark) == 0
    assert jobs.read_batches(spark, out).count() > 0
