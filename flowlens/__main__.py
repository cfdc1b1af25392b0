"""Command line: ``python -m flowlens <command> ...`` (or via spark-submit).

    train-kmeans  --input LOG_DIR --models DIR [--k 5] [--n-init 10]
    elbow         --input LOG_DIR [--kmax 9] [--n-init 10]
    score         --input LOG_DIR | --kafka SERVERS [--topic packets] --models DIR
                  --out DIR --checkpoint DIR [--geo PARQUET] [--quarantine DIR] [--local-ip IP]
                  [--console] [--available-now] [--trigger-seconds N] [--spread N]
    train-forest  --input CSV_DIR --models DIR [--predictions DIR] [--window "1 minute"]
    score-forest  --input LOG_DIR --models DIR --out DIR --checkpoint DIR
                  [--window "15 seconds"] [--slide "5 seconds"] [--available-now]

Inputs are NDJSON capture logs (bulk-index action lines allowed) or a
pipe-delimited export for the forest; models are the parquet tables written
by the training commands.
"""

from __future__ import annotations

import argparse
import sys

from .operators.enrich import LOCAL_IP
from .schema import PACKET_CSV, SCORING_PACKET
from .session import build_session


def _geo(spark, path):
    if path:
        return spark.read.parquet(path)
    return spark.createDataFrame([], "ip_start bigint, ip_end bigint, city string, lon float, lat float")


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="flowlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("train-kmeans")
    a.add_argument("--input", required=True)
    a.add_argument("--models", required=True)
    a.add_argument("--k", type=int, default=5)
    a.add_argument("--n-init", type=int, default=10)
    a = sub.add_parser("elbow")
    a.add_argument("--input", required=True)
    a.add_argument("--kmax", type=int, default=9)
    a.add_argument("--n-init", type=int, default=10)
    a = sub.add_parser("score")
    a.add_argument("--input")
    a.add_argument("--kafka")
    a.add_argument("--topic", default="packets")
    a.add_argument("--models", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--geo")
    a.add_argument("--quarantine")
    a.add_argument("--local-ip", default=LOCAL_IP)
    a.add_argument("--threshold", type=float, default=2.6)
    a.add_argument("--console", action="store_true")
    a.add_argument("--available-now", action="store_true")
    a.add_argument("--trigger-seconds", type=int)
    a.add_argument("--spread", type=int)
    a = sub.add_parser("train-forest")
    a.add_argument("--input", required=True)
    a.add_argument("--models", required=True)
    a.add_argument("--predictions")
    a.add_argument("--window", default="1 minute")
    a = sub.add_parser("score-forest")
    a.add_argument("--input", required=True)
    a.add_argument("--models", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--window", default="15 seconds")
    a.add_argument("--slide", default="5 seconds")
    a.add_argument("--available-now", action="store_true")
    args = p.parse_args(argv)

    from .plans import jobs
    from .sources import files
    if spark is None:
        spark = build_session(master=None)  # master from spark-submit / defaults
    if args.cmd == "train-kmeans":
        cost = jobs.train_kmeans_job(files.read_packets_ndjson(spark, args.input), args.models,
                                     k=args.k, n_init=args.n_init)
        print(f"inertia {cost:.4f}")
    elif args.cmd == "elbow":
        jobs.elbow_job(files.read_packets_ndjson(spark, args.input), range(1, args.kmax + 1),
                       n_init=args.n_init).orderBy("k").show(truncate=False)
    elif args.cmd == "score":
        if args.kafka:
            stream = files.stream_packets_kafka(spark, args.kafka, args.topic, SCORING_PACKET)
        else:
            stream = files.stream_packets_ndjson(spark, args.input, SCORING_PACKET)
        q = jobs.live_score_job(spark, stream, args.models, _geo(spark, args.geo), args.out, args.checkpoint,
                                quarantine_path=args.quarantine, threshold=args.threshold, console=args.console,
                                available_now=args.available_now, trigger_seconds=args.trigger_seconds,
                                spread=args.spread, local_ip=args.local_ip)
        q.awaitTermination()
    elif args.cmd == "train-forest":
        flat = files.read_packet_csv(spark, args.input, PACKET_CSV)
        cut = jobs.train_forest_job(flat, args.models, window=args.window, predictions_path=args.predictions)
        print(f"threshold {cut:.6f}")
    elif args.cmd == "score-forest":
        q = jobs.live_forest_job(spark, files.stream_packets_ndjson(spark, args.input), args.models, args.out,
                                 args.checkpoint, args.window, args.slide, available_now=args.available_now)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
