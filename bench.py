"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed (``write.format("noop")``, so every
row and column is computed but nothing is stored); the time includes the
small jobs a query runs while planning (model fits, size checks).  A short
warm-up at sf0.001 runs first so JVM start-up is not billed to one query.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from flowlens.plans import catalog as C  # noqa: E402
from flowlens.session import build_session  # noqa: E402

HEADLINE = [
    "live_score",             # (a) batch decode-free enrich + score
    "lineitem_score",         #     the same over lineitem rows (6x the packets)
    "stream_score",           # (b) availableNow file stream of the same
    "window_sliding_15s",     # (c) sliding aggregate 15 s / 5 s
    "window_sliding",         #     sliding aggregate 1 h / 20 min
    "window_joinback_inner",  # (d) join-back, exploded equi-join
    "window_joinback_left",
    "ndjson_decode",          # NDJSON capture log round trip
    "geo_enrich",             # memoised exact-address lookups
    "score_percentile",       # exact distributed percentile
    "iforest_score",          # (e) forest fit + score
]


def run(spark, name: str, sf_dir: str) -> tuple[float, int]:
    t0 = time.perf_counter()
    df = C.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def extras(spark, sf_dir: str) -> dict:
    """
    pre-fitted models, naive vs exploded join-back, K-Means and forest fits."""
    from flowlens.operators import iforest, kmeans, windows
    from flowlens.plans import live
    from flowlens.schema import WINDOW_FEATURES
    from flowlens.session import materialize
    from flowlens.sources import files
    from flowlens.streaming import jobs as sj
    from flowlens.session import scratch_path

    def timed(fn):
        t0 = time.perf_counter()
        fn()
        return round(time.perf_counter() - t0, 3)

    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    out = {}
    scaled, params = C._scaled(spark, sf_dir)
    centers = C._centers(scaled)
    ranges = C._ranges(spark, sf_dir)
    pk = C._packets(spark, sf_dir)
    out["score_prefitted_sec"] = timed(lambda: noop(live.score_packets(pk, ranges, params, centers)[0]))
    src = C._stage_stream_input(spark, sf_dir)
    out["score_ndjson_prefitted_sec"] = timed(lambda: noop(live.score_packets(
        files.read_packets_ndjson(spark, src, C.SCORING_PACKET), ranges, params, centers)[0]))

    def stream():
        o, ck = scratch_path(spark, "bx-out"), scratch_path(spark, "bx-ck")
        q = sj.start_scoring(files.stream_packets_ndjson(spark, src, C.SCORING_PACKET), ranges, params,
                             centers, o, ck, available_now=True)
        q.awaitTermination()
    out["stream_availablenow_prefitted_sec"] = timed(stream)
    t = materialize(C._timed(spark, sf_dir))
    for length, slide in (("15 seconds", "5 seconds"), ("1 hour", "20 minutes")):
        g = materialize(windows.window_features(t, "frame_time", length, slide, keys=["frame_protocols"]))
        for method in ("exploded", "naive"):
            key = f"joinback_{method}_{length.split()[0]}{length.split()[1][0]}_sec"
            out[key] = timed(lambda: noop(windows.join_back(t, g, "frame_time", length, slide, method=method)))
    out["kmeans_fit_k5_10_restarts_sec"] = timed(lambda: kmeans.train_kmeans(scaled, 5, n_init=10, key="packet_id"))
    j = materialize(C.iforest_frame(spark, sf_dir).select("packet_id", *WINDOW_FEATURES))
    holder = {}
    out["forest_fit_sec"] = timed(lambda: holder.update(
        m=iforest.ForestModel(*iforest.fit(j, WINDOW_FEATURES, key="packet_id"))))
    out["forest_score_sec"] = timed(lambda: noop(iforest.score(j, holder["m"], WINDOW_FEATURES)))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="flowlens-bench",
                          shuffle_partitions=max(8, 2 * int(cpus)),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    run(spark, "live_score", "/root/testdata/sf0.001")  # warm-up, not reported
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    lineitems = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times = {}
    for n in names:
        times[n] = round(run(spark, n, sf_dir), 3)
    extra = extras(spark, sf_dir) if os.environ.get("BENCH_EXTRAS") == "1" else None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
        "packets": events,
        "rows_per_sec": {n: round((lineitems if n == "lineitem_score" else events) / t)
                         for n, t in times.items() if t > 0},
    }
    if extra:
        out["extras"] = extra
    print(json.dumps(out))


if __name__ == "__main__":
    main()
