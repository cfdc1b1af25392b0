"""End-to-end jobs: the three programs of a packet-scoring deployment.

* ``train_kmeans_job``: packet log -> scaler + K-Means model tables.
* ``elbow_job``: packet log -> (k, inertia) table for choosing k.
* ``live_score_job``: packet stream -> scored documents (+ quarantine), using
  the model tables.
* ``train_forest_job``: flat packet export -> window features -> isolation
  forest model table (+ held-out predictions file).
* ``live_forest_job``: packet stream -> sliding-window forest scores joined
  back to the packets.

Models are small parquet tables (with version and training time) under one
model folder; every job reads inputs as DataFrames, so the same functions
run on a laptop sample or a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import decode, enrich, features, iforest, kmeans, sampling, windows
from ..schema import FEATURES, WINDOW_FEATURES
from ..session import materialize
from ..sources import sinks
from ..streaming import jobs as stream_jobs


def _train_frame(packets: DataFrame) -> DataFrame:
    feat = features.with_features(decode.keep_transport(packets))
    good, _ = decode.split_quarantine(feat, FEATURES)
    return good


def train_kmeans_job(packets: DataFrame, model_dir: str, k: int = 5, n_init: int = 10,
                     seed: int = 42) -> float:
    """Fit the scaler and K-Means (best of ``n_init``) on decoded packets;
    write ``scaler`` and ``kmeans`` model tables; return the inertia."""
    good = _train_frame(packets)
    scaler = features.fit_scaler(good)
    sinks.save_model_table(scaler, f"{model_dir}/scaler")
    params = features.scaler_params(scaler)
    scaled = features.scale(good, params).select(
        F.transform("scaled_features", lambda v: v.cast("double")).alias("scaled_features"))
    centers, cost = kmeans.train_kmeans(scaled, k, n_init=n_init, seed=seed)
    sinks.save_model_table(centers, f"{model_dir}/kmeans")
    return cost


def elbow_job(packets: DataFrame, ks=range(1, 10), n_init: int = 10, seed: int = 42) -> DataFrame:
    good = _train_frame(packets)
    params = features.scaler_params(features.fit_scaler(good))
    scaled = features.scale(good, params).select(
        F.transform("scaled_features", lambda v: v.cast("double")).alias("scaled_features"))
    return kmeans.elbow(scaled, ks, n_init=n_init, seed=seed)


def load_scoring_models(spark: SparkSession, model_dir: str) -> tuple[DataFrame, DataFrame]:
    return (sinks.load_model_table(spark, f"{model_dir}/scaler"),
            sinks.load_model_table(spark, f"{model_dir}/kmeans"))


def live_score_job(spark: SparkSession, stream: DataFrame, model_dir: str, geo_ranges: DataFrame,
                   out_path: str, checkpoint: str, quarantine_path: str | None = None,
                   threshold: float = 2.6, console: bool = False, available_now: bool = False,
                   trigger_seconds: int | None = None, spread: int | None = None,
                   local_ip: str = enrich.LOCAL_IP):
    scaler, centers = load_scoring_models(spark, model_dir)
    return stream_jobs.start_scoring(stream, geo_ranges, scaler, centers, out_path, checkpoint,
                                     quarantine_path, threshold, console, available_now, trigger_seconds,
                                     spread, local_ip)


def flat_packets(flat: DataFrame) -> DataFrame:
    """Flat export rows -> (row_key, frame_time, timestamp, ip_src, frame_protocols, lengths).

    The export has no packet id; the key is a hash of the whole row, stable
    across recomputation (identical rows share it)."""
    t = parse.tshark_time("frame_time")
    key = F.xxhash64(*[F.col(c) for c in flat.columns])
    return flat.select(key.alias("row_key"), t.alias("frame_time"), parse.epoch_seconds(t).alias("timestamp"),
                       "ip_src", "ip_dst", "frame_protocols", "ip_len", "frame_len",
                       "tcp_srcport", "tcp_dstport")


def train_forest_job(flat: DataFrame, model_dir: str, window: str = "1 minute",
                     predictions_path: str | None = None, n_trees: int = 100, max_samples: int = 256,
                     contamination: float = 0.1, seed: int = 1, split_seed: int = 5043) -> float:
    """Window features per (window, source address, stack) joined back to each
    packet, 70/30 split, forest fit; writes ``iforest`` (nodes) and
    ``iforest_meta`` (psi, threshold) tables; returns the label threshold."""
    spark = flat.sparkSession
    t = flat_packets(flat)
    g = windows.window_features(t, "frame_time", window, keys=["ip_src", "frame_protocols"])
    j = windows.join_back(t, g, "frame_time", window,
                          keys=[("ip_src", "ip_src"), ("frame_protocols", "frame_protocols")], how="left")
    j = materialize(j.withColumn("part", sampling.md5_split_column(
        "row_key", [0.7, 0.3], ["train", "test"], seed=split_seed)))
    train, test = j.filter(F.col("part") == "train"), j.filter(F.col("part") == "test")
    nodes, psi = iforest.fit(train, WINDOW_FEATURES, key="row_key", n_trees=n_trees,
                             max_samples=max_samples, seed=seed)
    nodes = materialize(nodes)
    model = iforest.ForestModel(nodes, psi, n_trees)
    cut = iforest.threshold(iforest.score(train, model, WINDOW_FEATURES), contamination)
    sinks.save_model_table(nodes, f"{model_dir}/iforest")
    sinks.save_model_table(spark.createDataFrame([(psi, n_trees, float(cut))],
                                                 "psi int, n_trees int, threshold double"),
                           f"{model_dir}/iforest_meta")
    if predictions_path:
        scored = iforest.label(iforest.score(test, model, WINDOW_FEATURES), cut, out="predicted_label")
        scored = features.assemble(scored, WINDOW_FEATURES, "features")
        sinks.write_result_csv(scored.select("timestamp", "features", "predicted_label",
                                             F.col("anomaly_score").alias("outlier_score")),
                               predictions_path, vector_cols=("features",))
    return float(cut)


def load_forest(spark: SparkSession, model_dir: str) -> tuple[iforest.ForestModel, float]:
    meta = sinks.load_model_table(spark, f"{model_dir}/iforest_meta").first()
    nodes = sinks.load_model_table(spark, f"{model_dir}/iforest")
    return iforest.ForestModel(nodes, meta["psi"], meta["n_trees"]), meta["threshold"]


def live_forest_job(spark: SparkSession, stream: DataFrame, model_dir: str, out_path: str,
                    checkpoint: str, length: str = "15 seconds", slide: str | None = "5 seconds",
                    available_now: bool = False, trigger_seconds: int | None = None):
    """Sliding-window features of the stream scored by the forest and joined
    back to each packet: (application_protocol, frame_time, anomaly_score, anomaly)."""
    model, cut = load_forest(spark, model_dir)
    return stream_jobs.start_forest_scoring(stream, model, cut, out_path, checkpoint, length, slide,
                                            available_now=available_now, trigger_seconds=trigger_seconds)
