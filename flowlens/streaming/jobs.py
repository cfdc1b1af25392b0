"""Structured Streaming jobs built from the batch operators.

Every job takes a streaming DataFrame of decoded packets (from a directory
of NDJSON files or a Kafka topic) and writes through checkpointed sinks, so
a restarted query resumes from its last committed micro-batch:

* ``start_scoring``: live scoring (map-only + stream-static broadcast
  lookups) into one ``foreachBatch`` feeding several sinks.
* ``start_window_features``: watermark + sliding/tumbling window aggregate
  in append mode (a window is emitted once the watermark passes its end).
* ``start_joinback``: the window aggregate joined back to the packets in
  the same query (stream-stream join on the protocol stack, the pane and a
  salt; a packet is held once).  The join also
  states the time range a packet can have relative to its window's event
  time (``window_time``), which the equi-keys already imply; with it Spark
  evicts join state once the watermark passes, so state stays bounded by
  the window length instead of growing with the stream.

One checkpoint folder per query, under the shared checkpoint root.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import parse
from ..functions.protocol import resolve_protocol
from ..operators import decode, enrich, windows
from ..session import materialize
from ..plans import live
from ..sources import sinks

WATERMARK = "10 seconds"


def _writer(df: DataFrame, checkpoint: str, available_now: bool, trigger_seconds: int | None):
    w = df.writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w


def with_packet_id(df: DataFrame) -> DataFrame:
    return df.withColumn("packet_id", F.col("layers.frame.frame_frame_number").try_cast("bigint"))


def quarantine_folder(out_path: str) -> str:
    """Default place of quarantined rows: beside the output folder."""
    return f"{out_path.rstrip('/')}_quarantine"


def start_scoring(stream: DataFrame, geo_ranges: DataFrame, scaler, centers, out_path: str,
                  checkpoint: str, quarantine_path: str | None = None, threshold: float = 2.6,
                  console: bool = False, available_now: bool = False,
                  trigger_seconds: int | None = None, spread: int | None = None,
                  local_ip: str = enrich.LOCAL_IP) -> StreamingQuery:
    """Score a packet stream; scored rows and quarantined rows written per micro-batch.

    Every transport packet and every line that does not decode ends in one of
    the two outputs.  Quarantined rows keep ``reason`` and ``raw`` (the line, or
    the packet's layers as JSON); their folder is ``quarantine_path``, by default
    that of :func:`quarantine_folder`.  ``local_ip`` is the host's own address.

    ``spread``: spread each micro-batch over this many tasks before scoring,
    for sources that deliver few partitions per batch (small files, a
    single-partition topic).  Scoring is map-only, so this is the only
    shuffle; leave it unset when the source is already split finely (or use
    the Kafka source's ``minPartitions``)."""
    packets = with_packet_id(stream)
    if spread:
        packets = packets.repartition(spread)
    # The lookup table is static: bucket and write it once, so every
    # micro-batch broadcasts a small stored table instead of re-deriving it.
    geo_ranges = enrich.bounded_broadcast(materialize(enrich.bucket_ranges(
        geo_ranges.select("ip_start", "ip_end", "city", "lon", "lat"), broadcast_ranges=False)))
    extra = [sinks.console_batch_sink()] if console else []
    quarantine_path = quarantine_path or quarantine_folder(out_path)
    # One scan per micro-batch: score with flags, persist, then split.
    flagged = live.score_flagged(packets, geo_ranges, scaler, centers, threshold, local_ip, keep=("packet_id",))
    good_sink, bad_sink = sinks.parquet_batch_sink(out_path), sinks.parquet_batch_sink(quarantine_path)

    def split(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter(F.col("_ok")).drop("_ok", "reason", "raw")
        good_sink(good, batch_id)
        bad_sink(batch.filter(~F.col("_ok")).select("packet_id", "reason", "raw"), batch_id)
        for s in extra:
            s(good, batch_id)

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            split(batch, batch_id)
        finally:
            batch.unpersist()
    return _writer(flagged, checkpoint, available_now, trigger_seconds).foreachBatch(run).start()


def timed_stream(stream: DataFrame, watermark: str = WATERMARK, with_protocol: bool = False) -> DataFrame:
    """Transport packets with event time (TIMESTAMP) and lengths, watermarked once
    so that every stateful operator downstream shares the same bound.  With
    ``with_protocol`` also the port-based application protocol."""
    base = decode.base_columns(decode.keep_transport(with_packet_id(stream)))
    extra = [resolve_protocol(F.lit(None).cast("string"), F.col("src_port"), F.col("dst_port"))
             .alias("application_protocol")] if with_protocol else []
    df = base.select(
        "packet_id",
        parse.iso_nanos_to_time("layers.frame.frame_frame_time").alias("frame_time"),
        F.col("layers.ip.ip_ip_src").alias("ip_src"),
        F.col("layers.frame.frame_frame_protocols").alias("frame_protocols"),
        parse.try_int("layers.ip.ip_ip_len").alias("ip_len"),
        parse.try_int("layers.frame.frame_frame_len").alias("frame_len"), *extra)
    return df.withWatermark("frame_time", watermark)


def start_window_features(stream: DataFrame, out_path: str, checkpoint: str, length: str = "15 seconds",
                          slide: str | None = "5 seconds", keys=("frame_protocols",),
                          watermark: str = WATERMARK, available_now: bool = False,
                          trigger_seconds: int | None = None) -> StreamingQuery:
    g = windows.window_features(timed_stream(stream, watermark), "frame_time", length, slide, list(keys))
    g = g.drop("time_window")
    w = _writer(g, checkpoint, available_now, trigger_seconds).outputMode("append")
    return w.foreachBatch(sinks.multi_sink(sinks.parquet_batch_sink(out_path))).start()


SALTS = 8


def _bounded_join(t: DataFrame, g: DataFrame, length: str, slide: str | None, include_end: bool, salts: int) -> DataFrame:
    """Packets joined to the closed windows that hold them, one row a pair.

    A packet enters the state once, under its stack, its pane (time floored to the
    common step of length and slide) and a salt of its own; a window, of which
    there are few, is listed for each of its panes and salts after the
    aggregate.  So a stack with nearly all packets is spread over ``salts`` keys
    a pane, and the state holds no copies of packets.  The pane that begins
    at a window's end holds only packets exactly there.  The event-time range,
    implied by the keys, lets both sides' state be evicted by the watermark."""
    length_us = windows.parse_duration_us(length)
    pane_us = math.gcd(length_us, windows.parse_duration_us(slide) if slide else length_us)
    last = length_us // pane_us - (0 if include_end else 1)
    g = g.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("_i"))
    g = g.select("*", (F.col("w_start_us") + F.col("_i") * F.lit(pane_us)).alias("w_pane"),
                 (F.col("_i") * F.lit(pane_us) == F.lit(length_us)).alias("w_edge"),
                 F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("w_salt"))
    at = F.unix_micros("frame_time")
    p = t.withColumns({"_at": at, "_pane": at - F.pmod(at, F.lit(pane_us)),
                       "_salt": F.pmod(F.xxhash64("packet_id", "frame_time"), F.lit(salts)).cast("int")})
    cond = ((p["frame_protocols"] == g["w_protocols"]) & (p["_pane"] == g["w_pane"]) & (p["_salt"] == g["w_salt"])
            & (~g["w_edge"] | (p["_at"] == g["w_pane"]))
            & (p["frame_time"] >= g["w_time"] - F.expr(f"INTERVAL {length_us} MICROSECONDS"))
            & (p["frame_time"] <= g["w_time"] + F.expr("INTERVAL 1 SECOND")))
    return p.join(g, cond, "inner")


def start_joinback(stream: DataFrame, out_path: str, checkpoint: str, length: str = "15 seconds",
                   slide: str | None = "5 seconds", watermark: str = WATERMARK,
                   include_end: bool = True, available_now: bool = False,
                   trigger_seconds: int | None = None, salts: int = SALTS) -> StreamingQuery:
    """Packets joined to the closed windows (of their protocol stack) holding them."""
    t = timed_stream(stream, watermark)
    g = windows.window_features(t, "frame_time", length, slide, ["frame_protocols"])
    g = g.select(F.col("frame_protocols").alias("w_protocols"),
                 F.unix_micros(F.col("time_window.start")).alias("w_start_us"),
                 F.window_time("time_window").alias("w_time"),
                 "count", "ip_avg_len", "frame_avg_len", "ip_local_anomaly", "frame_local_anomaly")
    g = g.na.drop(subset=["ip_avg_len", "frame_avg_len", "ip_local_anomaly", "frame_local_anomaly"])
    p = t.select("packet_id", "frame_time", "frame_protocols")
    j = _bounded_join(p, g, length, slide, include_end, salts)
    out = j.select("packet_id", F.timestamp_micros("w_start_us").alias("start"), F.col("count").alias("n"),
                   "frame_protocols", "ip_local_anomaly", "frame_local_anomaly")
    w = _writer(out, checkpoint, available_now, trigger_seconds).outputMode("append")
    return w.foreachBatch(sinks.multi_sink(sinks.parquet_batch_sink(out_path))).start()


def start_forest_scoring(stream: DataFrame, model, cut: float, out_path: str, checkpoint: str,
                         length: str = "15 seconds", slide: str | None = "5 seconds",
                         watermark: str = WATERMARK, include_end: bool = True, available_now: bool = False,
                         trigger_seconds: int | None = None, salts: int = SALTS) -> StreamingQuery:
    """Sliding windows per protocol stack, rows with a NULL feature skipped,
    scored by the forest (pandas UDF, stateless after the aggregate), labelled
    at ``cut`` and joined back to the packets of each closed window."""
    from ..operators import iforest
    from ..schema import WINDOW_FEATURES
    t = timed_stream(stream, watermark, with_protocol=True)
    g = windows.window_features(t, "frame_time", length, slide, ["frame_protocols"])
    g = g.na.drop(subset=WINDOW_FEATURES)
    g = g.select(F.col("frame_protocols").alias("w_protocols"),
                 F.unix_micros(F.col("time_window.start")).alias("w_start_us"),
                 F.window_time("time_window").alias("w_time"),
                 iforest.score_column(model, WINDOW_FEATURES).alias("anomaly_score"))
    g = iforest.label(g, cut)
    p = t.select("packet_id", "frame_time", "frame_protocols", "application_protocol")
    j = _bounded_join(p, g, length, slide, include_end, salts)
    out = j.select("packet_id", "application_protocol", "frame_time", "anomaly_score", "anomaly",
                   F.timestamp_micros("w_start_us").alias("start"))
    w = _writer(out, checkpoint, available_now, trigger_seconds).outputMode("append")
    return w.foreachBatch(sinks.multi_sink(sinks.parquet_batch_sink(out_path))).start()


def run_all(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until every given query has stopped (started together, as one
    flow writing several outputs); the first failure is raised at once.
    After ``timeout`` seconds it returns, whatever still runs."""
    import time
    pending = list(queries)
    end = None if timeout is None else time.monotonic() + timeout
    while pending and (end is None or time.monotonic() < end):
        pending[0].awaitTermination(0.5)
        for q in list(pending):
            if not q.isActive:
                if q.exception():
                    raise q.exception()
                pending.remove(q)


def read_batches(spark, path: str) -> DataFrame:
    """Everything a batch sink wrote (all micro-batches)."""
    return spark.read.parquet(path).drop("batch_id")
