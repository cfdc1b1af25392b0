"""The registered query catalogue: one function per operator group.

Each query takes ``(spark, sf_dir)``, reads the generated tables (the packet
binding over the whole ``events`` table plus dimensions derived from
``nation`` and ``customer``) and returns a DataFrame whose columns are
aliased to the names used by the SQL oracle.  DOUBLE outputs are rounded to
4 places and FLOAT values widened first, so both engines print the same
digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ip as ipf
from ..functions import parse, protocol
from ..functions.geo import geo_object_json
from ..operators import decode, enrich, features, iforest, intervals, kmeans, lloyd, prefixes, sampling, windows
from pyspark.sql import types as T

from ..schema import FEATURES, PACKET_CSV, SCORING_PACKET, WINDOW_FEATURES
from ..session import materialize, prepare, scratch_path
from ..sources import files, sinks
from ..streaming import jobs, late
from ..sources.testdata import (geo_prefix_dimension, geo_range_dimension, ipv6_addresses, packets, packets_from_lineitem, read_table,
                                reputation_dimension)
from . import live

R = 4


def rnd(c, digits: int = R) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


# ------------------------------------------------------------------ inputs

def _packets(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return packets(spark, sf)


def _base(spark, sf) -> DataFrame:
    return decode.base_columns(_packets(spark, sf))


def _featured(spark, sf, pk: DataFrame | None = None) -> DataFrame:
    """Transport packets with base columns, stack and the seven features."""
    df = decode.base_columns(decode.keep_transport(pk if pk is not None else _packets(spark, sf)))
    df = df.withColumn("protocols", F.col("layers.frame.frame_frame_protocols"))
    return features.with_features(df)


def _scaled(spark, sf, pk: DataFrame | None = None) -> tuple[DataFrame, list]:
    feat = _featured(spark, sf, pk)
    params = features.scaler_params(features.fit_scaler(feat))
    return features.scale(feat, params), params


def _centers(scaled: DataFrame) -> list:
    """Fixed model for the scoring queries: the mean scaled vector of each
    protocol stack, clusters numbered in stack-name order."""
    return kmeans.centers_from_table(kmeans.centroids_by_group(scaled, "protocols"))


def _live_model(spark, sf, pk: DataFrame) -> tuple[list, list]:
    """Scaler and centers for scoring ``pk``: the features are parsed and stored
    once (seven integers and the stack), both fits read those."""
    feat = _featured(spark, sf, pk).select("protocols", *FEATURES)
    path = scratch_path(spark, "features")
    feat.write.parquet(path)
    feat = spark.read.schema(feat.schema).parquet(path)
    params = features.scaler_params(features.fit_scaler(feat))
    return params, _centers(features.scale(feat, params))


def _ranges(spark, sf) -> DataFrame:
    return geo_range_dimension(read_table(spark, sf, "nation"))


# ------------------------------------------------------------ projections

def q_packet_base(spark, sf):
    return _base(spark, sf).select("packet_id", "timestamp", "ip_src", "ip_dst", "src_port", "dst_port")


def q_transport_filter(spark, sf):
    df = decode.keep_transport(_packets(spark, sf))
    return df.groupBy(decode.transport_of().alias("transport")).agg(F.count(F.lit(1)).alias("packets"))


def q_int_prefix_parse(spark, sf):
    df = _packets(spark, sf)
    return df.select("packet_id",
                     parse.prefixed_int("layers.eth.eth_eth_type").alias("eth_type_int"),
                     parse.try_int("layers.frame.frame_frame_len").alias("frame_len_int"))


def q_drop_fields(spark, sf):
    """Ingest envelope (event/host/log bookkeeping + JSON ``message``)
    -> fields dropped, message re-parsed."""
    prepare(spark)
    ev = read_table(spark, sf, "events")
    env = ev.select(F.col("event_id").alias("packet_id"),
                    F.struct(F.col("event_type").alias("original")).alias("event"),
                    F.lit("capture-host").alias("host"),
                    F.struct(F.lit("packets.log").alias("file")).alias("log"),
                    F.col("props").alias("message"))
    out = decode.parse_embedded_json(decode.drop_fields(env), "k INT")
    return out.select("packet_id", F.col("k").alias("value_k"))


# --------------------------------------------------------------- protocol

def q_protocol_from_stack(spark, sf):
    df = _packets(spark, sf)
    p = protocol.protocol_from_stack("layers.frame.frame_frame_protocols")
    return df.groupBy(p.alias("protocol")).agg(F.count(F.lit(1)).alias("packets"))


def q_protocol_from_port(spark, sf):
    df = _base(spark, sf)
    return df.groupBy(protocol.protocol_from_port("src_port").alias("src_protocol"),
                      protocol.protocol_from_port("dst_port").alias("dst_protocol")).agg(
        F.count(F.lit(1)).alias("packets"))


def q_protocol_resolved(spark, sf):
    df = _base(spark, sf)
    return df.select("packet_id", protocol.resolve_protocol(
        "layers.frame.frame_frame_protocols", "src_port", "dst_port").alias("application_protocol"))


# --------------------------------------------------------------- addresses

def q_ip_to_int(spark, sf):
    df = _base(spark, sf)
    return df.select("packet_id", "ip_src", ipf.ip_to_int("ip_src").alias("ip_src_int"),
                     ipf.ip_to_int("ip_dst").alias("ip_dst_int"))


def q_ip_private(spark, sf):
    df = _base(spark, sf)
    addrs = df.select(F.col("ip_src").alias("ip")).unionByName(df.select(F.col("ip_dst").alias("ip")))
    return addrs.distinct().select("ip", ipf.is_private_ip("ip").alias("is_private"))


def q_geo_enrich(spark, sf):
    df = _base(spark, sf)
    geo = enrich.resolve_addresses(df, _ranges(spark, sf))
    out = enrich.geo_enrich(df, geo)
    return out.select("packet_id", "src_city", "dst_city")


def q_geo_enrich_range(spark, sf):
    out = enrich.geo_enrich_range(_base(spark, sf), _ranges(spark, sf), ip="ip_dst", prefix="dst")
    return out.select("packet_id", "dst_city",
                      rnd(F.get("dst_coordinates", 0)).alias("dst_lon"),
                      rnd(F.get("dst_coordinates", 1)).alias("dst_lat"))


def _overlapping_ranges(spark, sf) -> DataFrame:
    """The /24 ranges of the nations, and wide ones of the regions that hold
    and overlap them: 8.r.0.0 to 8.(r + 1).255.255, and 10.0.0.0 to
    10.0.(7 * r + 3).255."""
    wide = read_table(spark, sf, "region")
    r = F.col("r_regionkey").cast("bigint")
    common = [F.col("r_name").alias("city"), F.col("r_regionkey").cast("float").alias("lon"), F.lit(0.0).cast("float").alias("lat")]
    at8, at10 = F.lit(8 << 24).cast("bigint"), F.lit(10 << 24).cast("bigint")
    return (_ranges(spark, sf).select("ip_start", "ip_end", "city", "lon", "lat")
            .unionByName(wide.select((at8 + r * 65536).alias("ip_start"), (at8 + (r + 2) * 65536 - 1).alias("ip_end"), *common))
            .unionByName(wide.select(at10.alias("ip_start"), (at10 + (7 * r + 4) * 256 - 1).alias("ip_end"), *common)))


def q_geo_overlap(spark, sf):
    """City of the narrowest of overlapping ranges, each packet once."""
    df = _base(spark, sf)
    geo = materialize(intervals.resolve_overlapping(df, _overlapping_ranges(spark, sf)))
    return enrich.geo_enrich(df, geo).select("packet_id", "src_city", "dst_city", rnd(F.get("dst_coordinates", 0)).alias("dst_lon"))


def _packets_v6(spark, sf) -> DataFrame:
    prepare(spark)
    return ipv6_addresses(read_table(spark, sf, "events", key="event_id"))


def q_ip_key(spark, sf):
    """Hex keys of IPv6 addresses, and the halves they sort by."""
    df = _packets_v6(spark, sf).withColumn("_h", ipf.ipv6_halves("ip_dst"))
    return df.select("packet_id", ipf.ip_key("ip_src").alias("src_key"), ipf.ip_key("ip_dst").alias("dst_key"),
                     ipf.unsigned_order(F.col("_h.hi")).alias("dst_order"), F.col("_h.lo").alias("dst_lo"))


def q_geo_enrich_v6(spark, sf):
    """City of the longest IPv6 network holding each address."""
    df = _packets_v6(spark, sf)
    dim = geo_prefix_dimension(read_table(spark, sf, "nation"), read_table(spark, sf, "region"))
    geo = materialize(prefixes.resolve_addresses_v6(df, dim))
    return enrich.geo_enrich(df, geo).select("packet_id", "src_city", "dst_city", rnd(F.get("dst_coordinates", 0)).alias("dst_lon"))


def q_geo_point_json(spark, sf):
    out = enrich.geo_enrich_range(_base(spark, sf), _ranges(spark, sf), ip="ip_dst", prefix="dst")
    text = geo_object_json(F.get("dst_coordinates", 1), F.get("dst_coordinates", 0), F.col("dst_city"))
    back = F.from_json(text, "region STRING, loc STRUCT<lat: DOUBLE, lon: DOUBLE>")
    return out.select("packet_id", back["region"].alias("region"),
                      rnd(back["loc"]["lat"]).alias("lat"), rnd(back["loc"]["lon"]).alias("lon"))


def q_threat_enrich(spark, sf):
    rep = reputation_dimension(read_table(spark, sf, "customer"))
    out = enrich.threat_enrich(_base(spark, sf), rep)
    return out.select("packet_id", "src_threat", "dst_threat")


# --------------------------------------------------------------- features

def q_packet_features(spark, sf):
    return _featured(spark, sf).select("packet_id", *FEATURES)


def q_scaler_fit(spark, sf):
    sc = features.fit_scaler(_featured(spark, sf))
    return sc.select("feature", rnd("mean").alias("mean"), rnd("std").alias("std"))


def q_scaled_features(spark, sf):
    scaled, _ = _scaled(spark, sf)
    return scaled.select("packet_id", *[rnd(F.get("scaled_features", i)).alias(f"s_{c}")
                                        for i, c in enumerate(FEATURES)])


def q_kmeans_assign(spark, sf):
    scaled, _ = _scaled(spark, sf)
    out = kmeans.assign(scaled, _centers(scaled))
    return out.select("packet_id", F.col("prediction.cluster").alias("cluster"),
                      rnd("prediction.distance").alias("distance"))


def q_anomaly_label(spark, sf):
    scaled, _ = _scaled(spark, sf)
    out = kmeans.assign(scaled, _centers(scaled))
    out = kmeans.label(out, 2.6)
    out = kmeans.label(out, 3.0, out="flag_3", as_flag=True)
    return out.select("packet_id", "anomaly", "flag_3")


def q_kmeans_inertia(spark, sf):
    scaled, _ = _scaled(spark, sf)
    centers = _centers(scaled)
    one = scaled.agg(*[a.alias(f"w{i}") for i, a in enumerate(kmeans.inertia_one_cluster())])
    k1 = one.select(F.lit(1).alias("k"), rnd(sum(F.col(f"w{i}") for i in range(7))).alias("inertia"))
    k5 = scaled.agg(kmeans.inertia(scaled, centers).alias("w")).select(
        F.lit(len(centers)).alias("k"), rnd("w").alias("inertia"))
    return k1.unionByName(k5)


def q_lloyd_step(spark, sf):
    scaled, _ = _scaled(spark, sf)
    step = kmeans.lloyd_step(scaled, _centers(scaled))
    return step.select("cluster", *[rnd(f"c{i}").alias(f"c{i}") for i in range(7)], "n")


def q_score_percentile(spark, sf):
    scaled, _ = _scaled(spark, sf)
    dist = materialize(kmeans.assign(scaled, _centers(scaled)).select(
        F.col("prediction.distance").cast("double").alias("d")))
    cut = sampling.exact_percentile(dist, "d", 0.9)
    flagged = dist.filter(F.col("d") > F.lit(cut)).agg(F.count(F.lit(1)).alias("flagged"))
    return flagged.select(rnd(F.lit(cut)).alias("cut"), "flagged")


def q_split_md5(spark, sf):
    df = _featured(spark, sf)
    part = sampling.md5_split_column("packet_id", [0.7, 0.3], ["train", "test"], seed=5043)
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))


def q_embedding_kmeans(spark, sf):
    """Second K-Means workload: 64-dimensional embeddings assigned to the
    mean embedding of each label (10 centers, numbered in label order)."""
    prepare(spark)
    emb = read_table(spark, sf, "embeddings", key="vec_id")
    x = emb.select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    dim = len(x.select("x").first()["x"])
    centers = kmeans.centers_from_table(kmeans.centroids_by_group(x, "label", x="x", dim=dim))
    out = kmeans.assign(x, centers, x="x")
    return out.select("vec_id", F.col("prediction.cluster").alias("cluster"),
                      rnd("prediction.distance").alias("distance"))


# ------------------------------------------------------------ live scoring

def q_live_score(spark, sf):
    df = _packets(spark, sf)
    scored, _ = live.score_packets(df, _ranges(spark, sf), *_live_model(spark, sf, df), keep=("packet_id",))
    return flatten_scored(scored)


def q_lineitem_score(spark, sf):
    """Volume variant of live scoring: lineitem rows as packets (6x events)."""
    prepare(spark)
    pk = packets_from_lineitem(read_table(spark, sf, "lineitem", key="l_orderkey"))
    scored, _ = live.score_packets(pk, _ranges(spark, sf), *_live_model(spark, sf, pk), keep=("packet_id",))
    return flatten_scored(scored)


def flatten_scored(scored: DataFrame) -> DataFrame:
    """Scored documents with the two geo points as four DOUBLE columns."""
    return scored.select(
        "packet_id", "timestamp", "ip_src", "ip_dst", "src_port", "dst_port", "src_city", "dst_city",
        rnd(F.get("src_coordinates", 0)).alias("src_lon"), rnd(F.get("src_coordinates", 1)).alias("src_lat"),
        rnd(F.get("dst_coordinates", 0)).alias("dst_lon"), rnd(F.get("dst_coordinates", 1)).alias("dst_lat"),
        "application_protocol", "anomaly")


# ---------------------------------------------------------------- windows

def timed_packets(df: DataFrame) -> DataFrame:
    """Transport packets with the columns the window jobs read."""
    return decode.keep_transport(df).select(
        "packet_id",
        parse.iso_nanos_to_time("layers.frame.frame_frame_time").alias("frame_time"),
        F.col("layers.ip.ip_ip_src").alias("ip_src"),
        F.col("layers.frame.frame_frame_protocols").alias("frame_protocols"),
        parse.try_int("layers.ip.ip_ip_len").alias("ip_len"),
        parse.try_int("layers.frame.frame_frame_len").alias("frame_len"))


def _timed(spark, sf) -> DataFrame:
    return timed_packets(_packets(spark, sf))


def _window_out(g: DataFrame, keys: list[str], maxes: bool) -> DataFrame:
    cols = [F.col("start").cast("timestamp_ntz").alias("start"), *keys,
            F.col("count").alias("n"), rnd("ip_avg_len").alias("ip_avg_len"),
            rnd("frame_avg_len").alias("frame_avg_len")]
    if maxes:
        cols += [F.col("max_ip_len"), F.col("max_frame_len")]
    cols += [rnd("ip_local_anomaly").alias("ip_local_anomaly"),
             rnd("frame_local_anomaly").alias("frame_local_anomaly")]
    return g.select(*cols)


def q_window_tumbling(spark, sf):
    g = windows.window_features(_timed(spark, sf), "frame_time", "1 minute",
                                keys=["ip_src", "frame_protocols"])
    return _window_out(g.withColumnRenamed("frame_protocols", "protocols"), ["ip_src", "protocols"], False)


def _sliding(spark, sf, length, slide):
    g = windows.window_features(_timed(spark, sf), "frame_time", length, slide, keys=["frame_protocols"])
    return _window_out(g.withColumnRenamed("frame_protocols", "protocols"), ["protocols"], True)


def q_window_sliding(spark, sf):
    return _sliding(spark, sf, "1 hour", "20 minutes")


def q_window_sliding_15s(spark, sf):
    return _sliding(spark, sf, "15 seconds", "5 seconds")


JOINBACK_TUMBLING = "1 hour"
JOINBACK_SLIDING = ("1 hour", "20 minutes")


def q_window_joinback_left(spark, sf):
    t = _timed(spark, sf)
    g = windows.window_features(t, "frame_time", JOINBACK_TUMBLING, keys=["ip_src", "frame_protocols"])
    j = windows.join_back(t, g, "frame_time", JOINBACK_TUMBLING,
                          keys=[("ip_src", "ip_src"), ("frame_protocols", "frame_protocols")], how="left")
    return j.select("packet_id", F.col("start").cast("timestamp_ntz").alias("start"),
                    rnd("ip_local_anomaly").alias("ip_local_anomaly"),
                    rnd("frame_local_anomaly").alias("frame_local_anomaly"), F.col("count").alias("n"))


def q_window_joinback_inner(spark, sf):
    t = _timed(spark, sf)
    length, slide = JOINBACK_SLIDING
    g = windows.window_features(t, "frame_time", length, slide, keys=["frame_protocols"])
    g = features.assemble(g)  # rows with a NULL feature are skipped
    j = windows.join_back(t, g, "frame_time", length, slide, how="inner")
    return j.select("packet_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("count").alias("n"))


# ------------------------------------------------------------ file sources

def q_ndjson_decode(spark, sf):
    """Packets written as an NDJSON capture log (index action lines
    included) to the shared scratch folder, then read back and decoded."""
    path = scratch_path(spark, "ndjson")
    files.write_packets_ndjson(_packets(spark, sf), path)
    df = files.read_packets_ndjson(spark, path)
    dns = F.col("layers.dns.dns_dns_resp_name")
    return df.select(F.col("layers.frame.frame_frame_number").cast("bigint").alias("packet_id"),
                     F.col("layers.ip.ip_ip_src").alias("ip_src"),
                     parse.try_int("layers.frame.frame_frame_len").alias("frame_len"),
                     F.when(dns.isNotNull(), F.size(dns)).alias("dns_answers"),
                     F.col("layers.eth.eth_eth_type").alias("eth_type"))


CSV_COLUMNS = [*[f.name for f in PACKET_CSV.fields], "frame_number"]


def packet_csv_lines(df: DataFrame) -> DataFrame:
    """Flat tshark-style export lines, with deterministic defects: every
    53rd packet is cut short, every 59th has a non-numeric ``ip_len``,
    every 61st an empty one."""
    pid = F.col("packet_id")
    ts = parse.epoch_ms_text_to_time("timestamp")
    frame_time = F.concat(F.date_format(ts, "MMM"), F.lit(" "), F.lpad(F.date_format(ts, "d"), 2, " "),
                          F.lit(" "), F.date_format(F.col("layers.frame.frame_frame_time").try_cast("timestamp"),
                                                    "yyyy HH:mm:ss.SSSSSS"), F.lit("000 "))
    epoch = F.concat(F.col("timestamp").substr(1, 10), F.lit("."), F.col("timestamp").substr(11, 3),
                     F.lit("000000"))
    ip_len = (F.when(pid % 59 == 0, F.lit("abc")).when(pid % 61 == 0, F.lit(""))
              .otherwise(F.coalesce(F.col("layers.ip.ip_ip_len"), F.lit(""))))
    vals = [F.col("layers.ip.ip_ip_src"), F.col("layers.ip.ip_ip_dst"), ip_len,
            F.col("layers.eth.eth_eth_src"), F.col("layers.eth.eth_eth_dst"),
            F.col("layers.tcp.tcp_tcp_srcport"), F.col("layers.tcp.tcp_tcp_dstport"), epoch,
            F.col("layers.frame.frame_frame_len"), F.col("layers.frame.frame_frame_protocols"),
            frame_time, pid.cast("string")]
    vals = [F.coalesce(v, F.lit("")) for v in vals]
    full = F.concat_ws("|", *vals)
    short = F.concat_ws("|", *vals[:-3])
    return df.select(F.when(pid % 53 == 0, short).otherwise(full).alias("value"))


def q_csv_decode(spark, sf):
    """Packets exported as a pipe-delimited file with a header and some
    malformed rows, then read back with DROPMALFORMED."""
    path = scratch_path(spark, "csv")
    files.write_delimited_lines(packet_csv_lines(_packets(spark, sf)), CSV_COLUMNS, path)
    schema = T.StructType([*PACKET_CSV.fields, T.StructField("frame_number", T.LongType(), True)])
    df = files.read_packet_csv(spark, path, schema)
    t = parse.tshark_time("frame_time")
    return df.select(F.col("frame_number").alias("packet_id"), t.cast("timestamp_ntz").alias("frame_time"),
                     parse.epoch_seconds(t).alias("epoch_s"), F.col("ip_len"))


# ---------------------------------------------------------------- streaming

def _stage_stream_input(spark, sf) -> str:
    """Packets written as NDJSON files, one a partition, into a fresh scratch
    folder that a file-source stream then reads."""
    path = scratch_path(spark, "stream-in")
    files.write_packets_ndjson(_packets(spark, sf), path)
    return path


def q_stream_score(spark, sf):
    """Batch-trained models saved as tables, loaded by a file-source stream
    that scores a file for every two cores in a micro-batch (availableNow)."""
    in_dir = _stage_stream_input(spark, sf)
    cores = spark.sparkContext.defaultParallelism
    scaled, params = _scaled(spark, sf)
    models = scratch_path(spark, "models")
    sinks.save_model_table(spark.createDataFrame(
        [(c, i, m, sd) for i, (c, (m, sd)) in enumerate(zip(FEATURES, params))],
        "feature string, ordinal int, mean double, std double"), f"{models}/scaler")
    sinks.save_model_table(kmeans.centroids_by_group(scaled, "protocols"), f"{models}/kmeans")
    scaler = sinks.load_model_table(spark, f"{models}/scaler")
    centers = sinks.load_model_table(spark, f"{models}/kmeans")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    stream = files.stream_packets_ndjson(spark, in_dir, SCORING_PACKET, max_files_per_trigger=max(2, cores // 2))
    q = jobs.start_scoring(stream, _ranges(spark, sf), scaler, centers, out, ckpt, available_now=True,
                           spread=cores)
    q.awaitTermination()
    return flatten_scored(jobs.read_batches(spark, out))


STREAM_WINDOW = ("1 hour", "20 minutes")


def q_stream_window(spark, sf):
    in_dir = _stage_stream_input(spark, sf)
    out, ckpt = scratch_path(spark, "stream-win"), scratch_path(spark, "stream-win-ckpt")
    length, slide = STREAM_WINDOW
    q = jobs.start_window_features(files.stream_packets_ndjson(spark, in_dir), out, ckpt, length, slide,
                                   available_now=True)
    q.awaitTermination()
    g = jobs.read_batches(spark, out).withColumnRenamed("frame_protocols", "protocols")
    return _window_out(g, ["protocols"], True)


def q_stream_joinback(spark, sf):
    in_dir = _stage_stream_input(spark, sf)
    out, ckpt = scratch_path(spark, "stream-jb"), scratch_path(spark, "stream-jb-ckpt")
    length, slide = STREAM_WINDOW
    q = jobs.start_joinback(files.stream_packets_ndjson(spark, in_dir), out, ckpt, length, slide,
                            available_now=True)
    q.awaitTermination()
    j = jobs.read_batches(spark, out)
    return j.select("packet_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


LATE_WINDOW = "1 hour"


def _arrivals(spark, sf) -> list[DataFrame]:
    """The packets in three arrivals, thirds of their time range; every 50th
    packet comes one arrival after its time."""
    pk = _packets(spark, sf)
    t = F.unix_micros(parse.iso_nanos_to_time("layers.frame.frame_frame_time"))
    lo, hi = pk.agg(F.min(t), F.max(t)).first()
    if lo is None:
        return [pk]
    third = F.floor((t - F.lit(lo)) * 3 / F.lit(hi - lo + 1))
    at = F.least(third + F.when(F.col("packet_id") % 50 == 0, F.lit(1)).otherwise(F.lit(0)), F.lit(2))
    return [pk.filter(at == i) for i in range(3)]


def _late_windows(spark, sf) -> str:
    """The stream started once an arrival, from the same checkpoint; its output folder."""
    in_dir, out, ckpt = (scratch_path(spark, n) for n in ("late-in", "late-out", "late-ckpt"))
    for i, part in enumerate(_arrivals(spark, sf)):
        files.write_packets_ndjson(part, f"{in_dir}/arrival-{i}")
        late.start_late_windows(files.stream_packets_ndjson(spark, f"{in_dir}/*"), out, ckpt, LATE_WINDOW,
                                available_now=True).awaitTermination()
    return out


def q_stream_late(spark, sf):
    """Windows without the late rows, from three micro-batches."""
    g = late.read_windows(spark, _late_windows(spark, sf), LATE_WINDOW).withColumnRenamed("frame_protocols", "protocols")
    return _window_out(g, ["protocols"], True)


def q_stream_late_account(spark, sf):
    """Rows in, counted and late per micro-batch, and a row for each late packet."""
    out = _late_windows(spark, sf)
    none = F.lit(None).cast("bigint")
    account = late.read_account(spark, out).select("batch", "rows", "counted", "late", "untimed", none.alias("packet_id"))
    gone = late.read_late(spark, out).select(*[none.alias(c) for c in ("batch", "rows", "counted", "late", "untimed")], "packet_id")
    return account.unionByName(gone)


# ---------------------------------------------------------------- training

def _training_rows(spark, sf) -> DataFrame:
    feat = _featured(spark, sf)
    return features.scale(feat, features.scaler_params(features.fit_scaler(feat)))


def q_kmeans_fit(spark, sf):
    """Three restarts of K-Means (k = 5) after three iterations, one row per
    restart and cluster."""
    rows = lloyd.vectors(_training_rows(spark, sf), key="packet_id")
    fits = lloyd.fit_all(rows, [5], [42, 43, 44], max_iter=3, tol=0.0)
    out = [(f.seed, i, n, *[round(float(v), R) for v in c], round(f.inertia, R))
           for f in fits for i, (n, c) in enumerate(zip(f.sizes, f.centers))]
    cols = ", ".join(f"c{i} double" for i in range(len(FEATURES)))
    return spark.createDataFrame(out, f"seed int, cluster int, n bigint, {cols}, inertia double")


def q_kmeans_train(spark, sf):
    """Elbow table: best-of-10 K-Means inertia for k = 1..9 over the scaled
    packet features, and the k at the knee."""
    return kmeans.elbow(_training_rows(spark, sf), range(1, 10), key="packet_id").select(
        "k", rnd("inertia").alias("inertia"), "knee")


IFOREST_WINDOW = "1 minute"


def iforest_frame(spark, sf) -> DataFrame:
    """Training frame of the forest: every packet with the features of its
    1-minute window per (source address, stack), joined back left."""
    t = _timed(spark, sf)
    g = windows.window_features(t, "frame_time", IFOREST_WINDOW, keys=["ip_src", "frame_protocols"])
    return windows.join_back(t, g, "frame_time", IFOREST_WINDOW,
                             keys=[("ip_src", "ip_src"), ("frame_protocols", "frame_protocols")], how="left")


def _iforest_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    j = materialize(iforest_frame(spark, sf).select(
        "packet_id", "frame_time", *WINDOW_FEATURES,
        sampling.md5_split_column("packet_id", [0.7, 0.3], ["train", "test"], seed=5043).alias("part")))
    return j.filter(F.col("part") == "train"), j.filter(F.col("part") == "test")


def q_iforest_nodes(spark, sf):
    """The node table of the forest fitted on a 70 % md5 split of the window features."""
    train, _ = _iforest_parts(spark, sf)
    nodes, _ = iforest.fit(train, WINDOW_FEATURES, key="packet_id", n_trees=100, max_samples=256, seed=1)
    return nodes.select("tree_id", "node_id", "feature", rnd("cut", 6).alias("cut"), "size", "depth")


def q_iforest_score(spark, sf):
    """Forest fitted on a 70 % md5 split of the window features, held-out 30 %
    scored and labelled at the training 90th percentile."""
    train, test = _iforest_parts(spark, sf)
    nodes, psi = iforest.fit(train, WINDOW_FEATURES, key="packet_id", n_trees=100, max_samples=256, seed=1)
    model = iforest.ForestModel(nodes, psi)
    cut = iforest.threshold(iforest.score(train, model, WINDOW_FEATURES), 0.1)
    scored = iforest.label(iforest.score(test, model, WINDOW_FEATURES), cut)
    return scored.select("packet_id", F.col("frame_time").cast("timestamp_ntz").alias("frame_time"),
                         rnd("anomaly_score").alias("score"), F.col("anomaly").alias("label"))


QUERIES = {
    "packet_base": q_packet_base,
    "transport_filter": q_transport_filter,
    "int_prefix_parse": q_int_prefix_parse,
    "drop_fields": q_drop_fields,
    "protocol_from_stack": q_protocol_from_stack,
    "protocol_from_port": q_protocol_from_port,
    "protocol_resolved": q_protocol_resolved,
    "ip_to_int": q_ip_to_int,
    "ip_private": q_ip_private,
    "geo_enrich": q_geo_enrich,
    "geo_enrich_range": q_geo_enrich_range,
    "geo_overlap": q_geo_overlap,
    "ip_key": q_ip_key,
    "geo_enrich_v6": q_geo_enrich_v6,
    "geo_point_json": q_geo_point_json,
    "threat_enrich": q_threat_enrich,
    "packet_features": q_packet_features,
    "scaler_fit": q_scaler_fit,
    "scaled_features": q_scaled_features,
    "kmeans_assign": q_kmeans_assign,
    "anomaly_label": q_anomaly_label,
    "kmeans_inertia": q_kmeans_inertia,
    "lloyd_step": q_lloyd_step,
    "score_percentile": q_score_percentile,
    "split_md5": q_split_md5,
    "embedding_kmeans": q_embedding_kmeans,
    "live_score": q_live_score,
    "lineitem_score": q_lineitem_score,
    "window_tumbling": q_window_tumbling,
    "window_sliding": q_window_sliding,
    "window_sliding_15s": q_window_sliding_15s,
    "window_joinback_left": q_window_joinback_left,
    "window_joinback_inner": q_window_joinback_inner,
    "ndjson_decode": q_ndjson_decode,
    "csv_decode": q_csv_decode,
    "stream_score": q_stream_score,
    "stream_window": q_stream_window,
    "stream_joinback": q_stream_joinback,
    "stream_late": q_stream_late,
    "stream_late_account": q_stream_late_account,
    "kmeans_fit": q_kmeans_fit,
    "kmeans_train": q_kmeans_train,
    "iforest_nodes": q_iforest_nodes,
    "iforest_score": q_iforest_score,
}
