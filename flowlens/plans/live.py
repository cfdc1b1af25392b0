"""Live scoring: decoded packets -> the 11-column scored document.

A single map-only plan (plus broadcast lookups): transport filter, base
columns, geo lookup for both addresses, protocol resolution, features,
scaling and nearest-center distance, all as native expressions.  The same
function serves a batch DataFrame and a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decode, enrich, features, kmeans
from ..functions.protocol import resolve_protocol
from ..schema import FEATURES, SCORED_PACKET

DEFAULT_THRESHOLD = 2.6


def enrich_packets(df: DataFrame, geo_ranges: DataFrame, local_ip: str = enrich.LOCAL_IP) -> DataFrame:
    """Transport filter, base columns, geo for both sides, application protocol."""
    out = decode.base_columns(decode.keep_transport(df, keep_undecoded=True))
    local = (local_ip, enrich.LOOPBACK)
    cols = ["ip_start", "ip_end", "city", "lon", "lat"] + (["_bucket"] if "_bucket" in geo_ranges.columns else [])
    geo_ranges = enrich.bucket_ranges(geo_ranges.select(*cols))
    out = enrich.geo_enrich_range(out, geo_ranges, ip="ip_src", prefix="src", local_ips=local)
    out = enrich.geo_enrich_range(out, geo_ranges, ip="ip_dst", prefix="dst", local_ips=local)
    return out.withColumn("application_protocol", resolve_protocol(
        F.col("layers.frame.frame_frame_protocols"), F.col("src_port"), F.col("dst_port")))


def score_packets(df: DataFrame, geo_ranges: DataFrame, scaler, centers,
                  threshold: float = DEFAULT_THRESHOLD, local_ip: str = enrich.LOCAL_IP,
                  keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(scored, quarantine).

    ``scaler``/``centers`` are model tables (or their constants).  Packets
    whose features cannot be parsed go to quarantine instead of failing the
    job."""
    enriched = features.with_features(enrich_packets(df, geo_ranges, local_ip))
    good, bad = decode.split_quarantine(enriched, FEATURES)
    scaled = features.scale(good, scaler)
    scored = kmeans.label(kmeans.assign(scaled, centers), threshold)
    cols = [*keep, *SCORED_PACKET.fieldNames()]
    return scored.select(*cols), bad


def score_flagged(df: DataFrame, geo_ranges: DataFrame, scaler, centers,
                  threshold: float = DEFAULT_THRESHOLD, local_ip: str = enrich.LOCAL_IP,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One pass scoring every packet, with ``_ok``/``reason`` quarantine flags and
    the ``raw`` text of flagged rows (their scores are meaningless).  For sinks that split good and
    quarantined rows from one persisted micro-batch."""
    enriched = decode.flag_quarantine(features.with_features(enrich_packets(df, geo_ranges, local_ip)), FEATURES)
    enriched = enriched.withColumn("raw", F.when(~F.col("_ok"), decode.quarantined_text(enriched)))
    scored = kmeans.label(kmeans.assign(features.scale(enriched, scaler), centers), threshold)
    return scored.select(*keep, *SCORED_PACKET.fieldNames(), "_ok", "reason", "raw")
