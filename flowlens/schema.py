"""Schemas: the decoded packet record, the flat delimited record and the
scored-packet output contract.

All reads use an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
AS = T.ArrayType(T.StringType())


def _struct(*names: str, array_fields: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, AS if n in array_fields else S, True) for n in names])


FRAME = _struct("frame_frame_time", "frame_frame_number", "frame_frame_len", "frame_frame_protocols")
ETH = _struct("eth_eth_src", "eth_eth_dst", "eth_eth_type")
IP = _struct("ip_ip_src", "ip_ip_dst", "ip_ip_proto", "ip_ip_len")
UDP = _struct("udp_udp_srcport", "udp_udp_dstport")
TCP = _struct("tcp_tcp_srcport", "tcp_tcp_dstport")
DNS_ARRAYS = ("dns_dns_resp_name", "dns_dns_resp_type", "dns_dns_resp_class")
DNS = _struct("dns_dns_qry_name", "dns_dns_qry_type", "dns_dns_qry_class", *DNS_ARRAYS,
              array_fields=DNS_ARRAYS)

LAYERS = T.StructType([
    T.StructField("frame", FRAME, True),
    T.StructField("eth", ETH, True),
    T.StructField("ip", IP, True),
    T.StructField("udp", UDP, True),
    T.StructField("tcp", TCP, True),
    T.StructField("dns", DNS, True),
])

# The decoded packet: epoch-millisecond text plus the protocol layers.
PACKET = T.StructType([
    T.StructField("timestamp", S, True),
    T.StructField("layers", LAYERS, True),
])


def narrow_packet_schema(layers: dict[str, list[str]]) -> T.StructType:
    """A packet schema holding only the listed leaves.

    ``from_json`` parses every leaf of the schema it is given whatever the
    query later reads, so a job that needs 11 of the 22 leaves should pass
    a schema of those 11.  ``layers`` maps a layer name to its leaves.
    """
    full = {f.name: f.dataType for f in LAYERS.fields}
    fields = []
    for layer, leaves in layers.items():
        sub = full[layer]
        keep = [f for f in sub.fields if f.name in set(leaves)]
        fields.append(T.StructField(layer, T.StructType(keep), True))
    return T.StructType([T.StructField("timestamp", S, True),
                         T.StructField("layers", T.StructType(fields), True)])


# Leaves read by live scoring (base columns, protocol, features).
SCORING_PACKET = narrow_packet_schema({
    "frame": ["frame_frame_number", "frame_frame_len", "frame_frame_protocols"],
    "ip": ["ip_ip_src", "ip_ip_dst", "ip_ip_proto", "ip_ip_len"],
    "udp": ["udp_udp_srcport", "udp_udp_dstport"],
    "tcp": ["tcp_tcp_srcport", "tcp_tcp_dstport"],
})

# Flat pipe-delimited export with a header (the forest training input).
PACKET_CSV = T.StructType([
    T.StructField("ip_src", S, True),
    T.StructField("ip_dst", S, True),
    T.StructField("ip_len", T.DoubleType(), True),
    T.StructField("eth_src", S, True),
    T.StructField("eth_dst", S, True),
    T.StructField("tcp_srcport", T.IntegerType(), True),
    T.StructField("tcp_dstport", T.IntegerType(), True),
    T.StructField("frame_time_epoch", S, True),
    T.StructField("frame_len", T.DoubleType(), True),
    T.StructField("frame_protocols", S, True),
    T.StructField("frame_time", S, True),
])

GEO_POINT = T.ArrayType(T.FloatType())

# Output contract of live scoring: 11 columns, two geo points as [lon, lat].
SCORED_PACKET = T.StructType([
    T.StructField("timestamp", S, True),
    T.StructField("ip_src", S, True),
    T.StructField("ip_dst", S, True),
    T.StructField("src_port", S, True),
    T.StructField("dst_port", S, True),
    T.StructField("src_city", S, True),
    T.StructField("dst_city", S, True),
    T.StructField("src_coordinates", GEO_POINT, True),
    T.StructField("dst_coordinates", GEO_POINT, True),
    T.StructField("application_protocol", S, True),
    T.StructField("anomaly", S, True),
])

GEO_POINT_COLUMNS = ("src_coordinates", "dst_coordinates")

# Feature order used by the scaler and the centroids (fixed).
FEATURES = ["frame_len", "ip_len", "ip_proto", "tcp_srcport", "tcp_dstport",
            "udp_srcport", "udp_dstport"]

# Window features assembled for the isolation forest (fixed order).
WINDOW_FEATURES = ["ip_avg_len", "frame_avg_len", "ip_local_anomaly",
                   "frame_local_anomaly", "count"]
