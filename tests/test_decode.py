"""Decoding, filters and quarantine on hand-written packet lines (FIXTURES.md §2-3)."""

import json

import pytest
from pyspark.sql import functions as F

from flowlens.operators import decode, features
from flowlens.plans import live
from flowlens.sources import files
from flowlens.schema import FEATURES

INDEX = '{"index":{"_index":"packets-2024-06-19","_type":"doc"}}'
GOLDEN = {
    "timestamp": "1700000000123",
    "layers": {
        "frame_raw": "0200",
        "frame": {"frame_frame_time": "2023-11-14T22:13:20.123456789Z", "frame_frame_number": "1",
                  "frame_frame_len": "210", "frame_frame_protocols": "eth:ethertype:ip:udp:dns"},
        "eth": {"eth_eth_src": "02:00:00:00:00:01", "eth_eth_dst": "02:00:00:00:00:02", "eth_eth_type": "0x0800"},
        "ip": {"ip_ip_src": "198.51.100.7", "ip_ip_dst": "203.0.113.20", "ip_ip_proto": "17", "ip_ip_len": "196",
               "text": "a", "text2": "b"},
        "udp": {"udp_udp_srcport": "53", "udp_udp_dstport": "41000"},
        "dns": {"dns_dns_qry_name": "host.example.org", "dns_dns_qry_type": "1", "dns_dns_qry_class": "0x0001",
                "dns_dns_resp_name": ["a", "b", "c", "d"], "dns_dns_resp_type": ["5", "5", "5", "1"],
                "dns_dns_resp_class": ["0x0001", "0x0001", "0x0001"]},
    },
}


def packet(frame=None, ip=None, udp=None, tcp=None, dns=None, ts="1700000000123", number="1"):
    layers = {"frame": {"frame_frame_time": "2023-11-14T22:13:20.123456789Z", "frame_frame_number": number,
                        "frame_frame_len": "100", "frame_frame_protocols": "eth:ethertype:ip:udp", **(frame or {})}}
    for k, v in (("ip", ip), ("udp", udp), ("tcp", tcp), ("dns", dns)):
        if v is not None:
            layers[k] = v
    out = {"layers": layers}
    if ts is not None:
        out["timestamp"] = ts
    return json.dumps(out)


def write_lines(spark, lines, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def decoded(spark, lines, tmp_path):
    return files.read_packets_ndjson(spark, write_lines(spark, lines, tmp_path))


def test_golden_packet(spark, tmp_path):
    df = decoded(spark, [INDEX, json.dumps(GOLDEN)], tmp_path)
    assert df.count() == 1
    base = decode.base_columns(df)
    r = features.with_features(base).first()
    assert r.timestamp == "2023-11-14 22:13:20"
    assert (r.ip_src, r.ip_dst, r.src_port, r.dst_port) == ("198.51.100.7", "203.0.113.20", "53", "41000")
    assert r.features == [210, 196, 17, 0, 0, 53, 41000]
    assert r.layers.tcp is None
    dns = r.layers.dns
    assert dns.dns_dns_qry_name == "host.example.org"
    assert (len(dns.dns_dns_resp_name), len(dns.dns_dns_resp_type), len(dns.dns_dns_resp_class)) == (4, 4, 3)


def test_text_and_json_readers_agree(spark, tmp_path):
    lines = [INDEX, json.dumps(GOLDEN), packet(ip={"ip_ip_len": ["1", "2"], "ip_ip_src": ["1.1.1.1", "2.2.2.2"]},
                                             udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"})]
    path = write_lines(spark, lines, tmp_path)
    a = files.read_packets_ndjson(spark, path).drop("_decoded")
    b = files.read_packets_text(spark, path).drop("_decoded")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_edge_rows(spark, tmp_path):
    lines = [
        INDEX,
        "not json",
        packet(number="2", ip=None, tcp={"tcp_tcp_srcport": "1000", "tcp_tcp_dstport": "443"}),  # IPv6: no ip layer
        packet(number="3", ip={}, udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),          # empty ip layer
        packet(number="4", ip={"ip_ip_len": ["1", "2"], "ip_ip_src": ["1.1.1.1", "2.2.2.2"], "ip_ip_proto": "17"},
               udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),                             # arrays for scalars
        packet(number="5", dns={"dns_dns_resp_name": "a.com"}, udp={"udp_udp_srcport": "53", "udp_udp_dstport": "2"}),
        packet(number="6", frame={"frame_frame_len": "0x1f"}, ip={"ip_ip_len": "007", "ip_ip_proto": "abc"},
               udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),
        packet(number="7", ts="abc", udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),
        packet(number="8", ts=None, udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),
        packet(number="9", frame={"frame_frame_protocols": "eth:ethertype:ip:icmp"}),               # no transport
        packet(number="10", tcp={"tcp_tcp_srcport": "80", "tcp_tcp_dstport": "81"},
               udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),                             # tcp wins
    ]
    df = decoded(spark, lines, tmp_path)
    assert df.count() == 10  # the action line is gone; "not json" is kept for quarantine
    # (a query reading only the corrupt-record column is refused by Spark)
    assert len(df.filter(~F.col("_decoded")).select("timestamp", "_decoded").collect()) == 1
    kept = decode.keep_transport(df.filter("_decoded"))
    rows = {int(r.layers.frame.frame_frame_number): r
            for r in features.with_features(decode.base_columns(kept)).collect()}
    assert 9 not in rows
    assert rows[2].ip_src is None and rows[2].ip_len == 0 and rows[2].ip_proto == 0
    assert rows[3].ip_len is None                       # present layer, missing field -> NULL feature
    assert rows[4].ip_len == 1 and rows[4].ip_src == "1.1.1.1"
    assert rows[5].layers.dns.dns_dns_resp_name == ["a.com"]
    assert rows[6].frame_len == 31 and rows[6].ip_len is None and rows[6].ip_proto is None
    assert rows[7].timestamp is None and rows[8].timestamp is None
    assert (rows[10].src_port, rows[10].dst_port) == ("80", "81")


def test_quarantine_split(spark, tmp_path):
    lines = ["not json", packet(number="3", ip={}, udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"}),
             packet(number="4", ip={"ip_ip_len": "10", "ip_ip_proto": "17"},
                    udp={"udp_udp_srcport": "1", "udp_udp_dstport": "2"})]
    df = features.with_features(decoded(spark, lines, tmp_path))
    good, bad = decode.split_quarantine(df, FEATURES)
    assert good.count() == 1
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["not_json", "null_ip_len"]


def test_drop_fields_and_embedded_json(spark):
    df = spark.createDataFrame([({"a": "1"}, "h", {"f": "x"}, '{"k": 5}', 1)],
                               "event map<string,string>, host string, log struct<f:string>, message string, id int")
    out = decode.parse_embedded_json(decode.drop_fields(df), "k INT")
    assert out.columns == ["message", "id", "k"]
    assert out.first().k == 5


def test_scored_output_contract(spark, tmp_path):
    from flowlens.sources import sinks
    from flowlens.schema import SCORED_PACKET
    ranges = spark.createDataFrame([(3325256704, 3325256959, "Mountain View", 1.0, 2.0)],
                                   "ip_start bigint, ip_end bigint, city string, lon float, lat float")
    df = decoded(spark, [json.dumps(GOLDEN)], tmp_path)
    params = [(100.0, 10.0)] * 7
    centers = [(0, [0.0] * 7)]
    scored, _ = live.score_packets(df, ranges, params, centers)
    out = sinks.conform(scored)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == \
        [(f.name, f.dataType.simpleString()) for f in SCORED_PACKET]
    r = out.first()
    assert (r.src_city, r.dst_city) == ("Mountain View", "ERROR")
    assert r.src_coordinates == [1.0, 2.0] and r.dst_coordinates == [0.0, 0.0]
    assert r.application_protocol == "DNS"


@pytest.mark.parametrize("ip_,city", [("192.168.91.191", "LOCAL"), ("127.0.0.1", "LOCAL"),
                                      ("9.9.9.9", "ERROR"), (None, "ERROR")])
def test_geo_defaults(spark, ip_, city):
    from flowlens.operators import enrich
    ranges = spark.createDataFrame([(3325256704, 3325256959, "X", 1.0, 2.0)],
                                   "ip_start bigint, ip_end bigint, city string, lon float, lat float")
    df = spark.createDataFrame([(ip_,)], "ip_src string")
    r = enrich.geo_enrich_range(df, ranges, ip="ip_src", prefix="src").first()
    assert r.src_city == city and r.src_coordinates == [0.0, 0.0]


def test_connector_and_csv_sinks(spark, tmp_path):
    from flowlens.sources import sinks
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    target = str(tmp_path / "t")
    sink = sinks.multi_sink(sinks.connector_batch_sink("parquet", target), sinks.parquet_batch_sink(str(tmp_path / "p")))
    sink(df, 0)
    sink(df, 0)                                   # a replayed batch
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert spark.read.parquet(target).count() == 4  # plain append target
    sinks.write_result_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
