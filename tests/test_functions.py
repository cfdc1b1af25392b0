"""Scalar functions checked against Python's own parsers."""

import ipaddress

import pytest
from pyspark.sql import functions as F

from flowlens.functions import geo, ip, parse, protocol

INT_CASES = ["172", "0x1f", "0X1F", "0o17", "0b101", "007", "abc", None, "1_000", "00", "0", "-5", "+5",
             " 42 ", "0x", "0x1g", "-0x10", "0b102", "1__0", "_1", "1_", "0_0", "99999999999", "0x_1f",
             "-0", "+0x1f", "2147483647", "2147483648", "-2147483648", "", "  "]


def _py_int0(v):
    if v is None:
        return None
    try:
        n = int(v, 0)
    except ValueError:
        return None
    return n if -2 ** 31 <= n < 2 ** 31 else None


def test_prefixed_int_matches_base0_parse(spark):
    df = spark.createDataFrame([(v,) for v in INT_CASES], "v string")
    got = {r.v: r.p for r in df.select("v", parse.prefixed_int("v").alias("p")).collect()}
    for v in INT_CASES:
        assert got[v] == _py_int0(v), v


def test_layer_int_absent_layer_is_zero(spark):
    df = spark.createDataFrame([(None,), (("x",),), (("7",),)], "l struct<f: string>")
    got = [r.v for r in df.select(parse.layer_int("l", "f").alias("v")).collect()]
    assert got == [0, None, 7]


ADDRS = ["172.15.255.255", "172.16.0.0", "224.0.0.1", "0.1.2.3", "2001:db8::1", "fe80::1", "::1", None,
         "8.8.8.8", "192.168.3.105", "256.1.1.1", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "fc00::",
         "fd12:3456::1", "ff02::1", "::ffff:10.0.0.1", "1::2::3", "01.2.3.4", "10.0.0.1", "abc",
         "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::", "1:2:3:4:5:6:7:8:9", "12345::1", "FE80::ABCD"]
V4 = [ipaddress.ip_network(n) for n in ip.PRIVATE_V4_LIST]
V6 = [ipaddress.ip_network(n) for n in ip.PRIVATE_V6_LIST]


def _py_private(a):
    if a is None:
        return False
    try:
        x = ipaddress.ip_address(a)
    except ValueError:
        return None
    nets = V4 if x.version == 4 else V6
    return any(x.version == n.version and x in n for n in nets)


def _py_int(a):
    try:
        return int(ipaddress.ip_address(a))
    except (ValueError, TypeError):
        return None


def test_private_and_integer_forms(spark):
    df = spark.createDataFrame([(a,) for a in ADDRS], "a string")
    rows = df.select("a", ip.is_private_ip("a").alias("p"), ip.ipv4_to_int("a").alias("i4"),
                     ip.ipv6_key("a").alias("k6"), ip.ip_key("a").alias("k")).collect()
    for r in rows:
        assert r.p == _py_private(r.a), r.a
        got = r.i4 if r.i4 is not None else (int(r.k6, 16) if r.k6 else None)
        assert got == _py_int(r.a), r.a
        assert (int(r.k, 16) if r.k else None) == _py_int(r.a), r.a


def test_fixture_addresses(spark):
    # FIXTURES edge rows 13 and 14.
    cases = {"172.15.255.255": False, "172.16.0.0": True, "224.0.0.1": True, "0.1.2.3": True,
             "2001:db8::1": False, "fe80::1": True, "::1": False, None: False}
    df = spark.createDataFrame([(a,) for a in cases], "a string")
    got = {r.a: r.p for r in df.select("a", ip.is_private_ip("a").alias("p")).collect()}
    assert got == cases
    k = spark.createDataFrame([("::1",)], "a string").select(ip.ipv6_key("a")).first()[0]
    assert k == "0" * 31 + "1"


@pytest.mark.parametrize("stack,expected", [
    ("eth:ethertype:ip:udp:dns", "DNS"),
    ("eth:ethertype:ip:icmp:ip:udp:dns", "ICMP"),
    ("eth:ethertype:ip:tcp:tls", "HTTPS"),
    ("eth:ethertype:ip:tcp", "Unknown"),
    (None, "Unknown"),
    ("", "Unknown"),
])
def test_protocol_from_stack(spark, stack, expected):
    df = spark.createDataFrame([(stack,)], "s string")
    assert df.select(protocol.protocol_from_stack("s")).first()[0] == expected


@pytest.mark.parametrize("src,dst,expected", [
    ("40000", "5432", "PostgreSQL"), ("22", "443", "SSH"), ("40000", "9999", "Unknown"),
    (None, None, "Unknown"), ("444", "1111", "Unknown"),
])
def test_protocol_resolution_by_port(spark, src, dst, expected):
    df = spark.createDataFrame([("eth:ethertype:ip:udp", src, dst)], "s string, a string, b string")
    assert df.select(protocol.resolve_protocol("s", "a", "b")).first()[0] == expected


def test_sql_registered_detectors(spark):
    protocol.register_sql_functions(spark)
    r = spark.sql("SELECT application_extraction('eth:ip:udp:dns') a, application_detection('22') b,"
                  " application_detection('1') c").first()
    assert (r.a, r.b, r.c) == ("DNS", "SSH", "Unknown")


def test_times(spark):
    df = spark.createDataFrame([("1700000000123", "2023-11-14T22:13:20.123456789Z",
                                 "Feb  1 2020 03:19:45.377844893 ", "Feb 11 2020 03:19:45.377844893 ")],
                               "ms string, iso string, t1 string, t2 string")
    r = df.select(parse.format_epoch_ms("ms").alias("f"),
                  parse.iso_nanos_to_time("iso").cast("string").alias("iso"),
                  parse.tshark_time("t1").cast("string").alias("t1"),
                  parse.tshark_time("t2").cast("string").alias("t2")).first()
    assert r.f == "2023-11-14 22:13:20"
    assert r.iso == "2023-11-14 22:13:20.123456"
    assert r.t1 == "2020-02-01 03:19:45.377844"
    assert r.t2 == "2020-02-11 03:19:45.377844"
    bad = spark.createDataFrame([("abc",), ("",), (None,)], "ms string")
    assert [x[0] for x in bad.select(parse.format_epoch_ms("ms")).collect()] == [None, None, None]


def test_geo_points(spark):
    df = spark.createDataFrame([("48.85,2.35",), ("x",)], "t string")
    rows = df.select(geo.latlon_text_to_point("t").alias("p")).collect()
    assert rows[0].p == pytest.approx([2.35, 48.85], rel=1e-6)
    assert rows[1].p is None
    j = spark.range(1).select(geo.geo_object_json(F.lit(1.5), F.lit(2.5), F.lit("X"))).first()[0]
    assert j == '{"region":"X","loc":{"lat":1.5,"lon":2.5}}'
