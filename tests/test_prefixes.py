"""Longest-prefix lookup and IPv6 halves against ``ipaddress``."""

import ipaddress
import random

from flowlens.functions import ip
from flowlens.operators import enrich, prefixes

NETS = ["::/0", "2001:db8::/32", "2001:db8:1::/48", "2001:db8:1:2::/64", "2001:db8:1:2::10/124", "2001:db8:1:2::1f/128",
        "fd00::/8", "ffff:ffff::/32", "8000::/1"]


def _addresses():
    draw = random.Random(7)
    out = ["::", "::1", "2001:db8:1:2::1f", "2001:DB8:1:2::10", "2001:db8:1:2::1.2.3.4", "fd00::1", "ffff:ffff::1", "not", "1::2::3", "10.0.0.1"]
    for net in NETS[1:]:
        n = ipaddress.ip_network(net)
        out += [str(n[draw.randrange(n.num_addresses)]) for _ in range(8)] + [str(n.broadcast_address)]
    return sorted(set(out))


def _number(text):
    try:
        return int(ipaddress.IPv6Address(text))
    except ValueError:
        return None


def _expected(nets):
    want = {}
    for text in _addresses():
        v = _number(text)
        hit = [n for n in map(ipaddress.ip_network, nets) if v is not None and ipaddress.IPv6Address(v) in n]
        if hit:
            best = max(hit, key=lambda n: n.prefixlen)
            want[text] = (best.prefixlen, nets.index(str(best)))
    return want


def test_longest_prefix_equals_ipaddress(spark):
    df = spark.createDataFrame([(a,) for a in _addresses()] + [(None,)], "ip string")
    for nets in (NETS, NETS[1:]):
        table = spark.createDataFrame([(n, i) for i, n in enumerate(nets)], "prefix string, id int")
        got = {r.ip: (r.prefix_len, r.id) for r in prefixes.longest_prefix(df, table).collect()}
        assert got == _expected(nets)


def test_bits_beyond_the_length_repeats_and_bad_networks(spark):
    df = spark.createDataFrame([("2001:db8::5",)], "ip string")
    rows = [("2001:db8::9/32", 4), ("2001:db8::/32", 3), ("2001:db8::/129", 1), ("2001:db8::", 1), ("x/32", 1), (None, 1)]
    table = spark.createDataFrame(rows, "prefix string, id int")
    assert [tuple(r) for r in prefixes.longest_prefix(df, table).collect()] == [("2001:db8::5", 32, 3)]
    assert prefixes.longest_prefix(df, table.limit(0)).collect() == []
    assert prefixes.longest_prefix(df.limit(0), table).collect() == []


def test_halves_and_their_order(spark):
    texts = [a for a in _addresses() if _number(a) is not None]
    df = spark.createDataFrame([(a,) for a in texts], "ip string").withColumn("h", ip.ipv6_halves("ip"))
    got = {r.ip: (r.h.hi % 2 ** 64 << 64) + r.h.lo % 2 ** 64 for r in df.collect()}
    assert got == {a: _number(a) for a in texts}
    ordered = df.orderBy(ip.unsigned_order(df["h.hi"]), ip.unsigned_order(df["h.lo"])).collect()
    assert [_number(r.ip) for r in ordered] == sorted(map(_number, texts))


def test_resolved_addresses_enrich_packets(spark):
    p = spark.createDataFrame([(1, "2001:db8:1::1", "fd00::9"), (2, None, "1::1")], "packet_id int, ip_src string, ip_dst string")
    table = spark.createDataFrame([("2001:db8::/32", "A", 1.0, 2.0), ("fd00::/8", "B", 3.0, 4.0)],
                                  "prefix string, city string, lon float, lat float")
    out = enrich.geo_enrich(p, prefixes.resolve_addresses_v6(p, table)).orderBy("packet_id")
    assert [(r.src_city, r.dst_city) for r in out.collect()] == [("A", "B"), ("ERROR", "ERROR")]
