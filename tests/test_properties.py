"""Property tests: the native parsers agree with Python's on generated input."""

import ipaddress

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowlens.functions import ip, parse

PREFIXES = st.sampled_from(["", "", "", "0x", "0X", "0o", "0b", "0"])
DIGITS = st.text(alphabet="0123456789abcdefxob_ -+", min_size=0, max_size=12)
INT_TEXT = st.one_of(
    st.integers(min_value=-2 ** 33, max_value=2 ** 33).map(str),
    st.builds(lambda s, p, d: s + p + d, st.sampled_from(["", "-", "+", " "]), PREFIXES, DIGITS),
)


def _py(v):
    try:
        n = int(v, 0)
    except ValueError:
        return None
    return n if -2 ** 31 <= n < 2 ** 31 else None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(INT_TEXT, min_size=1, max_size=40))
def test_prefixed_int_matches_base0(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.p for r in df.select("i", parse.prefixed_int("v").alias("p")).collect()}
    for i, v in enumerate(values):
        assert got[i] == _py(v), v


V4 = st.builds(lambda a, b, c, d: f"{a}.{b}.{c}.{d}", *[st.integers(0, 300)] * 4)
V6 = st.builds(lambda n, k: ipaddress.IPv6Address(n).compressed if k else ipaddress.IPv6Address(n).exploded,
               st.integers(0, 2 ** 128 - 1), st.booleans())
NETS4 = [ipaddress.ip_network(n) for n in ip.PRIVATE_V4_LIST]
NETS6 = [ipaddress.ip_network(n) for n in ip.PRIVATE_V6_LIST]


def _py_private(a):
    try:
        x = ipaddress.ip_address(a)
    except ValueError:
        return None
    return any(x.version == n.version and x in n for n in (NETS4 if x.version == 4 else NETS6))


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(V4, V6, st.sampled_from(["fe80::1", "fc00::", "ff02::1", "::ffff:10.1.2.3"])),
                min_size=1, max_size=40))
def test_addresses_match_ipaddress(spark, addrs):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(addrs)], "i int, a string")
    rows = df.select("i", ip.is_private_ip("a").alias("p"), ip.ip_key("a").alias("k")).collect()
    for r in rows:
        a = addrs[r.i]
        assert r.p == _py_private(a), a
        try:
            want = int(ipaddress.ip_address(a))
        except ValueError:
            want = None
        assert (int(r.k, 16) if r.k else None) == want, a
