"""Address classification and address-to-number conversion, natively.

IPv4 addresses become BIGINT (they fit); private networks are tested as
integer ranges, which is also the form the range lookups join on.  IPv6
values (128 bits) do not fit any Spark integer or ``decimal(38,0)``, so they
are normalised to a 32-character lowercase hex key, or to two BIGINT halves;
private prefix tests use the leading 32 bits of that key.
"""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import let

# Networks treated as private.  The documentation prefix
# 2001:db8::/32 sits in the IPv4 list, so it is never tested against IPv6
# addresses (it cannot contain an IPv4 address either).
PRIVATE_V4_LIST = [
    "10.0.0.0/8",
    "172.16.0.0/12",
    "192.168.0.0/16",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "224.0.0.0/4",
    "0.0.0.0/8",
    "2001:db8::/32",
]
PRIVATE_V6_LIST = [
    "fc00::/7",
    "fe80::/10",
    "ff00::/8",
]

_V4_NETS = [n for n in map(ipaddress.ip_network, PRIVATE_V4_LIST) if n.version == 4]
_V6_NETS = [ipaddress.ip_network(n) for n in PRIVATE_V6_LIST]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_RE = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ipv4_to_int(ip) -> Column:
    """Dotted IPv4 text -> BIGINT; anything that is not a strict dotted quad -> NULL."""
    s = _c(ip)
    left, right = F.substring_index(s, ".", 2), F.substring_index(s, ".", -2)
    octets = [F.substring_index(left, ".", 1), F.substring_index(left, ".", -1),
              F.substring_index(right, ".", 1), F.substring_index(right, ".", -1)]
    value = None
    for i, text in enumerate(octets):
        octet = text.cast("bigint") * F.lit(256 ** (3 - i))
        value = octet if value is None else value + octet
    return F.when(s.rlike(IPV4_RE), value)


def _ipv6_groups(ip) -> Column:
    """IPv6 text -> array of 8 hextets (lowercase, unpadded) or NULL."""
    return let(F.lower(F.trim(_c(ip))), _ipv6_groups_of)


def _ipv6_groups_of(s: Column) -> Column:
    # An embedded dotted IPv4 tail ("::ffff:1.2.3.4") becomes two hextets.
    def hextets(v4: Column) -> Column:
        return F.concat(F.regexp_replace(s, r"[0-9.]+$", ""), F.lower(F.hex(F.shiftright(v4, 16))), F.lit(":"),
                        F.lower(F.hex(v4.bitwiseAND(F.lit(0xFFFF)))))

    def without_tail(tail: Column) -> Column:
        return F.when(tail != "", let(ipv4_to_int(tail), hextets)).otherwise(s)
    tail = F.regexp_extract(s, rf":({_OCTET}(?:\.{_OCTET}){{3}})$", 1)
    return let(F.when(s.contains("."), let(tail, without_tail)).otherwise(s), _split_groups)


def _split_groups(s: Column) -> Column:
    # Every part is bound once: a split in a lambda is repeated for each use.
    def groups_of(part: Column) -> Column:
        return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ":"))

    def filled(left: Column, right: Column) -> Column:
        return let(F.lit(8) - F.size(left) - F.size(right), lambda fill: F.when(
            fill >= 1, F.concat(left, F.array_repeat(F.lit("0"), fill), right)))

    def joined(halves: Column) -> Column:
        gapped = let(groups_of(F.get(halves, 0)), lambda left: let(
            groups_of(F.get(halves, 1)), lambda right: filled(left, right)))
        return F.when(F.size(halves) == 2, F.when(~F.get(halves, 1).contains("::"), gapped)).otherwise(F.split(s, ":"))

    def checked(groups: Column) -> Column:
        return F.when((F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$")), groups)
    return F.when(s.rlike("^[0-9a-f:]+$"), let(let(F.split(s, "::", 2), joined), checked))


def ipv6_key(ip) -> Column:
    """IPv6 text -> 32-char lowercase hex key (its 128-bit value); invalid -> NULL."""
    return let(_ipv6_groups(ip), lambda groups: F.when(
        groups.isNotNull(), F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")))


def ipv6_halves(ip) -> Column:
    """IPv6 text -> ``struct<hi bigint, lo bigint>``, the bits of its two halves
    (negative from 2**63 on; :func:`unsigned_order` sorts them); invalid -> NULL."""
    def half(key: Column, at: int) -> Column:
        return F.conv(F.substring(key, at, 16), 16, -10).cast("bigint")
    return let(ipv6_key(ip), lambda key: F.when(key.isNotNull(), F.struct(half(key, 1).alias("hi"), half(key, 17).alias("lo"))))


def unsigned_order(half: Column) -> Column:
    """A BIGINT that sorts as the unsigned value of ``half``."""
    return half.bitwiseXOR(F.lit(-2 ** 63).cast("bigint"))


def ip_to_int(ip) -> Column:
    """IPv4 text -> BIGINT value (IPv6 has its own key: :func:`ipv6_key`)."""
    return ipv4_to_int(ip)


def ip_key(ip) -> Column:
    """Any address -> 32-char hex key of its integer value (IPv4 zero-extended);
    usable as one join key for both families."""
    return let(_c(ip), lambda s: let(ipv4_to_int(s), lambda v4: F.coalesce(
        F.when(v4.isNotNull(), F.lpad(F.lower(F.hex(v4)), 32, "0")), ipv6_key(s))))


def _in_v4_nets(value: Column) -> Column:
    def test(v: Column) -> Column:
        cond = F.lit(False)
        for net in _V4_NETS:
            lo, hi = int(net.network_address), int(net.broadcast_address)
            cond = cond | v.between(F.lit(lo), F.lit(hi))
        return cond
    return let(value, test)


def _in_v6_nets(key: Column) -> Column:
    # Every listed IPv6 prefix is at most /32: compare the leading 32 bits.
    def test(hi32: Column) -> Column:
        cond = F.lit(False)
        for net in _V6_NETS:
            drop = 32 - net.prefixlen
            want = int(net.network_address) >> (128 - 32) >> drop
            cond = cond | (F.shiftright(hi32, drop) == F.lit(want))
        return cond
    return let(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), test)


def is_private_ip(ip) -> Column:
    """TRUE for private/reserved addresses, FALSE for public ones and NULL
    input, NULL for text that is not an address."""
    def classify(s: Column) -> Column:
        return let(ipv4_to_int(s), lambda v4: F.when(s.isNull(), F.lit(False))
                   .when(v4.isNotNull(), _in_v4_nets(v4))
                   .otherwise(let(ipv6_key(s), lambda v6: F.when(v6.isNotNull(), _in_v6_nets(v6)))))
    return let(_c(ip), classify)
