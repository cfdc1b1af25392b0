"""Longest-prefix lookup of IPv6 addresses.

A network ``address/length`` is two BIGINT halves with the bits beyond the
length cleared.  An address can only lie in one network of each length, so a
distinct address is listed once per length that the table holds (at most 129,
usually a few) and meets its networks by one equi-join on (length, halves);
the longest wins.  No range test and no nested loop; the networks are broadcast
behind a check of their number, else both sides are shuffled.

Text that is no IPv6 address, or a length outside 0 to 128, matches nothing; of
networks listed twice the smallest attributes count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ip import ipv6_halves
from ..functions.parse import let, try_int
from .enrich import bounded_broadcast, distinct_addresses


def _mask(bits: Column) -> Column:
    """The first ``bits`` of 64 set."""
    ones = F.lit(-1).cast("bigint")
    return (F.when(bits <= 0, F.lit(0).cast("bigint")).when(bits >= 64, ones)
            .otherwise(F.call_function("shiftleft", ones, (F.lit(64) - bits).cast("int"))))


def _network(halves: Column, length: Column) -> Column:
    return F.struct(length.alias("length"), halves["hi"].bitwiseAND(_mask(length)).alias("hi"),
                    halves["lo"].bitwiseAND(_mask(length - 64)).alias("lo"))


def networks(prefixes: DataFrame, col: str = "prefix") -> DataFrame:
    """``net`` (length and cleared halves) and ``attrs`` (the other columns), one row a network."""
    attrs = F.struct(*[F.col(f"`{c}`") for c in prefixes.columns if c != col])
    parts = F.split(F.col(col), "/")
    length = try_int(F.get(parts, 1))
    net = let(ipv6_halves(F.get(parts, 0)), lambda h: F.when(h.isNotNull() & length.between(0, 128), _network(h, length)))
    return (prefixes.select(net.alias("net"), attrs.alias("attrs")).filter(F.col("net").isNotNull())
            .groupBy("net").agg(F.min("attrs").alias("attrs")))


def longest_prefix(addresses: DataFrame, prefixes: DataFrame, col: str = "prefix") -> DataFrame:
    """``ip``, ``prefix_len`` and the attributes of the longest network holding
    each distinct address of column ``ip``; addresses in none are left out."""
    nets = networks(prefixes, col).select(F.col("net").alias("_net"), "attrs")
    lengths = sorted(r[0] for r in nets.select("_net.length").distinct().limit(129).collect())  # 0 to 128
    at = let(ipv6_halves("ip"), lambda h: F.when(h.isNotNull(), F.array(
        *[_network(h, F.lit(n).cast("int")) for n in lengths])))
    listed = addresses.select("ip", F.explode(at if lengths else F.array().cast("array<struct<length:int,hi:bigint,lo:bigint>>")).alias("net"))
    small = bounded_broadcast(nets)
    hit = listed.join(small, listed["net"] == small["_net"])
    best = hit.groupBy("ip").agg(F.max_by(F.struct(F.col("net.length").alias("prefix_len"), "attrs"), F.col("net.length")).alias("b"))
    return best.select("ip", "b.prefix_len", "b.attrs.*")


def resolve_addresses_v6(df: DataFrame, prefixes: DataFrame, cols=("ip_src", "ip_dst")) -> DataFrame:
    """Exact-address geo table of the distinct addresses of ``df``, for :func:`enrich.geo_enrich`."""
    return longest_prefix(distinct_addresses(df, cols), prefixes)
