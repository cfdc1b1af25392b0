"""Binding to the driver's generated tables.

There is no packet table among the inputs; ``events`` is the stream-like one.
``packets_from_events`` turns each event into one decoded packet record
(same nested schema as the NDJSON decoder produces) with deterministic
rules, so every packet job runs over the whole ``events`` table and its cost
grows with it.  The matching DuckDB definition lives in
``flowlens.plans.oracle`` and yields the same rows.

Dimensions for the lookups are derived from ``nation`` (geo) and
``customer`` (reputation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ip import ipv4_to_int

# Fixed values of the binding: local address, stacks per event type, and the
# destination port chosen by k % 10.
LOCAL_IP = "192.168.91.191"
STACK_BY_EVENT = {
    "view": "eth:ethertype:ip:tcp:tls",
    "click": "eth:ethertype:ip:tcp:http",
    "purchase": "eth:ethertype:ip:tcp",
    "signup": "eth:ethertype:ip:udp:dns",
}
STACK_ICMP = "eth:ethertype:ip:icmp"
STACK_UDP = "eth:ethertype:ip:udp"
DST_PORTS = ["22", "443", "53", "80", "3306", "5432", "6379", "8080", "9999", "1111"]


def read_table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    """Read one generated table; with ``key``, spread it over the cores."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, key) if key else df


#: Rows of a partition where :func:`spread` deals out a large table.
SPREAD_ROWS = 500_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give an input split into fewer partitions than there are cores (a file
    holding one row group) one partition per core, hash-partitioned on its
    row key (deterministic on retry).  A larger file is split by bytes, but a
    row group is read by one task only: where the largest partition holds more
    than twice a core's share of the rows (counted from the files' footers), the
    rows are dealt out too, :data:`SPREAD_ROWS` or fewer to a partition.  Inputs
    already split evenly, as most large tables are, are left alone: no extra
    shuffle at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    held = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    total, most = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most <= 2 * total / cores:
        return df
    return df.repartition(max(cores, -(-total // SPREAD_ROWS)), key)


def _s(c: Column) -> Column:
    return c.cast("string")


def packets_from_events(events: DataFrame) -> DataFrame:
    """events -> (packet_id, timestamp, layers) decoded packet records."""
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").try_cast("int")
    v6 = (eid % 97) == 0
    is_tcp = et.isin("view", "click", "purchase")
    icmp_only = (et == "error") & ((eid % 5) == 0)
    is_udp = (et == "signup") | ((et == "error") & ((eid % 5) != 0))
    ts = F.col("ts").cast("timestamp")
    ts_ms = F.unix_millis(ts)

    stack = F.coalesce(*[F.when(et == e, F.lit(s)) for e, s in STACK_BY_EVENT.items()],
                       F.when(icmp_only, F.lit(STACK_ICMP)), F.lit(STACK_UDP))
    src_port = _s(F.lit(40000) + eid % 20000)
    dst_port = F.element_at(F.array(*[F.lit(p) for p in DST_PORTS]), (k % 10 + 1).cast("int"))
    ip_src = (F.when(v6, F.lit(None).cast("string"))
              .when(uid % 10 == 0, F.lit(LOCAL_IP))
              .otherwise(F.concat(F.lit("10.0."), _s(uid % 25), F.lit("."), _s(uid))))
    ip_dst = F.concat(F.lit("8."), _s(k % 4), F.lit("."), _s(eid % 25), F.lit("."), _s(eid % 200))
    value_floor = F.floor("value")
    qname = F.concat(F.lit("host"), _s(k), F.lit(".example"))

    frame = F.struct(
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000Z")).alias("frame_frame_time"),
        _s(eid).alias("frame_frame_number"),
        _s((F.lit(60) + value_floor).cast("int")).alias("frame_frame_len"),
        stack.alias("frame_frame_protocols"))
    eth = F.struct(F.lit("02:00:00:00:00:01").alias("eth_eth_src"),
                   F.lit("02:00:00:00:00:02").alias("eth_eth_dst"),
                   F.when(v6, F.lit("0x86dd")).otherwise(F.lit("0x0800")).alias("eth_eth_type"))
    ip = F.when(~v6, F.struct(
        ip_src.alias("ip_ip_src"), ip_dst.alias("ip_ip_dst"),
        _s(F.when(is_tcp, F.lit(6)).when(icmp_only, F.lit(1)).otherwise(F.lit(17))).alias("ip_ip_proto"),
        _s((F.lit(46) + value_floor).cast("int")).alias("ip_ip_len")))
    udp = F.when(is_udp, F.struct(src_port.alias("udp_udp_srcport"), dst_port.alias("udp_udp_dstport")))
    tcp = F.when(is_tcp, F.struct(src_port.alias("tcp_tcp_srcport"), dst_port.alias("tcp_tcp_dstport")))
    dns = F.when(et == "signup", F.struct(
        qname.alias("dns_dns_qry_name"), F.lit("1").alias("dns_dns_qry_type"),
        F.lit("0x0001").alias("dns_dns_qry_class"),
        F.array(qname).alias("dns_dns_resp_name"), F.array(F.lit("1")).alias("dns_dns_resp_type"),
        F.array(F.lit("0x0001")).alias("dns_dns_resp_class")))

    return events.select(
        eid.alias("packet_id"),
        _s(ts_ms).alias("timestamp"),
        F.struct(frame.alias("frame"), eth.alias("eth"), ip.alias("ip"), udp.alias("udp"),
                 tcp.alias("tcp"), dns.alias("dns")).alias("layers"))


# Fixed values of the volume binding over lineitem: stack by (return flag,
# line status).
STACK_BY_FLAGS = {
    ("R", "F"): "eth:ethertype:ip:tcp:tls",
    ("R", "O"): "eth:ethertype:ip:tcp:tls",
    ("A", "F"): "eth:ethertype:ip:tcp:http",
    ("A", "O"): "eth:ethertype:ip:tcp:http",
    ("N", "F"): "eth:ethertype:ip:tcp",
    ("N", "O"): "eth:ethertype:ip:udp:dns",
}


def packets_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Volume variant: each lineitem row -> one IPv4 TCP/UDP packet.

    packet_id = orderkey * 8 + linenumber (not unique in the generated data);
    time = ship date + (orderkey % 86400) s + linenumber ms; source
    10.0.(suppkey % 25).(suppkey % 256); destination 8.(partkey % 4).
    (partkey % 25).(partkey % 200); stack from the two flags; ports
    40000 + orderkey % 20000 -> port(linenumber); lengths from quantity."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    flags = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    stack = F.coalesce(*[F.when(flags == a + b, F.lit(v)) for (a, b), v in STACK_BY_FLAGS.items()])
    is_udp = flags == "NO"
    ts = (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(secs=(ok % 86400).cast("decimal(18,6)"))
          + F.make_dt_interval(secs=(ln.cast("decimal(18,6)") / 1000)))
    src_port = _s(F.lit(40000) + ok % 20000)
    dst_port = F.element_at(F.array(*[F.lit(p) for p in DST_PORTS]), (ln % 10 + 1).cast("int"))
    q = F.floor("l_quantity")
    frame = F.struct(
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("000Z")).alias("frame_frame_time"),
        _s(ok * 8 + ln).alias("frame_frame_number"),
        _s((F.lit(60) + q).cast("int")).alias("frame_frame_len"),
        stack.alias("frame_frame_protocols"))
    eth = F.struct(F.lit("02:00:00:00:00:01").alias("eth_eth_src"), F.lit("02:00:00:00:00:02").alias("eth_eth_dst"),
                   F.lit("0x0800").alias("eth_eth_type"))
    ip = F.struct(
        F.concat(F.lit("10.0."), _s(sk % 25), F.lit("."), _s(sk % 256)).alias("ip_ip_src"),
        F.concat(F.lit("8."), _s(pk % 4), F.lit("."), _s(pk % 25), F.lit("."), _s(pk % 200)).alias("ip_ip_dst"),
        F.when(is_udp, F.lit("17")).otherwise(F.lit("6")).alias("ip_ip_proto"),
        _s((F.lit(46) + q).cast("int")).alias("ip_ip_len"))
    udp = F.when(is_udp, F.struct(src_port.alias("udp_udp_srcport"), dst_port.alias("udp_udp_dstport")))
    tcp = F.when(~is_udp, F.struct(src_port.alias("tcp_tcp_srcport"), dst_port.alias("tcp_tcp_dstport")))
    dns = F.lit(None).cast(
        "struct<dns_dns_qry_name:string,dns_dns_qry_type:string,dns_dns_qry_class:string,"
        "dns_dns_resp_name:array<string>,dns_dns_resp_type:array<string>,dns_dns_resp_class:array<string>>")
    return lineitem.select(
        (ok * 8 + ln).alias("packet_id"),
        _s(F.unix_millis(ts)).alias("timestamp"),
        F.struct(frame.alias("frame"), eth.alias("eth"), ip.alias("ip"), udp.alias("udp"),
                 tcp.alias("tcp"), dns.alias("dns")).alias("layers"))


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_from_events(read_table(spark, sf_dir, "events", key="event_id"))


# ---------------------------------------------------------------- dimensions

def geo_range_dimension(nation: DataFrame) -> DataFrame:
    """IP-range geo dimension from ``nation``: for every nation n the ranges
    10.0.n.0-255 and 8.x.n.0-255 (x = 0..2); city = name, lon = nation key,
    lat = region key.  Packets to 8.3.* and IPv6 packets are unknown."""
    prefixes = F.array(F.lit("10.0."), *[F.lit(f"8.{x}.") for x in range(3)])
    rows = nation.select("n_nationkey", "n_name", "n_regionkey",
                    F.explode(prefixes).alias("prefix"))
    base = F.concat(F.col("prefix"), F.col("n_nationkey").cast("string"))
    return rows.select(
        ipv4_to_int(F.concat(base, F.lit(".0"))).alias("ip_start"),
        ipv4_to_int(F.concat(base, F.lit(".255"))).alias("ip_end"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("region"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").cast("float").alias("lon"),
        F.col("n_regionkey").cast("float").alias("lat"))


def reputation_dimension(customer: DataFrame) -> DataFrame:
    """Reputation scores from ``customer``, an address for every customer:
    10.(key / 6400 % 256).(key % 25).(key / 25 % 256); score =
    floor(|account balance|) % 101."""
    k = F.col("c_custkey")
    return customer.select(
        F.concat(F.lit("10."), _s(F.floor(k / 6400) % 256), F.lit("."), _s(k % 25), F.lit("."),
                 _s(F.floor(k / 25) % 256)).alias("ip"),
        (F.floor(F.abs("c_acctbal")).cast("int") % 101).alias("score"))


def ipv6_addresses(events: DataFrame) -> DataFrame:
    """``packet_id, ip_src, ip_dst`` as IPv6 text for every event.

    Source 2001:db8:(user % 4):(user % 25)::(user % 65536), written short, in
    full upper case or with a dotted tail (by event_id % 3); NULL for every
    101st event, no address for every 103rd.  Destination
    2a00 or fd00 (k even, odd):(k % 7):(event % 25)::(event % 200)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").try_cast("int")

    def hx(c: Column) -> Column:
        return F.lower(F.hex(c.cast("bigint")))
    host = uid % 65536
    short = F.concat(F.lit("2001:db8:"), hx(uid % 4), F.lit(":"), hx(uid % 25), F.lit("::"), hx(host))
    full = F.upper(F.concat(F.lit("2001:0db8:"), F.lpad(hx(uid % 4), 4, "0"), F.lit(":"), F.lpad(hx(uid % 25), 4, "0"),
                            F.lit(":0000:0000:0000:"), F.lpad(hx(host), 4, "0")))
    dotted = F.concat(F.lit("2001:db8:"), hx(uid % 4), F.lit(":"), hx(uid % 25), F.lit(":0:0:0.0."),
                      _s(F.floor(host / 256)), F.lit("."), _s(host % 256))
    src = (F.when(eid % 101 == 0, F.lit(None).cast("string")).when(eid % 103 == 0, F.lit("2001:db8:::1"))
           .when(eid % 3 == 0, short).when(eid % 3 == 1, full).otherwise(dotted))
    dst = F.concat(F.when(k % 2 == 0, F.lit("2a00:")).otherwise(F.lit("fd00:")), hx(k % 7), F.lit(":"),
                   hx(eid % 25), F.lit("::"), hx(eid % 200))
    return events.select(eid.alias("packet_id"), src.alias("ip_src"), dst.alias("ip_dst"))


def geo_prefix_dimension(nation: DataFrame, region: DataFrame) -> DataFrame:
    """IPv6 networks that hold one another.  Regions r: 2001:db8:r::/48,
    2a00:r::/32 and fd00::/8 (the smallest name counts).  Nations n of region r:
    2001:db8:r:n::/64 and 2a00:r:n::(4n)/126.  Longitude = key, latitude = 0."""
    def hx(c: str) -> Column:
        return F.lower(F.hex(F.col(c).cast("bigint")))
    r, n = hx("n_regionkey"), hx("n_nationkey")
    of_nation = F.array(F.concat(F.lit("2001:db8:"), r, F.lit(":"), n, F.lit("::/64")),
                        F.concat(F.lit("2a00:"), r, F.lit(":"), n, F.lit("::"),
                                 F.lower(F.hex((F.col("n_nationkey") * 4).cast("bigint"))), F.lit("/126")))
    of_region = F.array(F.concat(F.lit("2001:db8:"), hx("r_regionkey"), F.lit("::/48")),
                        F.concat(F.lit("2a00:"), hx("r_regionkey"), F.lit("::/32")), F.lit("fd00::/8"))
    zero = F.lit(0.0).cast("float").alias("lat")
    return (nation.select(F.explode(of_nation).alias("prefix"), F.col("n_name").alias("city"),
                          F.col("n_nationkey").cast("float").alias("lon"), zero)
            .unionByName(region.select(F.explode(of_region).alias("prefix"), F.col("r_name").alias("city"),
                                       F.col("r_regionkey").cast("float").alias("lon"), zero)))
