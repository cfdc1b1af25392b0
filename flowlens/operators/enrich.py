"""Address enrichment by joins with dimension tables (geo, reputation).

Per-row HTTP lookups are replaced by joins:

* the addresses of a batch are de-duplicated first (one lookup per distinct
  address, the memoisation of the per-row cache), resolved against the
  dimension once, and the small resolved table is joined back for both the
  source and the destination side;
* a dimension is broadcast only after its row count has been checked
  against a bound; beyond the bound the join stays a shuffle join (and AQE
  may still turn it into a broadcast join from measured sizes);
* range dimensions (``ip_start``..``ip_end``) are joined through buckets of
  addresses: each range is exploded to the buckets it covers and the join is
  an equi-join on the bucket with the range test as a residual filter, instead
  of a nested-loop join.  Buckets are /24 if that makes few rows of the table,
  else /20 or /16 (at most 65,536 rows a range): a key is tested against every
  range of its bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import lon_lat_array
from ..functions.ip import ipv4_to_int

LOCAL_IP = "192.168.91.191"
LOOPBACK = "127.0.0.1"
BROADCAST_MAX_ROWS = 2_000_000
# Address bits of a bucket, the narrowest that fits, and the rows per range (or
# in all) that a narrow one may make.
BUCKET_BITS = 16
NARROW_BITS = (8, 12)
NARROW_ROWS, NARROW_TABLE = 4, 50_000

LOCAL_CITY = "LOCAL"
ERROR_CITY = "ERROR"


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only when the table is proven to hold at most ``max_rows``
    (default: session conf ``spark.flowlens.broadcastMaxRows``, else 2,000,000).
    The check reads at most ``max_rows + 1`` rows."""
    if max_rows is None:
        max_rows = int(df.sparkSession.conf.get("spark.flowlens.broadcastMaxRows", str(BROADCAST_MAX_ROWS)))
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def distinct_addresses(df: DataFrame, cols=("ip_src", "ip_dst")) -> DataFrame:
    """Distinct non-NULL addresses over the given columns (column ``ip``)."""
    parts = [df.select(F.col(c).alias("ip")) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("ip").isNotNull()).distinct()


def bucket_ranges(ranges: DataFrame, broadcast_ranges: bool = True) -> DataFrame:
    """Range table exploded to the buckets each range covers (column
    ``_bucket``, its width in the column's metadata), broadcast-hinted when its
    size check passes.  Build it once and reuse it for several lookups."""
    if "_bucket" in ranges.columns:
        return ranges
    shift = _bucket_bits(ranges)
    bucketed = ranges.select(
        "*", F.explode(F.sequence(F.shiftright("ip_start", shift), F.shiftright("ip_end", shift)))
        .alias("_bucket")).withMetadata("_bucket", {"bits": shift})
    return bounded_broadcast(bucketed) if broadcast_ranges else bucketed


def _bucket_bits(ranges: DataFrame) -> int:
    rows = [F.sum(F.shiftright("ip_end", s) - F.shiftright("ip_start", s) + 1) for s in NARROW_BITS]
    n, *made = ranges.agg(F.count("ip_start"), *rows).first()
    fit = [s for s, m in zip(NARROW_BITS, made) if m is not None and m <= max(NARROW_ROWS * n, NARROW_TABLE)]
    return fit[0] if fit else BUCKET_BITS


def range_lookup(keys: DataFrame, ranges: DataFrame, key_int: str = "ip_int",
                 broadcast_ranges: bool = True) -> DataFrame:
    """Join integer keys to ``[ip_start, ip_end]`` ranges via /16 buckets.

    Ranges are assumed not to overlap (as in geo databases); a key matches at
    most one range.  ``ranges`` may be raw or already bucketed
    (:func:`bucket_ranges`).  Returns ``keys`` columns plus the range
    attributes (left join: unmatched keys keep NULL attributes)."""
    attrs = [c for c in ranges.columns if c not in ("ip_start", "ip_end", "_bucket")]
    bucketed = bucket_ranges(ranges, broadcast_ranges)
    shift = bucketed.schema["_bucket"].metadata.get("bits", BUCKET_BITS)
    k = keys.withColumn("_bucket", F.shiftright(F.col(key_int), shift))
    cond = ((k["_bucket"] == bucketed["_bucket"])
            & k[key_int].between(bucketed["ip_start"], bucketed["ip_end"]))
    return k.join(bucketed, cond, "left").select(*[k[c] for c in keys.columns],
                                                 *[bucketed[c] for c in attrs])


def exact_geo_from_ranges(addresses: DataFrame, ranges: DataFrame) -> DataFrame:
    """Exact-address geo table (ip, city, region, country, lon, lat) for the
    given distinct addresses, resolved through the range dimension."""
    keyed = addresses.select("ip", ipv4_to_int("ip").alias("ip_int"))
    return range_lookup(keyed, ranges).filter(F.col("city").isNotNull()).drop("ip_int")


def _geo_side(ip: Column, city: Column, lon: Column, lat: Column, local_ips) -> tuple[Column, Column]:
    is_local = ip.isin(*local_ips)
    out_city = (F.when(is_local, F.lit(LOCAL_CITY))
                .when(city.isNotNull(), city).otherwise(F.lit(ERROR_CITY)))
    zero = lon_lat_array(F.lit(0.0), F.lit(0.0))
    point = F.when(is_local | city.isNull(), zero).otherwise(lon_lat_array(lon, lat))
    return out_city, point


def geo_enrich(df: DataFrame, geo: DataFrame, local_ips=(LOCAL_IP, LOOPBACK),
               src: str = "ip_src", dst: str = "ip_dst") -> DataFrame:
    """Add ``src_city, src_coordinates, dst_city, dst_coordinates``.

    ``geo`` is an exact-address table (ip, city, lon, lat).  Local addresses
    -> ``LOCAL`` at [0, 0]; unknown or NULL -> ``ERROR`` at [0, 0]."""
    g = bounded_broadcast(geo.select("ip", "city", "lon", "lat"))
    out = df
    for side, col in (("src", src), ("dst", dst)):
        gs = g.select(F.col("ip").alias(f"_{side}_ip"), F.col("city").alias(f"_{side}_c"),
                      F.col("lon").alias(f"_{side}_lon"), F.col("lat").alias(f"_{side}_lat"))
        out = out.join(gs, out[col] == gs[f"_{side}_ip"], "left")
        city, point = _geo_side(F.col(col), F.col(f"_{side}_c"), F.col(f"_{side}_lon"),
                                F.col(f"_{side}_lat"), local_ips)
        out = out.withColumns({f"{side}_city": city, f"{side}_coordinates": point}).drop(
            f"_{side}_ip", f"_{side}_c", f"_{side}_lon", f"_{side}_lat")
    return out


def geo_enrich_range(df: DataFrame, ranges: DataFrame, ip: str = "ip_dst", prefix: str = "dst",
                     local_ips=(LOCAL_IP, LOOPBACK)) -> DataFrame:
    """Range form for one address column: ``<prefix>_city``, lon, lat."""
    keyed = df.withColumn("_ip_int", ipv4_to_int(ip))
    cols = ["ip_start", "ip_end", "city", "lon", "lat"] + (["_bucket"] if "_bucket" in ranges.columns else [])
    r = bucket_ranges(ranges.select(*cols))
    r = r.select("ip_start", "ip_end", "_bucket", F.col("city").alias("_city"),
                 F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    joined = range_lookup(keyed, r, key_int="_ip_int")
    city, point = _geo_side(F.col(ip), F.col("_city"), F.col("_lon"), F.col("_lat"), local_ips)
    return joined.withColumns({f"{prefix}_city": city, f"{prefix}_coordinates": point}).drop(
        "_ip_int", "_city", "_lon", "_lat")


def resolve_addresses(df: DataFrame, ranges: DataFrame, cols=("ip_src", "ip_dst"),
                      checkpoint: bool = True) -> DataFrame:
    """Memoised lookup: distinct addresses of ``df`` resolved once.

    The resolved table is read three times (size check, source join,
    destination join), so by default it is written once to the shared
    checkpoint folder instead of recomputing the distinct each time."""
    resolved = exact_geo_from_ranges(distinct_addresses(df, cols), ranges)
    if checkpoint:
        from ..session import materialize
        resolved = materialize(resolved)
    return resolved


THREAT_SCORE_CUT = 50


def threat_enrich(df: DataFrame, reputation: DataFrame, local_ip: str = LOCAL_IP,
                  cut: int = THREAT_SCORE_CUT, src: str = "ip_src", dst: str = "ip_dst") -> DataFrame:
    """Add ``src_threat``/``dst_threat`` (``LOCAL``, ``true``, ``false``; NULL
    for a NULL address) and boolean ``*_threat_flag``.  An address missing
    from the reputation table scores 0; one listed twice has its highest
    score."""
    rep = bounded_broadcast(reputation.groupBy("ip").agg(F.max("score").alias("score")))
    out = df
    for side, col in (("src", src), ("dst", dst)):
        r = rep.select(F.col("ip").alias(f"_{side}_ip"), F.col("score").alias(f"_{side}_score"))
        out = out.join(r, out[col] == r[f"_{side}_ip"], "left")
        flag = F.coalesce(F.col(f"_{side}_score"), F.lit(0)) > F.lit(cut)
        text = (F.when(F.col(col).isNull(), F.lit(None).cast("string"))
                .when(F.col(col) == F.lit(local_ip), F.lit("LOCAL"))
                .when(flag, F.lit("true")).otherwise(F.lit("false")))
        out = out.withColumns({f"{side}_threat": text,
                               f"{side}_threat_flag": F.when(F.col(col).isNotNull(), flag)}).drop(
            f"_{side}_ip", f"_{side}_score")
    return out
