"""Overlapping address ranges: flattened into disjoint ones, then an as-of lookup.

``flatten`` sweeps the range ends: wherever ranges overlap the narrowest one
holds (of equal widths the one that starts first, then the least attributes), and
what is left of the others is cut into pieces.  The number line is cut into
chunks at quantiles of the range starts, ranges are cut at the chunk borders, and
each chunk is swept in order with a heap of the ranges that are open, so a task
holds as many ranges as are nested at one place and a wide range is one piece
per chunk, whatever it covers.

``asof_lookup`` needs no equality between keys and ranges: the sorted union of
keys and pieces of a chunk is read once, every key takes the last piece that
started before it, if that has not ended.  A range that covers the whole line
costs no more than a single address.

Ranges with a null bound or an end before the start are left out; null keys
find nothing and are kept.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK_ROWS = 50_000
MAX_CHUNKS = 4_096


def chunk_borders(ranges: DataFrame, start: str, rows: int = CHUNK_ROWS) -> list[int]:
    """Starts of the chunks after the first: quantiles of the range starts."""
    n = ranges.count()
    chunks = min(MAX_CHUNKS, -(-n // rows))
    if chunks < 2:
        return []
    at = ranges.select(F.col(start).cast("double").alias("s")).approxQuantile(
        "s", [i / chunks for i in range(1, chunks)], 0.1 / chunks)
    return sorted({int(v) for v in at})


def chunk_of(value: Column, borders: list[int]) -> Column:
    """How many borders are at or below the value, by halving."""
    def half(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(borders[mid]), half(lo, mid)).otherwise(half(mid + 1, hi))
    if len(borders) <= 64:
        return half(0, len(borders))
    return F.size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b <= value))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk and start, in; disjoint pieces in order, out."""
    open_: list[tuple] = []  # (width, start before cutting, attributes as text, end, row)
    out: list[tuple] = []
    at, chunk = 0, None

    def advance(to: int | None) -> None:
        """Give out the pieces from ``at`` up to ``to`` (all that is open)."""
        nonlocal at
        while open_:
            _, _, _, end, row = open_[0]
            if end < at:
                heapq.heappop(open_)
                continue
            stop = end if to is None else min(end, to - 1)
            if stop >= at:
                if out and out[-1][0] == chunk and out[-1][3] is row and out[-1][2] == at - 1:
                    out[-1] = (chunk, out[-1][1], stop, row)
                else:
                    out.append((chunk, at, stop, row))
                at = stop + 1
            if to is not None and at >= to:
                return
        if to is not None:
            at = max(at, to)

    def flushed(keep: int) -> pa.RecordBatch:
        part = out[:len(out) - keep]
        del out[:len(out) - keep]
        rows = [p[3] for p in part]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in part], pa.int32()), pa.array([p[1] for p in part], pa.int64()),
             pa.array([p[2] for p in part], pa.int64()), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]],
            ["chunk", "start", "end", *names])
    names, kinds = [], []
    for b in batches:
        names, kinds = b.schema.names[5:], b.schema.types[5:]
        cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
        for c, start, end, width, first, *row in zip(*cols):
            if c != chunk:
                advance(None)
                chunk, at = c, start
            advance(start)
            heapq.heappush(open_, (width, first, repr(row), end, row))
        if len(out) > 10_000:
            yield flushed(1)
    advance(None)
    if out:
        yield flushed(0)


def flatten(ranges: DataFrame, start: str = "ip_start", end: str = "ip_end", borders: list[int] | None = None) -> DataFrame:
    """Disjoint pieces ``chunk, <start>, <end>`` with the attributes of the
    narrowest range that covers them."""
    attrs = [c for c in ranges.columns if c not in (start, end)]
    good = ranges.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    borders = chunk_borders(good, start) if borders is None else borders
    low = F.array(*[F.lit(b).cast("bigint") for b in [-(1 << 62), *borders]])
    high = F.array(*[F.lit(b - 1).cast("bigint") for b in borders], F.lit(1 << 62).cast("bigint"))
    first, last = chunk_of(F.col(start), borders), chunk_of(F.col(end), borders)
    cut = good.withColumn("_c", F.explode(F.sequence(first, last))).select(
        F.col("_c").cast("int").alias("_c"), F.greatest(F.col(start).cast("bigint"), F.get(low, F.col("_c"))).alias("_s"),
        F.least(F.col(end).cast("bigint"), F.get(high, F.col("_c"))).alias("_e"),
        (F.col(end) - F.col(start)).cast("bigint").alias("_w"), F.col(start).cast("bigint").alias("_o"), *[F.col(c) for c in attrs])
    kinds = ", ".join(f"`{c}` {ranges.schema[c].dataType.simpleString()}" for c in attrs)
    dealt = cut.repartition("_c").sortWithinPartitions("_c", "_s", "_w")
    out = dealt.mapInArrow(_sweep, "chunk int, start bigint, end bigint" + (", " + kinds if kinds else ""))
    return out.withColumnsRenamed({"start": start, "end": end})


def asof_lookup(keys: DataFrame, key: str, ranges: DataFrame, start: str = "ip_start", end: str = "ip_end",
                rows: int = CHUNK_ROWS) -> DataFrame:
    """``keys`` (one row each) with the attributes of the narrowest range that
    holds ``key``, null where none does."""
    attrs = [c for c in ranges.columns if c not in (start, end)]
    good = ranges.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    borders = chunk_borders(good, start, rows)
    flat = flatten(good, start, end, borders)
    piece = F.struct(F.col(end).alias("_end"), *[F.col(c) for c in attrs])
    right = flat.select(F.col("chunk").alias("_c"), F.col(start).alias("_at"), F.lit(0).alias("_kind"), piece.alias("_piece"),
                        F.lit(None).cast(keys.select(F.struct(*[F.col(f"`{c}`") for c in keys.columns])).schema[0].dataType).alias("_row"))
    known = keys.where(F.col(key).isNotNull())
    left = known.select(chunk_of(F.col(key).cast("bigint"), borders).cast("int").alias("_c"), F.col(key).cast("bigint").alias("_at"),
                        F.lit(1).alias("_kind"), F.lit(None).cast(right.schema["_piece"].dataType).alias("_piece"),
                        F.struct(*[F.col(f"`{c}`") for c in keys.columns]).alias("_row"))
    w = Window.partitionBy("_c").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = (left.unionByName(right).withColumn("_last", F.last("_piece", ignorenulls=True).over(w)).where("_kind = 1"))
    inside = F.col("_last").isNotNull() & (F.col("_at") <= F.col("_last._end"))
    found = held.select(*[F.col("_row").getField(c).alias(c) for c in keys.columns],
                        *[F.when(inside, F.col("_last").getField(c)).alias(c) for c in attrs])
    none = keys.where(F.col(key).isNull()).select(
        *[F.col(f"`{c}`") for c in keys.columns], *[F.lit(None).cast(ranges.schema[c].dataType).alias(c) for c in attrs])
    return found.unionByName(none)


def resolve_overlapping(df: DataFrame, ranges: DataFrame, ip_cols=("ip_src", "ip_dst"), to_int=None) -> DataFrame:
    """``ip`` and the attributes of its narrowest range, for every distinct
    address of ``df`` that has one: the exact-address table that the geo
    enrichment joins, for range tables that overlap."""
    from ..functions.ip import ipv4_to_int
    from .enrich import distinct_addresses
    keys = distinct_addresses(df, ip_cols).withColumn("_ip_int", (to_int or ipv4_to_int)("ip"))
    attrs = [c for c in ranges.columns if c not in ("ip_start", "ip_end")]
    out = asof_lookup(keys, "_ip_int", ranges.withColumn("_hit", F.lit(True)))
    return out.where("_hit").select("ip", *attrs)


