"""Event-time window features and the join back to packets.

Window aggregates of a stream (after ``withWatermark``) and tumbling ones are
ordinary ``groupBy(window(...), keys)`` aggregations: partial aggregation per
partition, one shuffle of (window, key) partial rows.  Sliding windows of a
table are summed up from panes, so packets are never listed once per window.

Join-back attaches the features of every window a packet falls in.  The
naive form, an equi-join on the keys with ``start <= t <= end`` as a
residual filter, pairs every packet with every window of its key (the key
is a protocol stack: a handful of values, so a few tasks see almost every
pair).  The exploded form instead lists, per packet, the few window starts
that can contain it (``ceil(len/slide)``, plus one for a packet exactly on a
window end when the end is inclusive): windows are listed per pane, packets join their own pane
once, and the window list is exploded after the join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

US = 1_000_000


def parse_duration_us(text: str) -> int:
    """``"15 seconds"``, ``"1 minute"``, ``"1 hour"`` ... -> microseconds."""
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    mult = {"microsecond": 1, "millisecond": 1000, "second": US, "minute": 60 * US,
            "hour": 3600 * US, "day": 86400 * US}[unit]
    return int(float(n) * mult)


def ratio(avg_c: Column, max_c: Column) -> Column:
    """``avg / max`` when ``max > 0``, else NULL (never a division error)."""
    return F.when(max_c.isNotNull() & (max_c > 0), avg_c / max_c)


def pane_partials(df: DataFrame, time_col: str, pane_us: int, keys: list[str], ip_len: str = "ip_len",
                  frame_len: str = "frame_len") -> DataFrame:
    """Mergeable partials of (``_pane``, keys): row count, and sum, count and
    maximum of both lengths.  Rows without a time are left out."""
    t = _micros(F.col(time_col))
    sums = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate((ip_len, frame_len)):
        sums += [F.sum(F.col(c).cast("double")).alias(f"_s{i}"), F.count(c).alias(f"_c{i}"), F.max(c).alias(f"_m{i}")]
    return (df.filter(F.col(time_col).isNotNull())
            .groupBy((t - F.pmod(t, F.lit(pane_us))).alias("_pane"), *keys).agg(*sums))


def windows_of_panes(panes: DataFrame, length_us: int, slide_us: int, keys: list[str]) -> DataFrame:
    """Windows summed up from :func:`pane_partials`: each pane row is listed for
    the windows that hold it.  Several rows of one pane (of several batches) add up."""
    latest = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(slide_us))
    starts = F.transform(F.sequence(F.lit(0), F.lit(math.ceil(length_us / slide_us) - 1)),
                         lambda i: latest - i.cast("bigint") * F.lit(slide_us))
    held = F.filter(starts, lambda s: s + F.lit(length_us) > F.col("_pane"))
    listed = panes.select("*", F.explode(held).alias("_start"))
    g = listed.groupBy("_start", *keys).agg(
        F.sum("_n").alias("count"),
        (F.sum("_s0") / F.nullif(F.sum("_c0"), F.lit(0))).alias("ip_avg_len"), F.max("_m0").alias("max_ip_len"),
        (F.sum("_s1") / F.nullif(F.sum("_c1"), F.lit(0))).alias("frame_avg_len"), F.max("_m1").alias("max_frame_len"))
    w = F.struct(F.timestamp_micros("_start").alias("start"),
                 F.timestamp_micros(F.col("_start") + F.lit(length_us)).alias("end"))
    return _with_ratios(g.select(w.alias("time_window"), *keys, "count", "ip_avg_len", "max_ip_len",
                                 "frame_avg_len", "max_frame_len"))


def _with_ratios(g: DataFrame) -> DataFrame:
    return g.withColumns({
        "ip_local_anomaly": ratio(F.col("ip_avg_len"), F.col("max_ip_len")),
        "frame_local_anomaly": ratio(F.col("frame_avg_len"), F.col("max_frame_len")),
        "start": F.col("time_window.start"),
        "end": F.col("time_window.end"),
    })


def window_features(df: DataFrame, time_col: str, length: str, slide: str | None = None,
                    keys: list[str] = ("frame_protocols",), ip_len: str = "ip_len",
                    frame_len: str = "frame_len") -> DataFrame:
    """Per (window, keys): count, average/max lengths and the avg/max ratios.

    Output: ``time_window`` struct, ``start``, ``end``, keys, ``count``,
    ``ip_avg_len``, ``max_ip_len``, ``frame_avg_len``, ``max_frame_len``,
    ``ip_local_anomaly``, ``frame_local_anomaly``."""
    if slide and not df.isStreaming and df.schema[time_col].dataType == T.TimestampType():
        length_us, slide_us = parse_duration_us(length), parse_duration_us(slide)
        panes = pane_partials(df, time_col, math.gcd(length_us, slide_us), list(keys), ip_len, frame_len)
        return windows_of_panes(panes, length_us, slide_us, list(keys))
    w = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    return _with_ratios(df.groupBy(w.alias("time_window"), *keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(ip_len).alias("ip_avg_len"),
        F.max(ip_len).alias("max_ip_len"),
        F.avg(frame_len).alias("frame_avg_len"),
        F.max(frame_len).alias("max_frame_len")))


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def candidate_starts(time_col: str, length_us: int, slide_us: int, include_end: bool = True) -> Column:
    """Array of ``struct<start_us, main>``: starts of every window of this
    length/slide (aligned to the epoch, like ``window()``) that holds the
    time; ``main`` marks the window that starts at the time floored to the
    slide."""
    t = _micros(F.col(time_col))
    base = t - F.pmod(t, F.lit(slide_us))
    n = math.ceil(length_us / slide_us) + 1
    starts = F.transform(F.sequence(F.lit(0), F.lit(n)),
                         lambda i: F.struct((base - i.cast("bigint") * F.lit(slide_us)).alias("start_us"),
                                            (i == 0).alias("main")))

    def holds(s: Column) -> Column:
        end = s["start_us"] + F.lit(length_us)
        inside = (s["start_us"] <= t) & (t < end)
        return (inside | (t == end)) if include_end else inside

    return F.filter(starts, holds)


def join_back(packets: DataFrame, windows: DataFrame, time_col: str, length: str,
              slide: str | None = None, keys: list[tuple[str, str]] = (("frame_protocols", "frame_protocols"),),
              how: str = "inner", include_end: bool = True, method: str = "exploded") -> DataFrame:
    """Packets joined to the windows that contain them.

    ``keys`` pairs (packet column, window column).  ``include_end`` keeps the
    ``start <= t <= end`` condition of the original jobs (a packet exactly on
    an end also joins the window that did not count it).  ``how`` is
    ``inner`` or ``left`` (a packet in none of the given windows keeps one row
    of NULLs, also when windows were filtered).

    Output: all packet columns plus the window columns (window key columns
    dropped)."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    wcols = [c for c in windows.columns if c not in {w for _, w in keys} and c != "time_window"]
    w = windows.select(*[F.col(wk).alias(f"_wk{i}") for i, (_, wk) in enumerate(keys)],
                       *[F.col(c) for c in wcols])
    if method == "naive":
        cond = None
        for i, (pk, _) in enumerate(keys):
            c = packets[pk] == w[f"_wk{i}"]
            cond = c if cond is None else cond & c
        t = packets[time_col].cast("timestamp")
        upper = (t <= w["end"]) if include_end else (t < w["end"])
        cond = cond & (t >= w["start"]) & upper
        return packets.join(w, cond, how).drop(*[f"_wk{i}" for i in range(len(keys))])

    # Window tables are listed per pane (the common step of length and slide):
    # a packet meets the windows of its pane in one row, and is shuffled once.
    length_us = parse_duration_us(length)
    slide_us = parse_duration_us(slide) if slide else length_us
    pane_us = math.gcd(length_us, slide_us)
    start = _micros(F.col("start"))
    last = length_us // pane_us - (0 if include_end else 1)
    panes = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda i: F.struct(
        (start + i.cast("bigint") * F.lit(pane_us)).alias("at"), (i.cast("bigint") * F.lit(pane_us) == F.lit(length_us)).alias("edge")))
    nkeys = [f"_wk{i}" for i in range(len(keys))]
    per = (w.withColumn("_p", F.explode(panes))
           .groupBy(*nkeys, F.col("_p.at").alias("_pane"))
           .agg(F.collect_list(F.struct(F.col("_p.edge").alias("edge"), F.struct(*wcols).alias("w"))).alias("_ws")))
    t = _micros(F.col(time_col))
    p = packets.withColumns({"_t": t, "_at": t - F.pmod(t, F.lit(pane_us))})
    cond = p["_at"] == per["_pane"]
    for i, (pk, _) in enumerate(keys):
        cond = cond & (p[pk] == per[f"_wk{i}"])
    out = p.join(per, cond, how)
    # The pane after the last holds only packets exactly on the window's end.
    held = F.filter("_ws", lambda x: ~x["edge"] | (F.col("_t") == F.col("_at")))
    explode = F.explode if how == "inner" else F.explode_outer
    out = out.withColumn("_w", explode(held))
    return out.select(*[F.col(f"`{c}`") for c in packets.columns], *[F.col("_w.w")[c].alias(c) for c in wcols])
