"""Splits and exact quantiles that stay distributed.

* ``md5_split_column``: a reproducible train/test assignment from a hash of
  the row key, independent of partitioning and file layout (``randomSplit``
  depends on both).
* ``exact_percentile``: the linear-interpolation percentile without pulling
  a column into one task.  Each pass histograms the candidate range into at
  most ``buckets`` groups (partial aggregation per partition, so the shuffle
  carries ``buckets`` rows per partition), keeps the bucket holding the wanted
  rank, and stops when the candidates fit ``band_rows``; those are then sorted
  and indexed exactly.  A bucket made of one repeated value ends the search at
  once, so a hot value holding a third of the rows costs nothing extra.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def md5_split_column(key, weights: list[float], names: list[str], seed: int = 0,
                     resolution: int = 10000) -> Column:
    """Name of the split a row falls in, from md5(seed:key)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 8), 16, 10)
    bucket = h.cast("bigint") % F.lit(resolution)
    total = float(sum(weights))
    out = None
    acc = 0.0
    for w, n in zip(weights[:-1], names[:-1]):
        acc += w / total
        cond = bucket < F.lit(int(round(acc * resolution)))
        out = F.when(cond, F.lit(n)) if out is None else out.when(cond, F.lit(n))
    return F.lit(names[-1]) if out is None else out.otherwise(F.lit(names[-1]))


def md5_split(df: DataFrame, key: str, weights: list[float], seed: int = 0) -> list[DataFrame]:
    names = [str(i) for i in range(len(weights))]
    tagged = df.withColumn("_part", md5_split_column(key, weights, names, seed))
    return [tagged.filter(F.col("_part") == n).drop("_part") for n in names]


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's sampler (layout-dependent); kept for parity with existing jobs."""
    return df.randomSplit(weights, seed)


def _values_at_ranks(x: DataFrame, ranks: list[int], lo: float, hi: float, below: int,
                     buckets: int, band_rows: int) -> dict[int, float]:
    """Values at 0-based ``ranks`` (adjacent ranks share every pass), given
    they lie in [lo, hi] and ``below`` rows are < lo."""
    out: dict[int, float] = {}
    todo = sorted(set(ranks))
    while todo:
        if lo == hi:
            out.update({r: lo for r in todo})
            return out
        band = x.filter(F.col("x").between(F.lit(lo), F.lit(hi)))
        cnt = band.count()
        if cnt <= band_rows:
            vals = [r["x"] for r in band.orderBy("x").collect()]
            out.update({r: vals[r - below] for r in todo})
            return out
        width = hi / buckets - lo / buckets
        b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1)).cast("int")
        hist = band.groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n"),
                                             F.min("x").alias("mn"), F.max("x").alias("mx"))
        rows = sorted(hist.collect(), key=lambda r: r["b"])
        # Bucket of the first pending rank; ranks falling in other buckets are
        # resolved by their own narrowing below.
        seen = below
        target = None
        for r in rows:
            if todo[0] - seen < r["n"]:
                target = (r, seen)
                break
            seen += r["n"]
        if target is None:  # pragma: no cover - rank beyond the data
            raise ValueError("rank out of range")
        r, seen = target
        inside = [k for k in todo if k - seen < r["n"]]
        rest = [k for k in todo if k not in inside]
        if rest:
            out.update(_values_at_ranks(x, rest, lo, hi, below, buckets, band_rows))
        todo, lo, hi, below = inside, r["mn"], r["mx"], seen
    return out


def exact_percentile(df: DataFrame, col: str, p: float, buckets: int = 1024,
                     band_rows: int = 1024) -> float | None:
    """Exact percentile with linear interpolation between closest ranks (the
    definition of SQL ``percentile``/``quantile_cont``).  NULL and NaN are
    ignored; infinities rank first and last.

    The value column is persisted for the duration of the search (a few
    passes over one DOUBLE column)."""
    x = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        inf = float("inf")
        finite = F.abs("x") < F.lit(inf)
        st = x.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == F.lit(-inf)).alias("low"),
                   F.count_if(finite).alias("mid"), F.min(F.when(finite, F.col("x"))).alias("mn"),
                   F.max(F.when(finite, F.col("x"))).alias("mx")).first()
        n, low, mid = st["n"], st["low"], st["mid"]
        if not n:
            return None
        pos = p * (n - 1)
        ends = {math.floor(pos), math.ceil(pos)}
        vals = {r: -inf if r < low else inf for r in ends if not low <= r < low + mid}
        inner = [r for r in ends if r not in vals]
        if inner:
            vals |= _values_at_ranks(x.filter(finite), inner, st["mn"], st["mx"], low, buckets, band_rows)
        lo, hi = vals[min(ends)], vals[max(ends)]
        return lo if lo == hi else lo + (pos - min(ends)) * (hi - lo)
    finally:
        x.unpersist()
