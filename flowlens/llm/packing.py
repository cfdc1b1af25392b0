"""Packing by optimal length buckets.

The global histogram of document lengths decides :data:`BUCKETS` boundaries
by dynamic programming so that padding (boundary minus length, summed over all
documents) is least; inside each bucket documents form batches of at most
:data:`BUDGET` padded tokens.

A document's length is its number of white-space words plus one end token, or
any ``length`` expression given.  The histogram has a row for each different length
(two numbers; no more rows than the longest document has words, however many
documents), so the boundaries are optimal for all lengths.  Equal padding is
decided for the lower boundary.  A document longer than the budget is alone in
its batch.

Batches: documents of a bucket are shuffled deterministically and cut into
runs of ``budget // boundary``; places come from :func:`common.positions`, so
a bucket with a third of all rows is dealt over many tasks.

Edge cases: a null text has length 1; null ``doc_id`` and repeated rows are
packed like others; columns with the names of the result do not clash, as only
``doc_id`` and the length are read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import positions, saved

BUCKETS = 8
BUDGET = 16_384


def word_length(text: str = "text") -> Column:
    trimmed = F.btrim(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.size(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))
    return (F.when(trimmed == "", F.lit(0)).otherwise(words) + 1).cast("bigint")


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Boundaries (each a length, the last the longest) of at most ``buckets``
    buckets with the least padding.  Divide and conquer over the monotone
    split points: O(buckets * n * log n)."""
    x, c = np.array(lengths, np.int64), np.array(counts, np.int64)
    n = len(x)
    if n <= buckets:
        return x.tolist()
    rows = np.concatenate([[0], np.cumsum(c)]).astype(np.float64)
    best = x[:].astype(np.float64) * rows[1:]  # one bucket for the first i + 1 lengths: its padded size
    came = []
    for _ in range(buckets - 1):
        new, arg = np.empty(n), np.empty(n, np.int64)
        work = [(0, n - 1, -1, n - 2)]
        while work:
            lo, hi, a, b = work.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            js = np.arange(max(a, -1), min(b, mid - 1) + 1)  # last length of the buckets before
            cost = np.where(js < 0, 0.0, best[np.maximum(js, 0)]) + x[mid] * (rows[mid + 1] - rows[js + 1])
            k = int(np.argmin(cost))
            new[mid], arg[mid] = cost[k], js[k]
            work += [(lo, mid - 1, a, js[k]), (mid + 1, hi, js[k], b)]
        best = new
        came.append(arg)
    out, i = [], n - 1
    for arg in reversed(came):
        out.append(int(x[i]))
        i = int(arg[i])
        if i < 0:
            break
    if i >= 0:
        out.append(int(x[i]))
    return sorted(out)


def boundaries(lengths: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """From a column ``n_tokens``: the global histogram, then the boundaries."""
    hist = sorted(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    return best_boundaries([r["n_tokens"] for r in hist], [r["n"] for r in hist], buckets)


def pack(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, bucket, bucket_len, batch``
    (unique over all buckets), ``slot`` in the batch and ``padding``."""
    rows = saved(docs.select("doc_id", F.coalesce(length if length is not None else word_length(),
                                                  F.lit(1)).cast("bigint").alias("n_tokens")))
    tops = boundaries(rows, buckets)
    arr = F.array(*[F.lit(t).cast("bigint") for t in tops]) if tops else F.array().cast("array<bigint>")
    df = rows.withColumn("bucket", F.size(F.filter(arr, lambda t: t < F.col("n_tokens"))))
    df = df.withColumn("bucket_len", F.get(arr, F.col("bucket")))
    df = df.withColumn("__per", F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_len"))).cast("bigint"))
    df = positions(df, ["bucket"], ["doc_id", "n_tokens"], "__pos")
    df = df.withColumn("__in", F.floor(F.col("__pos") / F.col("__per")).cast("bigint"))
    return df.select("doc_id", "n_tokens", "bucket", "bucket_len",
                     (F.col("__in") * F.lit(max(1, len(tops))) + F.col("bucket")).alias("batch"),
                     (F.col("__pos") - F.col("__in") * F.col("__per")).alias("slot"),
                     (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
