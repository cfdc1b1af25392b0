"""Helpers shared by the operators of this subpackage.

Contents: table reading, a content key for exact copies, a scalable
``row_number`` (:func:`positions`), Arrow batching by bytes, and a vectorised
word hasher over the raw UTF-8 buffers of an Arrow string column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def content_key(col: str | Column = "text") -> Column:
    """First 128 bits of the SHA-256 of the text, as two longs' worth of
    binary: equal texts, and only those, have equal keys."""
    return F.unhex(F.substring(F.sha2(text_or_empty(col).cast("binary"), 256), 1, 32))


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it
    back, so that a lost executor re-reads files.  Unlike ``checkpoint()`` the
    result forgets the plan's size estimates, which iterations would multiply
    without bound, and has the files' sizes instead."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._stored = path
    return kept


saved = stored


def discard(kept: DataFrame) -> None:
    """Delete what :func:`stored` wrote, once nothing reads it any more."""
    spark = kept.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept._stored)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Free the disk of shuffles whose results are stored.  Spark deletes the files
    of a shuffle when the driver's collector finds it unused, which a driver with
    room to spare may not do for a whole job; this asks for it now."""
    spark.sparkContext._jvm.System.gc()


SLICE_ROWS = 20_000


def positions(df: DataFrame, groups: list[str], order: list[str], out: str,
              rows: int | None = None) -> DataFrame:
    """``row_number() - 1`` within ``groups``, without a task per group.

    Rows are dealt to hash slices of about :data:`SLICE_ROWS` rows by the
    ``order`` columns; a slice's start is the sum of the counts of the slices
    before it (one small row per group and slice), and ranks are taken within
    (group, slice).  The order is by slice first, so it is a deterministic
    shuffle of the group, not the order of the columns.  A group holding a
    third of all rows spreads over as many tasks as it has slices.  Rows equal
    in all ``order`` columns share a slice and get consecutive places.
    """
    if rows is None:
        rows = df.count()
    n = max(1, -(-rows // SLICE_ROWS))
    sl = f"{out}__slice"
    start = f"{out}__start"
    keyed = df.withColumn(sl, F.pmod(F.xxhash64(F.lit(17), *order), F.lit(n)).cast("int"))
    counts = keyed.groupBy(*groups, sl).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy(sl).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
                           F.col(sl).alias("__sl"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(start))
    within = Window.partitionBy(*groups, sl).orderBy(*order)
    on = F.col(sl) == F.col("__sl")
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    ranked = keyed.withColumn("__rn", F.row_number().over(within))
    return (ranked.join(starts, on)
            .withColumn(out, F.col(start) + F.col("__rn") - 1)
            .drop(*[f"__g{i}" for i in range(len(groups))], "__sl", "__rn", start, sl))


# --------------------------------------------------------------- Arrow side

ARROW_ROWS = 256


def arrow_batches(spark: SparkSession) -> None:
    """Texts can be very long: send few rows in an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def chunks(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """Regroup a task's Arrow batches into tables of about ``max_bytes``."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        step = max(1, int(b.num_rows * max_bytes / max(b.nbytes, 1)))
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            held.append(part)
            size += part.nbytes
            if size >= max_bytes:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows (nulls
    are empty rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    col = column.cast(pa.large_string()).fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes every output bit."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_POW: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}
_BASE = 0x2545F4914F6CDD1D
_BASE_INV = pow(_BASE, -1, 2**64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["p"]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for key, base in (("p", _BASE), ("inv", _BASE_INV)):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                _POW[key] = np.cumprod(a, dtype=np.uint64)
    return _POW["p"], _POW["inv"]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WHITE_SPACE_WORDS = ~_SPACE


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word (maximal run of bytes of ``is_word``
    inside a row), and the n + 1 word offsets of the rows."""
    n = len(raw)
    inside = is_word[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begin[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


_HASH_BYTES = 1 << 20


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial over the bytes by
    prefix sums modulo 2**64, mixed with the length.  Spans are ascending and
    taken about 1 MB at a time, which bounds the prefix sums."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _HASH_BYTES, "right")))
            lo, hi = int(starts[at]), int(ends[stop - 1])
            p, inv = _powers(hi - lo + 1)
            prefix = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * p[:hi - lo], dtype=np.uint64, out=prefix[1:])
            b, e = starts[at:stop] - lo, ends[at:stop] - lo
            out[at:stop] = mix((prefix[e] - prefix[b]) * inv[b] ^ mix((e - b).astype(np.uint64), 7))
            at = stop
    return out


def shingle_hashes(words: np.ndarray, word_off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of every row, and their row offsets.  A
    row of fewer than k words, but not none, has one shingle of all its words."""
    counts = np.diff(word_off)
    sizes = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = np.arange(off[-1]) - np.repeat(off[:-1], sizes) + np.repeat(word_off[:-1], sizes)
    left = np.repeat(word_off[1:], sizes)
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            ok = at + j < left
            nxt = np.where(ok, words[np.minimum(at + j, len(words) - 1)], np.uint64(0)) if len(words) else h
            h = mix(h * np.uint64(0x100000001B3) + nxt, 11)
    return h, off
