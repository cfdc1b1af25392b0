"""Token-id files: ORC with run-length encoded ids, row indexes and Bloom
filters on document ids.

Documents are dealt by ranges of ``doc_id`` (a hash of the text parts equal
ids), sorted within each range and written as one ORC file per range: columns
``part, row, doc_id, n_tokens, ids``.  ORC writes integers in its run-length
encoding, keeps min/max per :data:`ROW_INDEX` rows and stripe, and a Bloom
filter of ``doc_id`` per row group, so stripes are read in parallel and a
lookup by id skips the others.  ``part`` and ``row`` give every document its
place without another sort.

Encoding: the ids of a whole text, as ``Tokenizer.encode(text,
add_special_tokens=False)`` gives, then id :data:`END`.  White space separates
pre-tokens in this tokenizer, so a chunk's distinct words are encoded once and
their ids copied; words of ASCII and Latin-1 letters and ASCII marks are split
further at letter/mark borders, where the pre-tokenizer splits as well.  All
other words (apostrophes, special tokens, other scripts) go through the
tokenizer whole.  The tests hold this against encoding each text directly.

Edge cases: a null text is empty and has the end id only; null ``doc_id`` come
first; repeated ids are ordered by a hash of their text; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, chunks, scratch_path

END = 1
ROW_INDEX = 1_000
SHARD_BYTES = 8 << 20
CACHED = 150_000

# Words that may be parted at letter/mark borders, and the borders (RE2).
_SAFE = "^[!-&(-~À-ÖØ-öø-ÿ]+$"
_LETTER, _MARK = "[a-zß-öø-ÿ]", "[!-@\\[-`{-~]"
_LOWER = re.compile("[a-zß-öø-ÿ]+")
_LOADED: dict = {}


class Encoder:
    """The tokenizer with a bounded cache of letter runs and mark runs."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        parsed = json.loads(spec)
        self.full = Tokenizer.from_str(spec)
        parsed["normalizer"] = None  # letter runs come lowered and composed
        self.plain = Tokenizer.from_str(json.dumps(parsed))
        suffix = parsed["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(parsed["model"]["vocab"].values()) + 1, bool)
        self.ends[[i for t, i in parsed["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.cache: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def _whole(self, words: list[str]) -> None:
        for w, e in zip(words, self.full.encode_batch_fast(words, add_special_tokens=False)):
            self.cache[w] = tuple(e.ids)

    def _letters(self, runs: list[str]) -> None:
        """Lowered letter runs are one pre-token each: encoded together and
        parted at their word-end ids."""
        for at in range(0, len(runs), 20_000):
            part = runs[at:at + 20_000]
            ids = self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            cut = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cut) != len(part):
                self._whole(part)
                continue
            self.cache.update(zip(part, map(tuple, (ids[a:b] for a, b in zip([0, *cut], cut)))))

    def pieces(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, flat, and how many each has."""
        if len(self.cache) > CACHED:
            self.cache, self.older = {}, self.cache
        new, old = self.cache, self.older
        letters, others = [], []
        for x in runs:
            if x not in new:
                if x in old:
                    new[x] = old[x]
                else:
                    (letters if x.isalpha() else others).append(x)
        plain = [x for x in letters if x.isascii() or _LOWER.fullmatch(x)]
        if len(plain) < len(letters):
            others += [x for x in letters if not (x.isascii() or _LOWER.fullmatch(x))]
        self._letters(plain)
        self._whole(others)
        ids = [new[x] for x in runs]
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), size

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words without white space, flat, and offsets."""
        safe = pc.and_(pc.match_substring_regex(words, _SAFE), pc.invert(pc.match_substring(words, "<|")))
        mask = safe.to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(words.filter(safe))
        low = pc.replace_substring_regex(low, f"({_LETTER})({_MARK})", r"\1 \2")
        low = pc.replace_substring_regex(low, f"({_MARK})({_LETTER})", r"\1 \2")
        lists = pc.ascii_split_whitespace(low)
        coded = lists.values.dictionary_encode()
        odd = words.filter(pc.invert(safe)).to_pylist()
        flat, size = self.pieces(coded.dictionary.to_pylist() + odd)
        count = np.ones(len(words), np.int64)
        count[mask] = np.diff(np.asarray(lists.offsets))
        at = np.concatenate([[0], np.cumsum(count)])
        piece = np.empty(at[-1], np.int64)
        of_safe = np.repeat(mask, count)
        piece[of_safe] = coded.indices.to_numpy(zero_copy_only=False)
        piece[~of_safe] = len(coded.dictionary) + np.arange(len(odd))
        ids, ends = _gather(flat, size, piece)
        return ids, ends[at]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a column, each with the end id, and offsets."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
        row_off = np.asarray(split.offsets, np.int64)
        coded = split.values.slice(row_off[0], row_off[-1] - row_off[0]).dictionary_encode()
        row_off = row_off - row_off[0]
        flat, off = self.words(coded.dictionary)
        # The end id is one more word, put behind the last of each row.
        codes = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row_off[1:], len(off) - 1)
        size = np.append(np.diff(off), 1)
        ids, ends = _gather(np.append(flat, np.int32(END)), size, codes)
        return ids, ends[row_off + np.arange(len(row_off))]


def _gather(flat: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``codes`` one after the other, and their offsets."""
    start = np.cumsum(size, dtype=np.int64) - size
    n = size[codes]
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(n, out=ends[1:])
    src = np.repeat(start[codes] - ends[:-1], n)
    src += np.arange(ends[-1])
    return flat[src], ends


def encoder(spec: str) -> Encoder:
    """One per worker process."""
    key = zlib.crc32(spec.encode())
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(spec)
    return _LOADED[key]


def _encode(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        enc = encoder(spec.value)
        for tab in chunks(batches, SHARD_BYTES):
            ids, off = enc.column(tab["text"].combine_chunks())
            n = tab.num_rows
            for at in range(0, n, 2_000):
                to = min(at + 2_000, n)
                lists = pa.ListArray.from_arrays(pa.array((off[at:to + 1] - off[at]).astype(np.int32)),
                                                 pa.array(ids[off[at]:off[to]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(to - at, part, np.int32)), pa.array(np.arange(row + at, row + to)),
                     tab["doc_id"].combine_chunks().slice(at, to - at), pa.array(np.diff(off[at:to + 1])), lists],
                    ["part", "row", "doc_id", "n_tokens", "ids"])
            row += n
    return run


def write(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode ``docs`` with the tokenizer file and write the ORC files."""
    spark = docs.sparkSession
    arrow_batches(spark)
    with open(tokenizer) as f:
        spec = spark.sparkContext.broadcast(f.read())  # the file's size
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    dealt = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", tie)
    dealt = dealt.sortWithinPartitions("doc_id", tie)
    (dealt.mapInArrow(_encode(spec), f"part int, row bigint, doc_id {kind}, n_tokens bigint, ids array<int>")
     .write.option("compression", "zstd").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").option("orc.row.index.stride", str(ROW_INDEX)).orc(path))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b["ids"]
        off = np.asarray(lists.offsets)
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(values[a:e].tobytes()) for a, e in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [b["part"], b["row"], b["doc_id"], pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())],
            ["part", "row", "doc_id", "n_tokens", "ids_crc32"])


def read(spark, path: str) -> DataFrame:
    return spark.read.orc(path)


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write, read back, and give per document ``doc_id, start, n_tokens,
    ids_crc32``.  Starts: the totals of the files before (one row per file)
    plus a running sum within the file."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write(docs, path, tokenizer)
    files = read(spark, path)
    kind = files.schema["doc_id"].dataType.simpleString()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (files.groupBy("part").agg(F.sum("n_tokens").alias("__sum"))
            .select(F.col("part").alias("__part"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")))
    rows = files.mapInArrow(_crc, f"part int, row bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint")
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return (rows.join(base, F.col("part") == F.col("__part"))
            .select("doc_id", (F.col("__base") + F.col("__in")).alias("start"), "n_tokens", "ids_crc32"))
