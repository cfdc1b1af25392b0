"""Benchmark decontamination by an FM-index per shard of documents.

A shard is what one task holds at a time (about :data:`SHARD_BYTES` of text;
a longer document is a shard of its own).  Its words are mapped to the
vocabulary of the benchmark; runs of known words long enough to hold a window
are indexed, equal runs once; all windows are searched backwards together,
located by sampled suffix positions, and their spans merged per document.

Words: A-Z lowered, then maximal runs of digits, a-z and non-ASCII
characters.  Windows: every :data:`WINDOW` consecutive words of an item; an
item with fewer words, but not none, is one window.  Words are compared by
64-bit hash and length.

The benchmark is taken in blocks of about :data:`BLOCK_BYTES`, so what a task
receives is bounded; each further block is another pass over the stored
result of the one before.

Edge cases: null texts have no words; an item without words has no window;
repeated ``item_id`` count once per document; a null ``item_id`` counts as an
item of its own with an empty name; repeated document rows are judged row by
row; further columns pass through untouched; empty tables give empty or clean
results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, chunks, span_hashes, stored, utf8, word_spans
from .fmindex import FMIndex

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def words_of(column) -> tuple:
    """Raw bytes, row offsets, word starts, ends, row word offsets, hashes."""
    raw, off = utf8(column)
    low = _LOWER[raw]
    starts, ends, word_off = word_spans(low, off, IS_WORD)
    return raw, off, starts, ends, word_off, span_hashes(low, starts, ends)


class Items:
    """Windows of a block of benchmark items, as vocabulary ids (from 2)."""

    def __init__(self, ids: list, texts: list):
        self.names = ["" if i is None else str(i) for i in ids]
        _, _, starts, ends, off, h = words_of(pa.array(texts, pa.string()))
        self.vocab, at, inv = np.unique(h, return_index=True, return_inverse=True)
        self.vocab_len = (ends - starts)[at]
        sym = inv.astype(np.int64) + 2
        found: dict[int, dict[bytes, set]] = {}
        for k, name in enumerate(self.names):
            w = sym[off[k]:off[k + 1]]
            n = min(WINDOW, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                found.setdefault(n, {}).setdefault(w[i:i + n].tobytes(), set()).add(name)
        self.windows = {n: (np.array([np.frombuffer(b, np.int64) for b in m]), [sorted(s) for s in m.values()])
                        for n, m in found.items()}
        self.shortest = min(found, default=0)

    def symbols(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Vocabulary ids of words, 1 for unknown ones."""
        if not len(self.vocab):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where((self.vocab[at] == hashes) & (self.vocab_len[at] == lengths), at + 2, 1)


def find(items: Items, sym: np.ndarray, word_off: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Occurrences in a shard: first word, end word, item names."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    known = sym > 1
    edge = np.zeros(len(sym) + 1, bool)
    edge[word_off] = True
    begin = known & (edge[:-1] | ~np.concatenate([[False], known[:-1]]))
    end = known & (edge[1:] | ~np.concatenate([known[1:], [False]]))
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = e - s >= max(items.shortest, 1)
    s, e = s[long], e[long]
    if not items.shortest or not len(s):
        return none
    copies: dict[bytes, list[int]] = {}
    for a, b in zip(s.tolist(), e.tolist()):
        copies.setdefault(sym[a:b].tobytes(), []).append(a)
    runs = [np.frombuffer(k, np.int64) for k in copies]
    places = list(copies.values())
    sizes = np.array([len(r) for r in runs])
    run_at = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.ones(run_at[-1], np.int64)
    text[np.arange(sizes.sum()) + np.repeat(np.arange(len(runs)), sizes)] = np.concatenate(runs)
    index = FMIndex(text, len(items.vocab) + 1)
    first, stop, names = [], [], []
    for n, (patterns, owners) in items.windows.items():
        lo, hi = index.search(patterns)
        count = hi - lo
        which = np.repeat(np.arange(len(patterns)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        at = index.locate(rows)
        run = np.searchsorted(run_at, at, "right") - 1
        for w, r, shift in zip(which.tolist(), run.tolist(), (at - run_at[run]).tolist()):
            for a in places[r]:
                first.append(a + shift)
                stop.append(a + shift + n)
                names.append(owners[w])
    return np.array(first, np.int64), np.array(stop, np.int64), names


def _pass(items: Items, want_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in chunks(batches, SHARD_BYTES):
            raw, off, starts, ends, word_off, h = words_of(tab["text"])
            first, stop, names = find(items, items.symbols(h, ends - starts), word_off)
            depth = np.zeros(len(starts) + 1, np.int64)
            np.add.at(depth, first, 1)
            np.add.at(depth, stop, -1)
            hit = np.cumsum(depth)[:-1] > 0
            rows: list[set] = [set() for _ in range(tab.num_rows)]
            for r, who in zip((np.searchsorted(word_off, first, "right") - 1).tolist(), names):
                rows[r].update(who)
            spans = _spans(hit, word_off)
            tab = _put(tab, "__n_words", pa.array(np.diff(word_off), pa.int64()))
            for name, new, kind in (("__spans", spans, pa.list_(pa.int64())),
                                    ("__items", [sorted(x) for x in rows], pa.list_(pa.string()))):
                old = tab[name].to_pylist()
                tab = _put(tab, name, pa.array([(o or []) + n for o, n in zip(old, new)], kind))
            if want_text:
                tab = _put(tab, "__text", _cut(tab["text"], tab["__spans"].to_pylist(), raw, off, starts, ends,
                                               word_off))
            yield from tab.to_batches()
    return run


def _put(tab: pa.Table, name: str, column) -> pa.Table:
    return tab.set_column(tab.schema.get_field_index(name), name, column)


def _spans(hit: np.ndarray, word_off: np.ndarray) -> list[list[int]]:
    """Per row: start and end words of its runs of hit words, flat."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[word_off] = True
    s = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]])))
    e = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]]))) + 1
    row = np.searchsorted(word_off, s, "right") - 1
    out: list[list[int]] = [[] for _ in range(len(word_off) - 1)]
    for r, a, b in zip(row.tolist(), (s - word_off[row]).tolist(), (e - word_off[row]).tolist()):
        out[r] += [a, b]
    return out


def merged(spans: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(texts, spans, raw, off, starts, ends, word_off):
    out = texts.to_pylist()
    for r, flat in enumerate(spans):
        if flat:
            keep, at = [], off[r]
            for a, b in merged(flat):
                keep.append(raw[at:starts[word_off[r] + a]].tobytes())
                at = ends[word_off[r] + b - 1]
            keep.append(raw[at:off[r + 1]].tobytes())
            out[r] = b"".join(keep).decode()
    return pa.array(out, pa.string())


def scan(docs: DataFrame, benchmark: DataFrame, want_text: bool = False) -> DataFrame:
    """``docs`` plus ``__n_words``, ``__spans`` (flat start/end words of the
    hits of each block), ``__items`` (names found) and, if wanted, ``__text``
    without the hits."""
    spark = docs.sparkSession
    arrow_batches(spark)
    bench = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    df = docs.withColumns({"__n_words": F.lit(0).cast("bigint"),
                           "__spans": F.array().cast("array<bigint>"),
                           "__items": F.array().cast("array<string>")})
    if want_text:
        df = df.withColumn("__text", F.lit(None).cast("string"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = bench.where(block == k).collect()
        if k:
            df = stored(df, "decontam")
        df = df.mapInArrow(_pass(Items([r[0] for r in rows], [r[1] for r in rows]),
                                 want_text and k == blocks - 1), schema)
    return df


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hits = [sum(e - s for s, e in merged(x)) for x in b["__spans"].to_pylist()]
        found = [sorted(set(x)) for x in b["__items"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], b["__n_words"], pa.array(hits, pa.int64()),
             pa.array([len(x) for x in found], pa.int64()),
             pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in found], pa.string()),
             pa.array([h > 0 for h in hits], pa.bool_())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: word, hit and item counts, the digest of the
    items found and ``contaminated``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return scan(docs.select("doc_id", "text"), benchmark).drop("text").mapInArrow(
        _summary, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
                  "contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the merged spans cut out of ``text`` (``n_chars`` counted
    anew where it is a column)."""
    df = scan(docs, benchmark, want_text=True).withColumn(
        "text", F.col("__text"))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.size("__items") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return df.select(*[f"`{c}`" for c in docs.columns])


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, n, list_slice(w, i, i + n - 1) AS g FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
occ AS (SELECT rid, i, dw.n AS n, item FROM (SELECT rid, n, i, list_slice(w, i, i + n - 1) AS g FROM dw) dw
    JOIN win ON win.n = dw.n AND win.g = dw.g),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM occ) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
