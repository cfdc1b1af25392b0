"""Near-duplicate documents by BagMinHash over 5-word shingles.

A document is the multiset of its 5-word shingles (white-space words; a
document of one to four words has one shingle).  Similarity is the weighted
Jaccard index: the sum of the smaller counts over the sum of the larger.

Signature: every (shingle, weight level) emits a Poisson process of points in
time, each hitting one of :data:`REGISTERS` registers; a register keeps its
earliest point, so registers of two documents agree with a probability equal
to their weighted Jaccard index.  Weight levels are discretised into dyadic
nodes [0,1), [1,2), [2,4), [4,8) ...; the process of a node is shared by all
documents, and a node that the count covers in part passes on the points whose
level lies below the count.  Points are made in order of time and a process
stops at the latest register of its document, which spares most of them.

Banding: :data:`BANDS` bands of :data:`ROWS` registers; at similarity 0.8 a
pair shares a band with probability 0.9996, at 0.4 with 0.1 (documents that only
have a passage in common seldom meet).  In a bucket only links to a hub are
verified, exactly, on the shingle multisets; the hub is the member that shares
most buckets with others, so among copies of one text the most central.  Then
buckets are looked at again: where members are in different components and
were not compared, the next :data:`FIRST_HUBS` hubs follow, then that many times
as many, until every pair of a bucket is in one component or compared.  Pairs
of these later rounds are verified if their sizes and a second, longer signature
let them be: one bit of each of :data:`BITS` fresh registers, made only for the
members of such buckets.  At similarity s a bit differs with probability
(1 - s) / 2, so at 0.8 more than :data:`FAR` of them do with probability 0.0001;
pairs above that are not verified, which loses this share of the links that no
other path joins.  That turns away most pairs below 0.72.  A pair that meets in
several buckets leaves the join of a round once.  A bucket of near copies costs a few comparisons per member; in one of documents all unlike each other
the bits of every pair are compared inside the join, and few leave it.

Edge cases: texts without words are linked only to equal texts; null texts
are empty; documents are joined by content key, so repeated ids and rows fall
into one class; null ids are allowed (a class of null ids only has a null
``class_id``); further columns do not clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (WHITE_SPACE_WORDS, arrow_batches, chunks, content_key, mix, saved, shingle_hashes,
                     span_hashes, stored, utf8, word_spans)
from .graph import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 6
FIRST_HUBS = 16
REGISTERS = BANDS * ROWS
BITS, FAR = 1024, 140
SHARD_BYTES = 8 << 20


def shingles_of(column) -> tuple[np.ndarray, np.ndarray]:
    raw, off = utf8(column)
    starts, ends, word_off = word_spans(raw, off, WHITE_SPACE_WORDS)
    return shingle_hashes(span_hashes(raw, starts, ends), word_off, SHINGLE)


def bags(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle and count of every distinct shingle of every row."""
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else \
        np.zeros(0, np.int64)
    return row[first], h[first], np.diff(np.concatenate([first, [len(h)]]))


def signatures(row: np.ndarray, h: np.ndarray, count: np.ndarray, n: int, m: int = REGISTERS,
               salt: int = 3) -> np.ndarray:
    """Register times, one row of ``m`` per document (inf: no shingle)."""
    reg = np.full((n, m), np.inf)
    # Nodes: level 0 is [0, 1), level j is [2**(j-1), 2**j).
    levels = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    who = np.repeat(np.arange(len(h)), levels)
    level = np.arange(levels.sum()) - np.repeat(np.cumsum(levels) - levels, levels)
    width = np.where(level == 0, 1.0, 2.0 ** (level - 1))
    low = np.where(level == 0, 0.0, width)
    doc, weight = row[who], count[who].astype(float)
    seed = mix(h[who] ^ mix(level.astype(np.uint64), salt), 4)
    time = np.zeros(len(who))
    live = np.arange(len(who))
    step = 0
    last = np.full(n, np.inf)
    while len(live):
        step += 1
        one, two = mix(seed[live], 2 * step), mix(seed[live], 2 * step + 1)
        u = ((one >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53
        time[live] -= np.log(u) / (m * width[live])
        d = doc[live]
        on = time[live] < last[d]
        live, d, two = live[on], d[on], two[on]
        place = ((two >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
        y = (two & np.uint64(0xFFFFFFFF)).astype(float) / 2.0 ** 32
        ok = low[live] + y * width[live] < weight[live]
        np.minimum.at(reg, (d[ok], place[ok]), time[live[ok]])
        touched = np.unique(d[ok])
        last[touched] = reg[touched].max(axis=1)
        live = live[time[live] < last[d]]
    return reg


def band_keys(reg: np.ndarray) -> np.ndarray:
    """One key per band and document."""
    bits = np.ascontiguousarray(reg).view(np.uint64).reshape(len(reg), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64), 5), (len(reg), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key ^ bits[:, :, r], 6)
    return key.view(np.int64)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = np.arange(BITS, dtype=np.uint64)
    for t in batches:
        off = np.asarray(t["sh"].offsets).astype(np.int64)
        h = t["sh"].values.to_numpy(zero_copy_only=False)[off[0]:off[-1]].view(np.uint64)
        reg = signatures(*bags(h, off - off[0]), t.num_rows, BITS, salt=21)
        bit = (mix(reg.view(np.uint64) ^ place, 12) & np.uint64(1)).astype(np.uint8)
        words = np.packbits(bit, axis=1).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(t.num_rows + 1, dtype=np.int32) * (BITS // 64)),
                                         pa.array(words.reshape(-1)))
        yield pa.RecordBatch.from_arrays([t["u"], pa.array(np.diff(off)), lists], ["u", "n", "bits"])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tab in chunks(batches, SHARD_BYTES):
        h, off = shingles_of(tab["text"])
        n = tab.num_rows
        reg = signatures(*bags(h, off), n)
        keys = band_keys(reg)
        some = np.diff(off) > 0
        bands = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)),
            pa.array(keys[some].reshape(-1)))
        out = tab.drop_columns(["text"]).append_column("__bands", bands)
        yield from out.to_batches()


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, __u`` (content key), ``__d`` (id as text), ``__bands``."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    df = docs.select("doc_id", content_key().alias("__u"),
                     F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__d"),
                     F.col("text").cast("string").alias("text"))
    return df.mapInArrow(_sign, f"doc_id {kind}, __u binary, __d string, __bands array<bigint>")


def _multiset(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tab in chunks(batches, SHARD_BYTES):
        h, off = shingles_of(tab["text"])
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        h = h[np.lexsort((h, row))].view(np.int64)
        for at in range(0, tab.num_rows, 500):
            to = min(at + 500, tab.num_rows)
            lists = pa.ListArray.from_arrays(pa.array((off[at:to + 1] - off[at]).astype(np.int32)),
                                             pa.array(h[off[at]:off[to]]))
            yield pa.RecordBatch.from_arrays([tab["__u"].combine_chunks().slice(at, to - at), lists], ["u", "sh"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the multiset intersection of two arrays."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[i], cb[j]).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in batches:
        ok = []
        oa, ob = np.asarray(t["sa"].offsets), np.asarray(t["sb"].offsets)
        va, vb = t["sa"].values.to_numpy(zero_copy_only=False), t["sb"].values.to_numpy(zero_copy_only=False)
        for i in range(t.num_rows):
            a, b = va[oa[i]:oa[i + 1]], vb[ob[i]:ob[i + 1]]
            small, large = min(len(a), len(b)), max(len(a), len(b))
            both = overlap(a, b) if small >= SIMILARITY * large else 0
            ok.append(both > 0 and both >= SIMILARITY * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([t["a"], t["b"], pa.array(ok, pa.bool_())], ["a", "b", "ok"])


def multisets(need: DataFrame, docs: DataFrame, signs: DataFrame) -> DataFrame:
    """``u, sh``: the shingles of each text whose key is in ``need`` (``__u``),
    from one document each."""
    reps = signs.groupBy("__u").agg(F.min("__d").alias("__d")).join(need, "__u")
    src = docs.select(F.col("text").cast("string").alias("text"), content_key().alias("__u"),
                      F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__d"))
    texts = src.join(reps.select("__u", "__d"), ["__u", "__d"], "left_semi").dropDuplicates(["__u", "__d"])
    return stored(texts.mapInArrow(_multiset, "u binary, sh array<bigint>"), "shingles")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``a, b`` content keys) with ``ok``: similarity reached."""
    both = (pairs.join(sets.select(F.col("u").alias("a"), F.col("sh").alias("sa")), "a")
            .join(sets.select(F.col("u").alias("b"), F.col("sh").alias("sb")), "b"))
    return saved(both.select("a", "b", "sa", "sb").mapInArrow(_verify, "a binary, b binary, ok boolean"))


#: A pair leaves the join in one row: in the least bucket (by a 32-bit hash, which
#: keeps rows narrow; two of 26 are taken for one with a probability of 2e-7)
#: where one of them is a hub of the other; if both are, with the lesser as hub.
ONCE = "array_min(array_intersect(keys, hub_led)) = hash(key) and (hub < u or not arrays_overlap(hub_keys, led))"


def links(signs: DataFrame, docs: DataFrame) -> DataFrame:
    """``v, root``: components of the verified links between different texts."""
    members = signs.select("__u", F.explode("__bands").alias("key"))
    several = (members.groupBy("key").agg(F.min("__u").alias("lo"), F.max("__u").alias("hi"))
               .where("lo <> hi").select("key"))
    buckets = saved(members.join(several, "key").select("key", F.col("__u").alias("u")).distinct())
    size = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    degree = saved(buckets.join(size, "key").groupBy("u").agg(F.sum("c").alias("deg")))
    sets = multisets(degree.select(F.col("u").alias("__u")), docs, signs)
    buckets = buckets.join(degree, "u")
    hubs = buckets.groupBy("key").agg(F.max(F.struct("deg", "u")).alias("h")).select("key", F.col("h.u").alias("hub"))
    rows = saved(buckets.join(hubs, "key").where("u <> hub"))
    checked = verified(rows.select(F.least("u", "hub").alias("a"), F.greatest("u", "hub").alias("b")).distinct(), sets)
    roots = components(checked.where("ok").select("a", "b"))
    buckets, hubs_per_key, marks = rows.select("key", "u", "deg"), FIRST_HUBS, None
    differ = " + ".join(f"bit_count(bits[{i}] ^ hub_bits[{i}])" for i in range(BITS // 64))
    alike = (f"hub <> u and hub_root <> root and least(n, hub_n) >= {SIMILARITY} * greatest(n, hub_n) "
             f"and {differ} <= {FAR} and {ONCE}")
    while True:
        # Buckets that hold two components among the members that were no hub yet.
        at = buckets.join(roots.withColumnRenamed("v", "u"), "u", "left").withColumn("root", F.coalesce("root", "u"))
        split = at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        buckets = saved(at.join(split.select("key"), "key", "left_semi"))
        if not buckets.limit(1).count():
            return roots
        if marks is None:
            marks = saved(sets.join(buckets.select("u").distinct(), "u", "left_semi")
                          .mapInArrow(_bits, "u binary, n bigint, bits array<bigint>"))
        order = Window.partitionBy("key").orderBy(F.desc("deg"), "u")
        placed = saved(buckets.withColumn("place", F.row_number().over(order)))
        # Of each member: its signature, its buckets, and those it is a hub of.
        about = saved(placed.groupBy("u").agg(
            F.collect_list(F.hash("key")).alias("keys"),
            F.collect_list(F.when(F.col("place") <= hubs_per_key, F.hash("key"))).alias("led")).join(marks, "u"))
        rows = placed.join(about, "u")
        hubs = rows.where(F.col("place") <= hubs_per_key).select("key", F.col("u").alias("hub"), *[
            F.col(c).alias(f"hub_{c}") for c in ("root", "n", "bits", "keys", "led")])
        pairs = (rows.drop("place", "deg").join(hubs, "key")
                 .where(alike)
                 .select(F.least("hub", "u").alias("a"), F.greatest("hub", "u").alias("b")).distinct()
                 .join(checked.select("a", "b"), ["a", "b"], "left_anti"))
        fresh = verified(pairs, sets)
        checked = checked.unionByName(fresh)
        if fresh.where("ok").limit(1).count():
            roots = components(checked.where("ok").select("a", "b"))
        buckets = placed.where(F.col("place") > hubs_per_key).select("key", "u", "deg")
        hubs_per_key *= FIRST_HUBS


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, __u, __d, __root``: the content key that names the class."""
    signs = stored(signed(docs), "signatures")
    roots = links(signs, docs)
    return (signs.select("doc_id", "__u", "__d")
            .join(roots.select(F.col("v").alias("__u"), F.col("root").alias("__root")), "__u", "left")
            .withColumn("__root", F.coalesce("__root", "__u")))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id`` (least id of its class),
    ``class_size`` and ``duplicate`` (not the document that stays)."""
    rows = saved(classes(docs))
    per = rows.groupBy("__root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return (rows.join(per, "__root")
            .select("doc_id", "class_id", "class_size",
                    F.coalesce(F.col("doc_id") != F.col("class_id"), F.col("class_size") > 1).alias("duplicate")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each class: that of the least id (null ids last), of
    equal rows one."""
    rows = classes(docs)
    keep = rows.groupBy("__root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__u", "__d")).alias("k"))
    keep = keep.select(F.col("k.__u").alias("__u"), F.col("k.__d").alias("__d"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), content_key().alias("__u"),
                        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__d"))
    out = whole.join(keep, ["__u", "__d"], "left_semi").dropDuplicates(["__u", "__d"])
    return out.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
