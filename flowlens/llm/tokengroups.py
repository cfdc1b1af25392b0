"""N-gram Jaccard join by a token-group matrix, and its components.

A document is the set of its distinct 4-word shingles (lower-cased A-Z, white-space
words; fewer than four words make one shingle).  Two link at a Jaccard index of
0.85 or more; the result names the components of all links, exactly.

1. Order of tokens: a fixed-size sketch (:data:`CELLS` counters) counts the
   documents of every shingle, rounded up by collisions; (count, hash) is a total
   order, the rare ones first.  A wrong count costs time, never a link.
2. Prefixes: in that order a linked pair shares :data:`MATCHES` tokens (or all that
   it needs, if fewer) among the first 15 % of the larger set and the first 8 %
   of the smaller one, three tokens more each, at places that leave enough
   tokens behind them.
3. Groups: equal sets become one; of its three min-hashes a set goes by the one
   that most sets have, and sets of one such hash are cut into groups of at most
   :data:`GROUP` sets and :data:`TOKENS` tokens (a longer set is its own group).  The matrix of tokens and groups is
   the table ``index``: for a token and group the range of sizes and the most
   tokens that follow it.
4. A set is a query against every group whose row of the matrix meets its prefix
   within those bounds.  The opened rows hold the query's group and the other:
   the query's overlap with the group's token union bounds its overlap with any
   member, and only where 0.85 of the query is in the union are members counted.
5. Two rounds keep groups of near copies from meeting all of each other: first
   rare tokens, and for a token with more than :data:`FEW` groups only a set's own
   group and one hub group.  After that, components are known, and in a round
   over all tokens a set is no query against members of its own component.
   Every pair within bounds is then either in one component or compared, so no
   link is lost.

A link between two opened groups is passed on only if it joins what the others
of that row have not joined yet, so a row of m sets gives less than m links.

Edge cases: null and blank texts have an empty set and are linked with nothing
(``component_id`` is their own id); null ids are allowed, ``component_id`` is the least
id that is not null; repeated ids and rows share their text's component; other
columns are not read; an empty table gives no rows.  Shingles are 64-bit hashes,
sets are told apart by their size and two 64-bit sums.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (WHITE_SPACE_WORDS, arrow_batches, chunks, content_key, mix, shingle_hashes, span_hashes, stored,
                     utf8, word_spans)
from .graph import components

SHINGLE, PERCENT = 4, 85
CELLS, SLICES, SALTS = 1 << 20, 16, 8
GROUP, TOKENS, FEW, MATCHES = 256, 1 << 16, 4, 4
BROADCAST_ROWS = 500_000  # some 40 bytes each
SHARD_BYTES = 8 << 20


# ----------------------------------------------------------------------- sets

def token_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, ascending, and their row offsets."""
    raw, off = utf8(pc.ascii_lower(column))
    starts, ends, word_off = word_spans(raw, off, WHITE_SPACE_WORDS)
    h, rows_off = shingle_hashes(span_hashes(raw, starts, ends), word_off, SHINGLE)
    row = np.repeat(np.arange(len(rows_off) - 1), np.diff(rows_off))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    sizes = np.bincount(row[first], minlength=len(rows_off) - 1)
    return h[first], np.concatenate([[0], np.cumsum(sizes)])


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(44)).astype(np.int64)


def _packed(total: np.ndarray) -> bytes:
    return zlib.compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes(), 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int64)
    for tab in chunks(batches, SHARD_BYTES):
        total += np.bincount(_cell(token_sets(tab["text"])[0]), minlength=CELLS)
    salt = TaskContext.get().partitionId() % SALTS
    width = CELLS // SLICES
    for s in range(SLICES):
        yield pa.RecordBatch.from_pydict({"slice": pa.array([s], pa.int32()), "salt": pa.array([salt], pa.int32()),
                                          "counts": pa.array([_packed(total[s * width:(s + 1) * width])], pa.binary())})


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for b in batches:
        for s, c in zip(b["slice"].to_pylist(), b["counts"].to_pylist()):
            part = np.frombuffer(zlib.decompress(c), "<u4").astype(np.int64)
            totals[s] = totals[s] + part if s in totals else part
    for s, t in totals.items():
        yield pa.RecordBatch.from_pydict({"slice": pa.array([s], pa.int32()), "salt": pa.array([0], pa.int32()),
                                          "counts": pa.array([_packed(t)], pa.binary())})


def sketch(docs: DataFrame) -> bytes:
    """Counters of all documents' shingles: 4 bytes a cell, whatever the corpus."""
    schema = "slice int, salt int, counts binary"
    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, schema)
    parts = parts.repartition("slice", "salt").mapInArrow(_add, schema)
    total = np.zeros(CELLS, "<u4")
    width = CELLS // SLICES
    for r in parts.repartition("slice").mapInArrow(_add, schema).collect():
        total[r["slice"] * width:(r["slice"] + 1) * width] = np.frombuffer(zlib.decompress(r["counts"]), "<u4")
    return total.tobytes()


def _sign(counters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.frombuffer(counters.value, "<u4")
        for tab in chunks(batches, SHARD_BYTES):
            h, off = token_sets(tab["text"])
            n = np.diff(off)
            row = np.repeat(np.arange(len(n)), n)
            some = np.flatnonzero(n)
            sums = np.zeros((5, len(n)), np.uint64)
            with np.errstate(over="ignore"):
                for i in range(2):
                    np.add.at(sums[i], row, mix(h, 31 + i))
                for i in range(2, 5):
                    sums[i, some] = np.minimum.reduceat(mix(h, 31 + i), off[some]) if len(some) else 0
            h = h[np.lexsort((count[_cell(h)], row))]  # stable: by hash within a count
            size = np.where(n > 0, np.minimum(n, n - -(-PERCENT * n // 100) + MATCHES), 0)
            place = np.arange(len(h)) - off[row]
            prefix = h[place < size[row]].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(size)])
            cols = [pa.array(x.view(np.int64)) for x in sums]
            for at in range(0, len(n), 1_000):
                to = min(at + 1_000, len(n))
                lists = pa.ListArray.from_arrays(pa.array((ends[at:to + 1] - ends[at]).astype(np.int32)),
                                                 pa.array(prefix[ends[at]:ends[to]]))
                yield pa.RecordBatch.from_arrays(
                    [*[tab[c].combine_chunks().slice(at, to - at) for c in ("doc_id", "u", "d")], pa.array(n[at:to]),
                     *[c.slice(at, to - at) for c in cols], lists],
                    ["doc_id", "u", "d", "n", "f1", "f2", "m1", "m2", "m3", "prefix"])
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", content_key().alias("u"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
                       F.col("text").cast("string").alias("text"))


def signed(docs: DataFrame) -> DataFrame:
    """One row per document: set size ``n``, the set's sums, min-hashes and prefix."""
    arrow_batches(docs.sparkSession)
    counters = docs.sparkSession.sparkContext.broadcast(sketch(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(_keyed(docs).mapInArrow(
        _sign(counters), f"doc_id {kind}, u binary, d string, n bigint, f1 bigint, f2 bigint, m1 bigint, m2 bigint, m3 bigint, "
        "prefix array<bigint>"), "sets")


# --------------------------------------------------------------------- groups

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers sets and groups of sorted rows."""
    base = TaskContext.get().partitionId() << 40
    row = group = members = tokens = 0
    last = None
    for b in batches:
        sid, gid = [], []
        for m, n in zip(b["m1"].to_pylist(), b["n"].to_pylist()):
            if m != last or members >= GROUP or tokens + n > TOKENS:
                last, members, tokens, group = m, 0, 0, group + 1
            members, tokens = members + 1, tokens + n
            sid.append(base + row)
            gid.append(base + group)
            row += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(sid, pa.int64()), pa.array(gid, pa.int64()), *[b[c] for c in ("n", "f1", "f2", "low", "u", "d")]],
            ["sid", "g", "n", "f1", "f2", "low", "u", "d"])


def grouped(signs: DataFrame) -> DataFrame:
    """One row per different set: ``sid``, its group ``g``, least id, and a document."""
    one = signs.where("n > 0").groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("u", "d")).alias("at"),
        *[F.min(c).alias(c) for c in ("m1", "m2", "m3")])
    flat = stored(one.select("n", "f1", "f2", "low", "at.u", "at.d", F.array("m1", "m2", "m3").alias("ms")), "different")
    each = flat.select("f1", "f2", "n", F.explode(F.array_distinct("ms")).alias("m1"))
    shared = stored(each.groupBy("m1").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "shared")
    named = each.join(shared, "m1").groupBy("f1", "f2", "n").agg(F.max(F.struct("c", "m1")).alias("top"))
    keyed = flat.join(named, ["f1", "f2", "n"], "left").withColumn("m1", F.coalesce("top.m1", F.get("ms", F.lit(0))))
    order = ["m1", "f1", "f2", "n"]
    dealt = keyed.drop("ms", "top").repartitionByRange(*order).sortWithinPartitions(*order)
    kind = signs.schema["doc_id"].dataType.simpleString()
    return stored(dealt.mapInArrow(_cut, f"sid bigint, g bigint, n bigint, f1 bigint, f2 bigint, low {kind}, u binary, d string"),
                  "groups")


def prefixes(signs: DataFrame, sets: DataFrame) -> DataFrame:
    """``tok, sid, pos, g, n`` of the prefix tokens that several sets have."""
    whole = stored(signs.select("f1", "f2", "n", "u", "d", "prefix")
                   .join(sets.select("f1", "f2", "n", "u", "d", "sid"), ["f1", "f2", "n", "u", "d"])
                   .select("sid", "prefix"), "whole")
    rows = whole.select("sid", F.posexplode("prefix").alias("pos", "tok"))
    several = stored(rows.groupBy("tok").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a <> b")
                     .select("tok"), "tokens")
    return stored(rows.join(several, "tok").join(sets.select("sid", "g", "n"), "sid"), "prefixes")


def _index(prefix: DataFrame) -> DataFrame:
    return prefix.where(f"pos < n - ({2 * PERCENT} * n + {99 + PERCENT}) div {100 + PERCENT} + {MATCHES}")


def _cells(index: DataFrame, *keys: str) -> DataFrame:
    return index.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.max(F.col("n") - F.col("pos")).alias("rest"), F.min("sid").alias("sa"), F.max("sid").alias("sb"))


def matrix(prefix: DataFrame) -> DataFrame:
    """The token-group matrix over the index prefixes, with each token's number
    of groups and hub group."""
    cells = stored(_cells(_index(prefix), "tok", "g"), "matrix")
    tokens = stored(cells.groupBy("tok").agg(F.count(F.lit(1)).alias("groups"),
                                             F.max(F.struct("members", "g")).alias("hub")).select("tok", "groups", "hub.g")
                    .withColumnRenamed("g", "hub"), "hubs")
    return stored(cells.join(tokens, "tok"), "matrix")


def _within() -> Column:
    """A query (q) can reach 0.85 with a member of the group (i) by this token."""
    return (F.col("q.tok") == F.col("i.tok")) & F.expr(
        f"(i.sa <> i.sb or i.sa <> q.sid) and q.n >= i.least and {PERCENT} * q.n <= 100 * i.most and "
        f"least(q.n - q.pos, i.rest) + {MATCHES - 1} >= "
        f"({PERCENT} * (q.n + greatest(i.least, ({PERCENT} * q.n + 99) div 100)) + {99 + PERCENT}) div {100 + PERCENT}")


_PAIR = ["q.sid as sid", "q.g as gq", "i.g as g", "q.n as n"]


def _asked(matches: DataFrame, *keys: str) -> DataFrame:
    """``sid, gq, g`` of the pairs with enough matching tokens."""
    enough = F.count(F.lit(1)) >= F.least(F.lit(MATCHES), F.expr(f"({PERCENT} * n + 99) div 100"))
    return (matches.groupBy("sid", "gq", "g", "n", *keys).agg(enough.alias("enough")).where("enough")
            .select("sid", "gq", "g").distinct())


def _opened(asked: DataFrame) -> DataFrame:
    """Queries of one group against another: ``gq, g, qs``."""
    return stored(asked.groupBy("gq", "g").agg(F.collect_set("sid").alias("qs")), "opened")


def first_round(prefix: DataFrame, cells: DataFrame) -> DataFrame:
    q = prefix.alias("q")
    rare = q.join(cells.where(f"groups <= {FEW} or g = hub").alias("i"), _within())
    own = q.join(cells.where(f"groups > {FEW} and g <> hub").alias("i"), _within() & (F.col("q.g") == F.col("i.g")))
    return _opened(_asked(rare.selectExpr(*_PAIR).unionByName(own.selectExpr(*_PAIR))))


def second_round(prefix: DataFrame, opened: DataFrame, roots: DataFrame) -> DataFrame:
    """All tokens: queries against the members of other components.  Rows of
    the matrix are parted by component; sets of none stay together."""
    rows = stored(prefix.join(roots.withColumnRenamed("v", "sid"), "sid", "left")
                  .withColumn("part", F.coalesce("root", F.lit(-1))), "parted")
    parts = stored(_cells(_index(rows), "tok", "g", "part"), "parts")
    matches = rows.alias("q").join(parts.alias("i"), _within() & F.expr("q.part <> i.part or i.part = -1"))
    asked = _asked(matches.selectExpr(*_PAIR, "i.part as part"), "part")
    return _opened(asked.join(opened.select("g", F.explode("qs").alias("sid")), ["sid", "g"], "left_anti"))


# -------------------------------------------------------------------- opening

def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tab in chunks(batches, SHARD_BYTES):
        h, off = token_sets(tab["text"])
        for at in range(0, tab.num_rows, 500):
            to = min(at + 500, tab.num_rows)
            lists = pa.ListArray.from_arrays(pa.array((off[at:to + 1] - off[at]).astype(np.int32)),
                                             pa.array(h[off[at]:off[to]].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*[tab[c].combine_chunks().slice(at, to - at) for c in ("sid", "g")], lists],
                                             ["sid", "g", "sh"])


def shingles_of(need: DataFrame, docs: DataFrame) -> DataFrame:
    """``sid, g, sh`` of the sets in ``need``, from one document each.  The list
    of needed sets is broadcast while it is small by count; beyond that the texts
    are shuffled."""
    few = need.count() <= BROADCAST_ROWS
    texts = _keyed(docs).join(F.broadcast(need) if few else need, ["u", "d"]).select("sid", "g", "text")
    return stored(texts.dropDuplicates(["sid"]).mapInArrow(_shingles, "sid bigint, g bigint, sh array<bigint>"), "shingles")


def needed(opened: DataFrame, sets: DataFrame) -> DataFrame:
    """Queries, and the whole groups they are asked of: ``sid``."""
    members = sets.join(opened.select("g").distinct(), "g").select("sid")
    return stored(opened.select(F.explode("qs").alias("sid")).union(members).distinct(), "needed")


def _flat(members) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """One cell of ``members``: ids and the (unsigned) token arrays."""
    sid = members.field("sid").to_numpy()
    lists = members.field("sh")
    off = np.asarray(lists.offsets)
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return sid, np.diff(off), values[off[0]:off[-1]], [values[a:b] for a, b in zip(off[:-1], off[1:])]


def group_links(asked: set, query, target) -> list[tuple[int, int]]:
    """Links of the asked sets of one group with members of another, a forest."""
    q_sid, q_n, _, q_sets = query
    t_sid, t_n, t_all, _ = target
    owner = np.repeat(np.arange(len(t_sid)), t_n)
    order = np.argsort(t_all, kind="stable")
    tokens, owner = t_all[order], owner[order]
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    out = []
    for s, n, toks in zip(q_sid.tolist(), q_n.tolist(), q_sets):
        if s not in asked:
            continue
        lo, hi = np.searchsorted(tokens, toks, "left"), np.searchsorted(tokens, toks, "right")
        inside = hi > lo
        if 100 * int(inside.sum()) < PERCENT * n:  # the bound by the group's token union
            continue
        lo, hi = lo[inside], hi[inside]
        times = hi - lo
        ends = np.cumsum(times)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - times), times)
        both = np.bincount(owner[at], minlength=len(t_sid))
        for k in np.flatnonzero(100 * both >= PERCENT * (n + t_n - both)).tolist():
            x = int(t_sid[k])
            if x != s and top(x) != top(s):
                up[top(x)] = top(s)
                out.append((s, x))
    return out


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for r in range(b.num_rows):
            asked = set(b["qs"][r].as_py())
            out += group_links(asked, _flat(b["query"][r].values), _flat(b["target"][r].values))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])


def links(opened: DataFrame, shingles: DataFrame) -> DataFrame:
    groups = stored(shingles.groupBy("g").agg(F.collect_list(F.struct("sid", "sh")).alias("members")), "members")
    both = (opened.join(groups.select(F.col("g").alias("gq"), F.col("members").alias("query")), "gq")
            .join(groups.select("g", F.col("members").alias("target")), "g"))
    return stored(both.select("qs", "query", "target").mapInArrow(_open, "a bigint, b bigint"), "links")


def merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after further links, which count between components only."""
    def named(df: DataFrame, col: str) -> DataFrame:
        of = roots.select(F.col("v").alias(col), F.col("root").alias("_root"))
        return df.join(of, col, "left").withColumn(col, F.coalesce("_root", col)).drop("_root")
    between = stored(named(named(edges, "a"), "b").where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "between")
    top = components(between)
    old = named(top.select(F.col("v"), F.col("v").alias("root")), "v").select("root")
    alone = old.join(roots.select(F.col("v").alias("root")), "root", "left_anti").select(F.col("root").alias("v"), "root")
    both = roots.unionByName(alone)
    of = top.select(F.col("v").alias("root"), F.col("root").alias("_top"))
    return stored(both.join(of, "root", "left").select("v", F.coalesce("_top", "root").alias("root")), "roots")


# --------------------------------------------------------------------- result

def report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    signs = signed(docs)
    sets = grouped(signs)
    prefix = prefixes(signs, sets)
    cells = matrix(prefix)
    opened = first_round(prefix, cells)
    places = sets.select("sid", "g", "u", "d")
    shingles = shingles_of(stored(needed(opened, sets).join(places, "sid"), "needed"), docs)
    roots = components(links(opened, shingles))
    more = second_round(prefix, opened, roots)
    if more.limit(1).count():
        need = needed(more, sets)
        rest = stored(need.join(shingles, "sid", "left_anti").join(places, "sid"), "needed")
        if rest.limit(1).count():
            shingles = shingles.unionByName(shingles_of(rest, docs))
        roots = merged(roots, links(more, shingles.join(need, "sid", "left_semi")))
    named = stored(sets.join(roots.withColumnRenamed("v", "sid"), "sid", "left")
                   .select("f1", "f2", "n", "low", F.coalesce("root", "sid").alias("root")), "named")
    least = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "least")
    ids = stored(named.join(least, "root").select("f1", "f2", "n", "component_id"), "ids")
    return (signs.select("doc_id", "n", "f1", "f2").join(ids, ["f1", "f2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
