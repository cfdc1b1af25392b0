import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowlens.llm import bagminhash as B
from flowlens.llm import graph
from tests.llm.cases import EDGE, docs, edited, empty, prose


def bag(t):
    w = (t or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows):
    """Class of each row: components over similarity 0.8 and equal texts."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [bag(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            a, b = bags[i], bags[j]
            both = sum((a & b).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or both and both >= 0.8 * sum((a | b).values()):
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    return sorted(sorted(map(str, v)) for v in out.values())


def grouped(rows):
    by = {}
    for r in rows:
        by.setdefault((r.class_id, r.class_size), []).append(str(r.doc_id))
    return by


def test_signatures_estimate_weighted_jaccard():
    rnd = random.Random(3)
    for _ in range(4):
        a = [rnd.randrange(60) for _ in range(400)]
        b = a[:300] + [rnd.randrange(60) for _ in range(100)]
        h = np.array([B.mix(np.array([x], np.uint64))[0] for x in a + b])
        reg = B.signatures(*B.bags(h, np.array([0, 400, 800])), 2, m=4000)
        ca, cb = Counter(a), Counter(b)
        want = sum((ca & cb).values()) / sum((ca | cb).values())
        assert np.isfinite(reg).all() and abs((reg[0] == reg[1]).mean() - want) < 4 * (want * (1 - want) / 4000) ** 0.5


def test_equal_and_empty_signatures():
    h, off = B.shingles_of(pa.array(["a b c d e f g", "a b c d e f g", "", "a b"]))
    reg = B.signatures(*B.bags(h, off), 4)
    assert (reg[0] == reg[1]).all() and np.isinf(reg[2]).all() and np.isfinite(reg[3]).all()


def case():
    rows = [(i, t) for i, t in EDGE if i is not None]
    base = prose(50, 200)
    rows += [(100 + k, edited(base, 40 + k)) for k in range(25)]  # a large group of near copies
    rows += [(200 + k, base + " " + prose(60 + k, 12 * k + 1)) for k in range(12)]  # 0.95 down to 0.6
    rows += [(300, prose(70, 150)), (301, prose(70, 150) + " tail."), (302, "word " * 40), (303, "word " * 45),
             (304, "word " * 80)]
    return rows


def test_classes_match_brute_force(spark):
    rows = case()
    got = B.report(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sorted(sorted(v) for v in grouped(got).values()) == brute(rows)
    for r in got:
        assert r.duplicate == (r.doc_id != r.class_id)


def test_later_rounds_find_what_the_first_hubs_do_not(spark):
    """Copies of a text that is not there: no copy is within 0.8 of all others."""
    base = prose(80, 220).split()
    rows = []
    for k in range(14):
        w = list(base)
        for j in (k, k + 1, k + 2):
            w[12 * j + 5] += "q"
        rows.append((k, " ".join(w)))
    rows += [(50 + k, edited(" ".join(base), 30 + 3 * k)) for k in range(8)]
    got = B.report(docs(spark, rows)).collect()
    assert sorted(sorted(v) for v in grouped(got).values()) == brute(rows)


def test_bits_estimate_similarity():
    rnd = random.Random(5)
    a = [rnd.randrange(1 << 40) for _ in range(900)]
    b = a[:800] + [rnd.randrange(1 << 40) for _ in range(100)]  # 800 of 1000: 0.8
    c = a[:600] + [rnd.randrange(1 << 40) for _ in range(300)]  # 600 of 1200: 0.5
    batch = pa.RecordBatch.from_pydict({"u": pa.array([b"x", b"a", b"b", b"c"], pa.binary()),
                                        "sh": pa.array([[1], a, b, c], pa.list_(pa.int64()))}).slice(1)
    out = next(B._bits(iter([batch])))
    x, y, z = (np.array(v, np.int64) for v in out["bits"].to_pylist())

    def differ(p, q):
        return sum(int(v).bit_count() for v in (p ^ q).view(np.uint64))

    assert out["n"].to_pylist() == [900, 900, 900] and len(x) == B.BITS // 64
    assert abs(differ(x, y) - 0.1 * B.BITS) < 40 and abs(differ(x, z) - 0.25 * B.BITS) < 60


def test_a_large_group_below_the_threshold(spark, monkeypatch):
    """300 members of a similarity of about 0.7, some pairs of them linked:
    classes are right, and of the 51,040 pairs only those that the bits leave are
    verified (at 0.70 some 152 of 1,024 bits differ, deviation 11: one in six)."""
    base, rows = prose(90, 260), []
    for k in range(300):
        rows.append((k, base + " " + " ".join(f"own{k}x{j}" for j in range(50 + k % 5))))
    rows += [(1000 + k, rows[7 * k][1] + f" tail{k}") for k in range(20)]
    seen, verified = [], B.verified

    def counting(pairs, sets):
        out = verified(pairs, sets)
        seen.append(out.count())
        return out

    monkeypatch.setattr(B, "verified", counting)
    got = B.report(docs(spark, rows)).collect()
    assert sorted(sorted(v) for v in grouped(got).values()) == brute(rows)
    assert sum(seen) < 51_040 // 5


def test_a_pair_of_several_buckets_leaves_the_join_once(spark, monkeypatch):
    """200 members of a similarity of about 0.74 meet in several buckets, as
    hubs of each other and of others: each pair is in one row of one round."""
    base, rows = prose(95, 300), []
    for k in range(200):
        rows.append((k, base + " " + " ".join(f"own{k}x{j}" for j in range(52 + k % 3))))
    rows += [(1000 + k, rows[9 * k][1] + f" tail{k}") for k in range(20)]
    joined = []
    where = type(docs(spark, rows[:1])).where

    def counting(df, condition):
        out = where(df, condition)
        if isinstance(condition, str) and "hub_root" in condition:
            seen = out.select(F.least("hub", "u").alias("a"), F.greatest("hub", "u").alias("b"))
            joined.append((seen.count(), seen.distinct().count()))
        return out

    monkeypatch.setattr(type(docs(spark, rows[:1])), "where", counting)
    got = B.report(docs(spark, rows)).collect()
    assert sorted(sorted(v) for v in grouped(got).values()) == brute(rows)
    assert joined and sum(n for n, _ in joined) > 200 and all(n == once for n, once in joined)


def test_deduplicate_keeps_one_of_each_class(spark):
    rows = [*EDGE, (40, edited(prose(9, 80), 60))]
    out = B.deduplicate(docs(spark, rows)).collect()
    texts = [r.text or "" for r in out]
    assert len(texts) == len(set(texts)) and sorted(r.doc_id for r in out if r.doc_id is not None) == [
        -5, 1, 3, 4, 5, 7, 9, 11, 13]
    assert sum(r.doc_id is None for r in out) == 2 and out[0].shard == "s"


def test_null_ids_and_empty(spark):
    got = B.report(docs(spark, [(None, "x y z"), (None, "x y z"), (3, "x y z"), (None, "only null")])).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in got) == [
        ("3", "3", 3), ("None", "3", 3), ("None", "3", 3), ("None", "None", 1)]
    assert B.report(empty(spark)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5)] + [(i, i + 1) for i in range(20, 60)]
    got = {r.v: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5} | {i: 20 for i in range(20, 61)}
