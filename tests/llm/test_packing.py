import itertools
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from flowlens.llm import common, packing
from tests.llm.cases import EDGE, docs, empty


def cost(lengths, counts, tops):
    return sum(c * (min(t for t in tops if t >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    r = random.Random(2)
    for _ in range(60):
        n = r.randint(1, 9)
        lengths = sorted(r.sample(range(1, 60), n))
        counts = [r.randint(1, 9) for _ in lengths]
        for k in (1, 2, 3):
            got = packing.best_boundaries(lengths, counts, k)
            best = min(cost(lengths, counts, [*c, lengths[-1]])
                       for c in itertools.combinations(lengths, min(k, n) - 1))
            assert len(got) <= k and cost(lengths, counts, got) == best


def check(rows, budget):
    by = defaultdict(list)
    for r in rows:
        assert r.padding == r.bucket_len - r.n_tokens >= 0
        by[r.batch].append(r)
    for batch in by.values():
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
        assert len({r.bucket for r in batch}) == 1
        assert len(batch) == 1 or len(batch) * batch[0].bucket_len <= budget
    for b in {r.bucket for r in rows}:  # only the last batch of a bucket is not full
        sizes = Counter(r.batch for r in rows if r.bucket == b)
        per = max(1, budget // next(r.bucket_len for r in rows if r.bucket == b))
        assert sum(n < per for n in sizes.values()) <= 1


def test_edge_rows(spark):
    rows = packing.pack(docs(spark, EDGE)).collect()
    assert len(rows) == len(EDGE)
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter(
        (i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1) for i, t in EDGE)
    check(rows, packing.BUDGET)
    assert packing.pack(empty(spark)).count() == 0


def test_hot_bucket_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE_ROWS", 50)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("w " * 30).alias("text"))
    rows = packing.pack(df, buckets=3, budget=320).collect()
    assert len(rows) == 3000
    check(rows, 320)


def test_long_lengths_are_exact(spark):
    rows = [(k, " ".join(["w"] * 5000)) for k in range(3)]
    got = packing.pack(docs(spark, rows)).collect()
    assert {(r.n_tokens, r.bucket_len, r.padding) for r in got} == {(5001, 5001, 0)}
    r = random.Random(4)
    sizes = r.sample(range(1, 60_000), 9)
    many = spark.createDataFrame([(n,) for n in sizes for _ in range(r.randint(1, 4))], "n_tokens bigint")
    hist = Counter(x.n_tokens for x in many.collect())
    lengths = sorted(hist)
    best = min(cost(lengths, [hist[n] for n in lengths], [*c, lengths[-1]]) for c in itertools.combinations(lengths, 2))
    assert cost(lengths, [hist[n] for n in lengths], packing.boundaries(many, 3)) == best
