import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from flowlens.llm import common, sharding
from tests.llm.cases import EDGE, docs, empty, prose


def check(rows, src, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in src)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    n = [len(by.get(s, [])) for s in range(shards)]
    assert max(n) - min(n) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r.law for r in rows} == {"rows"} and all(r.grown_shard is None for r in rows)


def cut(rows):
    groups = defaultdict(set)
    for r in rows:
        groups[(r.size, r.text_crc32)].add(r.shard)
    return sum(len(v) - 1 for v in groups.values())


def test_edge_rows_and_empty(spark):
    check(sharding.shard(docs(spark, EDGE)).collect(), EDGE, 40)
    assert sharding.shard(empty(spark)).count() == 0


def test_groups_come_together_and_large_ones_split(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE_ROWS", 60)
    src = [(i, prose(i, 12)) for i in range(300)] + [(1000 + i, prose(i // 3, 13)) for i in range(90)]
    src += [(2000 + i, "a third of all rows") for i in range(200)]
    rows = sharding.shard(docs(spark, src), shards=10, rounds=6).collect()
    check(rows, src, 10)
    start = sharding.shard(docs(spark, src), shards=10, rounds=0).collect()
    check(start, src, 10)
    assert cut(rows) < 0.35 * cut(start)
    hot = Counter(r.shard for r in rows if r.size == len("a third of all rows") + 16)
    assert sum(hot.values()) == 200 and sum(n for _, n in hot.most_common(4)) >= 190


def test_rounds_go_on_until_no_move_is_left(spark, monkeypatch):
    """Six rounds with moves, then as many without as a proposal has homes."""
    turns = []
    monkeypatch.setattr(sharding, "round_of",
                        lambda df, rows, shards, turn: turns.append(turn) or (df if turn < 6 else None, 3))
    src = [(i, prose(i // 3, 12)) for i in range(30)]
    check(sharding.shard(docs(spark, src), shards=10).collect(), src, 10)
    assert turns == list(range(9))


def test_positions_are_gapless_and_stable(spark, monkeypatch):
    monkeypatch.setattr(common, "SLICE_ROWS", 10)
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id"))
    a = common.positions(df, ["g"], ["id"], "p").collect()
    b = common.positions(df.repartition(7), ["g"], ["id"], "p").collect()
    assert sorted(a) == sorted(b)
    for g in range(3):
        assert sorted(r.p for r in a if r.g == g) == list(range(sum(r.g == g for r in a)))
