"""Flattened ranges and the as-of lookup against testing every range."""

import random

import pytest

from flowlens.operators import intervals

COLS = "ip_start bigint, ip_end bigint, city string, lon float"


def cases(seed, n, line=400):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = r.randrange(line)
        b = min(line, a + r.choice([0, 1, 3, 10, 50, line]))
        rows.append((a, b, f"c{i % 7}", float(i % 5)))
    return rows + [rows[0], (5, 5, None, None), (None, 7, "x", 1.0), (9, 3, "y", 1.0)]


def winner(rows, v):
    hold = [(e - s, s, repr([c, x]), (c, x)) for s, e, c, x in rows if s is not None and e is not None and s <= v <= e]
    return min(hold)[3] if hold else None


@pytest.mark.parametrize("borders", [[], [40, 41, 90, 300]])
def test_flatten(spark, borders):
    rows = cases(3, 60)
    flat = intervals.flatten(spark.createDataFrame(rows, COLS), borders=borders).collect()
    pieces = sorted((r.ip_start, r.ip_end, (r.city, r.lon)) for r in flat)
    assert all(a[1] < b[0] for a, b in zip(pieces, pieces[1:]))
    for v in range(402):
        got = [p[2] for p in pieces if p[0] <= v <= p[1]]
        want = winner(rows, v)
        assert got == ([want] if want else [])


@pytest.mark.parametrize("rows_per_chunk", [10, 100_000])
def test_asof_lookup(spark, rows_per_chunk):
    rows = cases(8, 80)
    keys = [(i, v) for i, v in enumerate([*range(0, 402), 7, 7, None, -3])]
    df = spark.createDataFrame(keys, "id int, v bigint").repartition(4)
    got = intervals.asof_lookup(df, "v", spark.createDataFrame(rows, COLS), rows=rows_per_chunk).collect()
    assert sorted(r.id for r in got) == [i for i, _ in keys]
    for r in got:
        want = None if r.v is None else winner(rows, r.v)
        assert (r.city, r.lon) == (want or (None, None))


def test_empty(spark):
    none = spark.createDataFrame([], COLS)
    keys = spark.createDataFrame([(1, 5)], "id int, v bigint")
    assert [tuple(r) for r in intervals.asof_lookup(keys, "v", none).collect()] == [(1, 5, None, None)]
    assert intervals.asof_lookup(keys.limit(0), "v", spark.createDataFrame(cases(1, 5), COLS)).count() == 0
