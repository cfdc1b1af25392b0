"""Components of the n-gram join against all pairs."""

import random
import re

from flowlens.llm import tokengroups as X
from tests.llm.cases import EDGE, docs, edited, empty, prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 85 * len(a | b):
                up[top(i)] = top(j)
    out = []
    for i, (d, _) in enumerate(rows):
        own = [rows[k][0] for k in range(len(rows)) if top(k) == top(i) and rows[k][0] is not None]
        out.append((d, len(sets[i]), (min(own) if own else None) if sets[i] else d))
    return out


def check(spark, rows):
    got = [tuple(r) for r in X.report(docs(spark, rows).repartition(5)).collect()]
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_edges_and_chains(spark):
    rows = list(EDGE)
    base = prose(50, 200)
    chain = [base]
    for k in range(8):  # each near the one before it, not the first
        w = chain[-1].split(" ")
        w[k * 20 + 3] = f"new{k}"
        w[k * 20 + 13] = f"other{k}"
        chain.append(" ".join(w))
    rows += [(100 + k, t) for k, t in enumerate(chain)]
    rows += [(200, base.upper()), (201, base.replace(" ", "\n\t")), (202, prose(51, 200)), (203, "ONE"), (204, "One two")]
    check(spark, rows)


def variant(r, words, edits):
    w = list(words)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"v{r.randrange(30)}"
    return " ".join(w)


def test_group_of_near_copies(spark, monkeypatch):
    """Many sets around the threshold, in several groups, with common tokens."""
    monkeypatch.setattr(X, "GROUP", 8)
    monkeypatch.setattr(X, "FEW", 2)
    r = random.Random(5)
    words = prose(60, 120).split(" ")
    rows = [(k, variant(r, words, r.randrange(0, 7))) for k in range(150)]
    rows += [(1000 + k, prose(70 + k, 60) + " " + " ".join(words[:50])) for k in range(20)]
    rows += [(2000 + k, variant(r, words[:60], 1)) for k in range(20)]
    check(spark, rows)


def test_edited_texts(spark):
    rows = []
    for k in range(30):
        t = prose(500 + k, 20 + 10 * k)
        rows += [(k, t), (100 + k, edited(t, 25 + k)), (200 + k, t + " " + prose(900 + k, 3 + k))]
    check(spark, rows)


def test_empty_table(spark):
    assert X.report(empty(spark)).count() == 0
    check(spark, [(1, None), (2, " ")])
