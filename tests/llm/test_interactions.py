"""Filter audit against all orders applied one by one."""

import re
from itertools import permutations

from flowlens.llm import interactions as X
from tests.llm.cases import EDGE, prose

COLS = "doc_id bigint, text string, source string, mask string, part string, n int"


def brute(rows, labels):
    """Applies every order to every document."""
    text = {k: t or "" for k, (_, t, _) in enumerate(rows)}
    fails = []
    for k, (i, t, s) in enumerate(rows):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = i is not None and any(j is not None and j < i and text[q] == t for q, (j, _, _) in enumerate(rows))
        fails.append({x for x, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t), copy)) if bad})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {s or "" for _, _, s in rows}:
        own = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = list(own)
            for step, f in enumerate(order, 1):
                gone = [k for k in alive if f in fails[k]]
                alive = [k for k in alive if f not in fails[k]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(alive), len(gone), sum(f in fails[k] for k in own) - len(gone), sum(fails[k] == {f} for k in own),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(total[f])
    return out


def test_every_order(spark):
    rows = [(i, t, ["a", None, "", "b"][k % 4]) for k, (i, t) in enumerate(EDGE)]
    rows += [(100 + k, ["LOUD WORDS " * 40, "a # b " + prose(5, 80), prose(6, 70).upper(), "x " * 60][k % 4], "ab"[k % 2])
             for k in range(24)]
    labels = [(i, k % 2, k % 3 == 0) for k, (i, _, _) in enumerate(rows)] + [(7, 1, 1), (7, 0, 0), (None, 1, 1), (999, 1, 1),
                                                                         (100, None, None)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    docs = spark.createDataFrame([(i, t, s, "m", "p", 3) for i, t, s in rows], COLS)
    tags = spark.createDataFrame([(*r, "e") for r in labels], "doc_id bigint, quality int, toxic int, mask string")
    got = X.audit(docs, tags).collect()
    want = brute(rows, labels)
    assert len(got) == len(want) == 120 * 5 * len({s or "" for _, _, s in rows})
    for r in got:
        assert [r[c] for c in X.COUNTS] == want[r.part, r.filter_order, r.step]


def test_paths_and_shares():
    forward, backward = X.paths(4)
    assert forward[0b1111] == backward[0] == 24 and forward[0b0101] == 2 and backward[0b0101] == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLS)
    tags = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert X.audit(docs, tags).count() == 0
    one = spark.createDataFrame([(1, "a b", "s", "", "", 0)], COLS)
    rows = X.audit(one, tags).collect()
    assert len(rows) == 600 and {r.good_lost for r in rows} == {0}
