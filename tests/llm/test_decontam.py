import hashlib
import random
import re

import numpy as np

from flowlens.llm import decontam
from flowlens.llm.fmindex import FMIndex, suffix_array
from tests.llm.cases import EDGE, docs, empty, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    win = [(str(i) if i is not None else "", w[k:k + min(10, len(w))]) for i, t in items for w in [words(t)] if w
           for k in range(len(w) - min(10, len(w)) + 1)]
    out = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for name, g in win:
            for k in range(len(w) - len(g) + 1):
                if w[k:k + len(g)] == g:
                    hit |= set(range(k, k + len(g)))
                    names.add(name)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                    bool(hit)))
    return sorted(out, key=str)


def test_suffix_array_and_index():
    r = np.random.default_rng(0)
    for n in (1, 2, 50, 400):
        text = r.integers(1, 5, n)
        full = [*text.tolist(), 0]
        assert suffix_array(np.array(full)).tolist() == sorted(range(n + 1), key=lambda i: full[i:])
        ix = FMIndex(text, 6)
        for m in (1, 2, 3):
            pats = r.integers(1, 6, (20, m))
            lo, hi = ix.search(pats)
            for p, a, b in zip(pats, lo, hi):
                want = [i for i in range(n - m + 1) if (text[i:i + m] == p).all()]
                assert sorted(ix.locate(np.arange(a, b)).tolist()) == want


def case():
    rnd = random.Random(4)
    small = prose(5, 4000, 3).split()
    items = [(1, " ".join(small[:30])), (2, "Short Item, here"), (3, None), (4, "..."), (5, " ".join(small[100:110])),
             (1, " ".join(small[:30])), (None, " ".join(small[200:215])), (7, " ".join(small[10:40]))]
    rows = list(EDGE)
    for k in range(30):
        a = rnd.randrange(0, 230)
        rows.append((100 + k, prose(k, 20) + " " + " ".join(small[a:a + rnd.randrange(5, 40)]).upper() + "! " + prose(k, 9)))
    rows += [(200, "x short-item;here y"), (201, " ".join(small[:300])), (202, " ".join(small[:300]))]
    return rows, items


def test_report_matches_brute_force(spark):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute([x for x in rows if x[0] not in (11, 12)], items)
    got = decontam.report(docs(spark, rows).where("doc_id is null or doc_id not in (11, 12)"), bench).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = docs(spark, rows)
    one = sorted(map(tuple, decontam.report(df, bench).collect()), key=str)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, decontam.report(df, bench).collect()), key=str) == one


def test_clean_cuts_the_spans(spark):
    items = [(1, "alpha beta gamma"), (2, "gamma delta epsilon")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r.text for r in decontam.clean(docs(spark, [
        (1, "Ünter Alpha, beta gamma delta. epsilon! end"), (2, "clean alpha beta"), (3, None)]), bench).collect()}
    assert got == {1: "Ünter ! end", 2: "clean alpha beta", 3: None}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.report(empty(spark), none).count() == 0
    assert decontam.report(docs(spark, EDGE), none).where("contaminated or n_items > 0").count() == 0
