import re
from collections import Counter

from flowlens.llm import quality
from tests.llm.cases import EDGE, docs, empty, prose

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for p in range(i, i + 3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_counts_match_brute_force(spark):
    rows = [*EDGE, (20, "a b c a b c a b c"), (21, "x y z x y z."), (22, "same line.\nsame line.\n \nsame line. "),
            (23, "w " * 500), (24, " lead and trail ")]
    got = quality.quality(docs(spark, rows)).collect()
    want = Counter((i, *brute(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == want


def test_line_rules_and_cleaning(spark):
    good = "\n".join(prose(i, 40) for i in range(3))
    rows = [(1, good), (2, good + "\nHome | About | News | Contact"), (3, good + "\nAccept our Cookie Policy now."),
            (4, "\n".join(" ".join(w + "###" for w in prose(i, 40).split()) for i in range(3))),
            (5, good + "\n" + "word " * 9), (6, good + "\nMenu")]
    df = docs(spark, rows).withColumn("n_chars", __import__("pyspark").sql.functions.length("text"))
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4, 5, 6)] == [True, True, True, False, True, True]
    assert (got[2].n_navigation, got[3].n_boilerplate, got[4].n_symbol_lines, got[5].n_punctuation,
            got[6].n_navigation) == (1, 1, 3, 1, 1)
    out = {r.doc_id: r for r in quality.clean(df).collect()}
    assert sorted(out) == [1, 2, 3, 5, 6]
    assert all(r.text == good and r.n_chars == len(good) and r.shard == "s" for r in out.values())


def test_empty_and_filter_above(spark):
    assert quality.quality(empty(spark)).count() == 0
    assert quality.clean(empty(spark)).count() == 0
    # A filter on the result must not be pushed into the per-word expressions.
    assert quality.quality(docs(spark, EDGE)).where("kept and n_repeat_words < 5").count() >= 3


def test_hash_ties_use_the_full_sort(spark, monkeypatch):
    """With places beyond the packed range every document takes the exact sort."""
    rows = [(1, "a b c d a b c e f a b c"), (2, prose(3, 60))]
    import inspect
    src = inspect.getsource(quality._repeat_words).replace("mask = (1 << 24) - 1", "mask = 3")
    scope = dict(vars(quality))
    exec(src, scope)
    monkeypatch.setattr(quality, "_repeat_words", scope["_repeat_words"])
    got = {r.doc_id: r.n_repeat_words for r in quality.quality(docs(spark, rows)).collect()}
    assert got == {i: brute(t)[4] for i, t in rows}


def test_end_marks_of_many_scripts(spark):
    """The same lines are kept whatever script's sentence end they have."""
    from flowlens.llm import quality
    from tests.llm.cases import docs
    marks = [".", "!", "\u2026", "\u0964", "\u061f", "\u06d4", "\u3002", "\uff1f", "\u0589", "\u1362", "\u104b", "\u17d4",
             "\u3002\u300d", "\u0964\u201d"]
    line = "w{0}a w{0}b w{0}c w{0}d w{0}e w{0}f w{0}g w{0}h w{0}i w{0}j w{0}k w{0}l w{0}m w{0}n"
    rows = [(i, "\n".join(line.format(f"{i}x{k}") + m for k in range(8))) for i, m in enumerate(marks)]
    rows.append((99, "\n".join(line.format(f"99x{k}") for k in range(8))))
    got = {r.doc_id: r.kept for r in quality.quality(docs(spark, rows)).collect()}
    assert [i for i, kept in got.items() if not kept] == [99]
