import html as stdlib_html
import re

import numpy as np
import pyarrow.parquet as pq

from flowlens.llm import html as H

SCHEMA = "page_id bigint, url string, html string, text string, n_chars string"
PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_blocks():
    page = ("<!doctype html><html><head><title>T</title><style>p{}</style></head><body><!-- <p>no --><script>'</p>'"
            "</script><nav class='menu'><a href=x>Home</a></nav><article id=main><h1>A &amp;&nbsp;B</h1>"
            "<p>one<b>two</b>\n three<br>four<p>five &lt;x&gt;</article><p>un<closed")
    got = [(p, t) for p, t, _ in H.blocks_of(page)]
    assert [t for _, t in got] == ["Home", "A & B", "onetwo three", "four", "five <x>", "un"]
    assert got[0][0] == ("html", "body", "nav", ".menu", "a") and got[1][0][-1] == "h1"
    assert "article" not in got[-1][0]
    assert H.blocks_of("") == [] and H.blocks_of("plain & text")[0][1] == "plain & text"


def test_embedded_elements_are_read_and_lose_nothing():
    def cut(page):
        return [(p[-1], t) for p, t, _ in H.blocks_of(page)]

    for open_tag in ("object", "select", "svg", "noscript", "template", "math", "iframe"):
        assert cut(f"<div><{open_tag} id=a>x</div><article><p>one<p>two</article>")[-2:] == [("p", "one"), ("p", "two")]
        assert [t for _, t in cut(f"<{open_tag}><article><p>one<p>two</article>")] == ["one", "two"]
    assert cut("<p>a <svg><g><svg><text>b</text></svg><text>c</text></svg> d</p><p>e") == [("p", "a bc d"), ("p", "e")]
    assert cut("<p>so <math><mi>x</mi></math> is</p><object><p>film</p></object>") == [("p", "so x is"), ("p", "film")]
    assert cut("<p>pick <select><option>1<option>2</select> now</p>") == [
        ("p", "pick"), ("option", "1"), ("option", "2"), ("p", "now")]


def test_all_words_of_a_block_count():
    start = " ".join(f"w{k}" for k in range(40))
    ids, _ = H.features([(("p",), start, 0), (("p",), start + " and quite another ending", 0)])
    assert set(ids[0]) < set(ids[1])


def test_gradients_by_differences():
    pages, labels = H.training_set(["some words here.", "other text"], 3, seed=5)
    model = H.Labeller(2)
    feats = [H.features(b) for b in pages]

    def loss(m):
        s = m.scores(feats)
        return sum(float(np.sum(np.logaddexp(0, a) - a * y)) for a, y in zip(s, labels))

    before = loss(model)
    model.train(feats, labels, epochs=25)
    assert loss(model) < 0.3 * before


def reference_text(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    body = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:h1|p|br|div|ul|li)[^>]*>", " ", body))
    return re.sub(r"\s+", " ", stdlib_html.unescape(body)).strip()


def test_held_out_pages_and_templates(spark):
    rows = pq.read_table(PAGES).to_pylist()
    got = {r.page_id: r for r in H.extract(spark.read.parquet(PAGES)).collect()}
    wrong = [r["page_id"] for r in rows if got[r["page_id"]].text != reference_text(r["html"])]
    assert len(got) == len(rows) and len(wrong) <= len(rows) // 100
    assert all(r.n_chars == len(r.text) for r in got.values())
    model = H.trained([r["html"] for r in rows[:60]])
    pages, labels = H.training_set([t for r in rows[200:] for _, t, _ in H.blocks_of(r["html"])], 150, seed=77)
    scores = model.scores([H.features(b) for b in pages])
    right = np.concatenate(scores) > 0
    assert (right == np.concatenate(labels)).mean() > 0.98


def test_unclosed_elements_before_the_article(spark):
    rows = pq.read_table(PAGES).to_pylist()[:60]
    model = H.trained([r["html"] for r in rows])
    for tag in ("object", "select", "svg"):
        pages = [H.blocks_of(r["html"].replace("<article>", f"<{tag}><article>", 1)) for r in rows]
        scores = model.scores([H.features(b) for b in pages])
        got = [" ".join(t for (_, t, _), x in zip(b, s.tolist()) if x > 0) for b, s in zip(pages, scores)]
        assert sum(g == reference_text(r["html"]) for g, r in zip(got, rows)) >= 57, tag


def test_edge_rows(spark):
    page = pq.read_table(PAGES).to_pylist()[3]["html"]
    rows = [(1, None, None), (2, "u", ""), (None, "v", page), (4, None, page), (4, None, page), (5, "w", "<script>x")]
    df = spark.createDataFrame([(*r, "old", "old") for r in rows], SCHEMA)
    got = H.extract(df).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == sorted(
        (str(i), reference_text(h) if h == page else "") for i, _, h in rows)
    assert H.extract(df.limit(0)).count() == 0
