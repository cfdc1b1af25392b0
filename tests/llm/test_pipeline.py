"""Each stage on its own input, and the whole run, against brute force."""

import corpus_pipeline as P
from flowlens.llm import common
from tests.llm.cases import EDGE, docs, edited, empty, prose
from tests.llm.test_near import bag
from tests.llm.test_secrets import fixed

BENCH = prose(3000, 40)
COLS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def case(spark, tmp_path):
    rows = [(i, t) for i, t in EDGE if i != 13]
    rows += [(100 + k, prose(1000 + k, 120)) for k in range(20)]
    rows += [(200, edited(prose(1001, 120), 50)), (201, prose(1002, 120)), (202, prose(1500, 60) + " " + BENCH + " " + prose(1501, 60)),
             (203, prose(1600, 80) + ' token = "abcdef0123456789" ' + prose(1601, 80)), (204, "junk### " * 100)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLS).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, BENCH)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return rows, str(tmp_path)


def test_stages(spark, tmp_path):
    rows, sf = case(spark, tmp_path)
    src = common.table(spark, sf, "documents")
    cols, at, seen = src.columns, src, {}
    for name, stage in P.STAGES:
        at = common.stored(stage(spark, at, sf), "stage")
        seen[name] = at.collect()
        if name != "packing":
            assert at.columns == cols
    kept = {r.doc_id for r in seen["quality rules"]}
    assert {100 + k for k in range(20)} | {200, 201, 202, 203, 7, 8, 9, 11, 12} <= kept and 204 not in kept and 5 not in kept
    one = [r.doc_id for r in seen["near duplicates"]]
    assert 200 not in one and 201 not in one and 8 not in one and 12 not in one
    bags = [bag(r.text) for r in seen["near duplicates"]]
    assert all(sum((a & b).values()) < 0.8 * sum((a | b).values()) for i, a in enumerate(bags) for b in bags[:i])
    clean = {r.doc_id: r for r in seen["decontamination"]}
    before = {r.doc_id: r for r in seen["near duplicates"]}
    assert all((clean[i].text == before[i].text) == (i != 202) for i in clean)
    assert BENCH not in clean[202].text and clean[202].n_chars == len(clean[202].text)
    safe = {r.doc_id: r for r in seen["secret scan"]}
    assert not any(fixed(r.text) for r in safe.values()) and "abcdef0123456789" not in safe[203].text
    assert len(seen["packing"]) == len(safe) and {r.doc_id for r in seen["packing"]} == set(safe)
    assert len(P.run(spark, sf).collect()) == len(safe)


def test_empty_documents(spark, tmp_path):
    empty(spark).selectExpr("doc_id", "text", "lang", "shard source", "cast(n_words as bigint) n_chars").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
