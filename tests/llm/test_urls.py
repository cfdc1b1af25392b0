import datetime as dt

from flowlens.llm import urls

D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
ENTRY = "list string, kind string, pattern string, action string, at date"
ENTRIES = [("block", "host", "a.x.com", "add", D(10)), ("block", "host", "a.x.com", "remove", D(20)),
           ("block", "host", "a.x.com", "add", D(30)), ("block", "host", "a.x.com", "add", D(35)),
           ("block", "domain", "y.org", "add", D(0)), ("allow", "host", "ok.y.org", "add", D(5)),
           ("block", "path", "z.net/bad/", "add", D(0)), ("allow", "path", "z.net/bad/good/", "add", D(0)),
           ("block", "host", "same.com", "add", D(3)), ("block", "host", "same.com", "remove", D(3)),
           ("block", "host", "q.com", "remove", D(1)), (None, "host", "n.com", "add", D(0)),
           ("block", "host", None, "add", D(0)), ("block", "host", "tie.com", "add", D(0)),
           ("allow", "host", "tie.com", "add", D(0))]
CASES = [("http://a.x.com/p", 9, False), ("http://a.x.com/p", 10, True), ("http://A.X.com:80/p", 19, True),
         ("http://a.x.com/", 20, False), ("http://a.x.com", 40, True), ("https://u@sub.y.org./?q", 0, True),
         ("https://y.org", 1, True), ("https://ny.org", 1, False), ("http://ok.y.org/", 4, False if False else True),
         ("http://ok.y.org/", 5, False), ("http://z.net/bad/x", 3, True), ("http://z.net/bad/good/x", 3, False),
         ("http://z.net/badly", 3, False), ("http://same.com", 5, False), ("http://q.com", 5, False),
         ("http://n.com", 5, False), (None, 5, False), ("not a url", 5, False), ("http://tie.com", 5, False),
         ("http://a.x.com/p", None, False), ("", 5, False), ("http:///nohost", 5, False)]


def captures(spark, cases):
    rows = [(i, u, None if d is None else D(d), "clash", 1) for i, (u, d, _) in enumerate(cases)]
    return spark.createDataFrame(rows, "page_id bigint, url string, fetched date, pattern string, kind int")


def test_state_at_fetch_time(spark):
    e = spark.createDataFrame(ENTRIES, ENTRY)
    got = {r.page_id: r for r in urls.judge(captures(spark, CASES + CASES[:2]), e).collect()}
    assert [got[i].blocked for i in range(len(CASES))] == [b for _, _, b in CASES]
    assert got[11].entry == "z.net/bad/good/" and got[11].n_active == 2 and got[0].pattern == "clash"
    assert len(got) == len(CASES) + 2


def test_intervals(spark):
    got = urls.intervals(spark.createDataFrame(ENTRIES, ENTRY)).where("pattern = 'a.x.com'").collect()
    assert sorted((r.valid_from, r.valid_to) for r in got if r.valid_to) == [(D(10), D(20))]
    assert [r.valid_from for r in got if r.valid_to is None] == [D(30)]


def test_empty(spark):
    e = spark.createDataFrame([], ENTRY)
    assert urls.judge(captures(spark, CASES), e).where("blocked or n_active > 0").count() == 0
    assert urls.judge(captures(spark, CASES).limit(0), spark.createDataFrame(ENTRIES, ENTRY)).count() == 0
