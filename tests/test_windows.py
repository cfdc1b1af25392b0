"""Window features and join-back: the exploded equi-join equals the naive
range join, including packets exactly on a window end, NULL keys and NULL
times (FIXTURES edge rows 18-19)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlens.operators import windows

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _packets(spark):
    rows = []
    secs = [0, 3, 5, 5, 9.5, 10, 14.999, 15, 15, 20, 29, 30, 44, 45, 59.9, 60, 61, 75, 90, 120, 121]
    for i, s in enumerate(secs):
        stack = ["a", "b", "c"][i % 3]
        src = None if i % 7 == 6 else f"10.0.0.{i % 2}"
        rows.append((i, T0 + dt.timedelta(seconds=s), src, stack, 40 + i, 60 + i))
    rows.append((100, None, "10.0.0.1", "a", 1, 2))                 # NULL time
    rows.append((101, T0 + dt.timedelta(seconds=33), "10.0.0.1", "a", None, 70))   # NULL ip_len
    rows.append((102, T0 + dt.timedelta(seconds=33), "10.0.0.9", "z", 0, 0))       # max length 0
    return spark.createDataFrame(
        rows, "packet_id long, frame_time timestamp, ip_src string, frame_protocols string, ip_len int, frame_len int")


def _canon(df):
    cols = ["packet_id", "start", "count", "ip_local_anomaly", "frame_local_anomaly"]
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("length,slide", [("15 seconds", "5 seconds"), ("30 seconds", None), ("60 seconds", "20 seconds")])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("include_end", [True, False])
def test_exploded_equals_naive(spark, length, slide, how, include_end):
    p = _packets(spark)
    keys = [("ip_src", "ip_src"), ("frame_protocols", "frame_protocols")]
    g = windows.window_features(p, "frame_time", length, slide, keys=["ip_src", "frame_protocols"])
    a = windows.join_back(p, g, "frame_time", length, slide, keys=keys, how=how,
                          include_end=include_end, method="exploded")
    b = windows.join_back(p, g, "frame_time", length, slide, keys=keys, how=how,
                          include_end=include_end, method="naive")
    assert _canon(a) == _canon(b)


def test_boundary_packet_joins_extra_window(spark):
    p = _packets(spark).filter(F.col("frame_protocols") == "a")
    g = windows.window_features(p, "frame_time", "15 seconds", "5 seconds", keys=["frame_protocols"])
    inc = windows.join_back(p, g, "frame_time", "15 seconds", "5 seconds", how="inner", include_end=True)
    exc = windows.join_back(p, g, "frame_time", "15 seconds", "5 seconds", how="inner", include_end=False)
    # packet 9 (t=20s) lies on the end of [5s, 20s), a window of its stack
    # (it holds the packets at 5s and 14.999s); packet 15 (t=60s) lies on the
    # end of [45s, 60s), which does not exist for its stack.
    count = lambda df, i: df.filter(f"packet_id = {i}").count()
    assert (count(exc, 9), count(inc, 9)) == (3, 4)
    assert (count(exc, 15), count(inc, 15)) == (3, 3)


def test_ratios_guarded(spark):
    p = _packets(spark)
    g = windows.window_features(p, "frame_time", "1 minute", keys=["frame_protocols"])
    z = g.filter("frame_protocols = 'z'").first()
    assert z.max_ip_len == 0 and z.ip_local_anomaly is None
    assert all(r.ip_local_anomaly is None or 0 < r.ip_local_anomaly <= 1 for r in g.collect())


def test_candidate_starts_cover_windows(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=45),), (T0 + dt.timedelta(seconds=46),)], "t timestamp")
    out = df.select("t", windows.candidate_starts("t", 15_000_000, 5_000_000, True).alias("c")).collect()
    on_edge = sorted(s.start_us for s in out[0].c)
    inside = sorted(s.start_us for s in out[1].c)
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert [(x - base) // 1_000_000 for x in on_edge] == [30, 35, 40, 45]
    assert [(x - base) // 1_000_000 for x in inside] == [35, 40, 45]


def test_left_join_back_with_filtered_windows(spark):
    """A packet on the end of the only window left has that row and no other."""
    t = spark.sql("select 1 id, 'a' frame_protocols, timestamp'2024-01-01 00:00:20' frame_time union all "
                  "select 2, 'a', timestamp'2024-01-01 00:01:05' union all select 3, 'a', null")
    w = spark.sql("select 'a' frame_protocols, timestamp'2024-01-01 00:00:10' start, timestamp'2024-01-01 00:00:20' end")
    for method in ("naive", "exploded"):
        out = windows.join_back(t, w, "frame_time", "10 seconds", how="left", method=method)
        rows = sorted((r.id, None if r.start is None else str(r.start.time())) for r in out.collect())
        assert rows == [(1, "00:00:10"), (2, None), (3, None)], method


@pytest.mark.parametrize("length,slide", [("15 seconds", "5 seconds"), ("60 seconds", "25 seconds"), ("10 seconds", "10 seconds")])
def test_panes_equal_listed_windows(spark, length, slide):
    p = _packets(spark)
    keys = ["ip_src", "frame_protocols"]
    w = p.groupBy(F.window("frame_time", length, slide).alias("w"), *keys).agg(
        F.count(F.lit(1)), F.avg("ip_len"), F.max("ip_len"), F.avg("frame_len"), F.max("frame_len"))
    want = sorted((tuple(r) for r in w.collect()), key=str)
    g = windows.window_features(p, "frame_time", length, slide, keys)
    cols = ["time_window", *keys, "count", "ip_avg_len", "max_ip_len", "frame_avg_len", "max_frame_len"]
    assert sorted((tuple(r) for r in g.select(cols).collect()), key=str) == want
    assert "Expand" not in g._jdf.queryExecution().executedPlan().toString()


def test_panes_of_no_packets(spark):
    assert windows.window_features(_packets(spark).limit(0), "frame_time", "15 seconds", "5 seconds").collect() == []
