"""Streams equal batch, restarts do not duplicate, late rows follow the watermark."""

import datetime as dt
import json

from pyspark.sql import functions as F

from flowlens.plans import catalog as C
from flowlens.session import scratch_path
from flowlens.sources import files
from flowlens.streaming import jobs, late


def test_stream_score_equals_batch(spark, sf_small):
    stream = C.q_stream_score(spark, sf_small).collect()
    batch = C.q_live_score(spark, sf_small).collect()
    assert len(stream) > 0
    assert sorted(map(tuple, stream)) == sorted(map(tuple, batch))


def _pkt(number, t, stack="eth:ethertype:ip:udp:dns", ip_len="50"):
    return json.dumps({
        "timestamp": str(int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)),
        "layers": {"frame": {"frame_frame_time": t.strftime("%Y-%m-%dT%H:%M:%S.%f") + "000Z",
                             "frame_frame_number": str(number), "frame_frame_len": "60",
                             "frame_frame_protocols": stack},
                   "ip": {"ip_ip_src": "10.0.0.1", "ip_ip_dst": "8.8.8.8", "ip_ip_proto": "17", "ip_ip_len": ip_len},
                   "udp": {"udp_udp_srcport": "5000", "udp_udp_dstport": "53"}}})


def _add_file(spark, folder, lines, name):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/{name}")


def test_restart_from_checkpoint_no_duplicates(spark):
    base = dt.datetime(2024, 1, 1)
    src, out, ckpt = (scratch_path(spark, n) for n in ("rs-in", "rs-out", "rs-ckpt"))
    ranges = spark.createDataFrame([], "ip_start bigint, ip_end bigint, city string, lon float, lat float")
    params, centers = [(0.0, 1.0)] * 7, [(0, [0.0] * 7)]

    def run():
        stream = files.stream_packets_ndjson(spark, f"{src}/*")
        q = jobs.start_scoring(stream, ranges, params, centers, out, ckpt, available_now=True)
        q.awaitTermination()
        return sorted(r.packet_id for r in jobs.read_batches(spark, out).collect())

    _add_file(spark, src, [_pkt(i, base + dt.timedelta(seconds=i)) for i in range(5)], "f1")
    assert run() == [0, 1, 2, 3, 4]
    assert run() == [0, 1, 2, 3, 4]            # nothing new: nothing written twice
    _add_file(spark, src, [_pkt(i, base + dt.timedelta(seconds=i)) for i in range(5, 8)], "f2")
    assert run() == list(range(8))


def test_late_rows_follow_watermark(spark):
    base = dt.datetime(2024, 1, 1)
    src, out, ckpt = (scratch_path(spark, n) for n in ("wm-in", "wm-out", "wm-ckpt"))

    def run():
        q = jobs.start_window_features(files.stream_packets_ndjson(spark, f"{src}/*"), out, ckpt,
                                       "1 minute", None, available_now=True)
        q.awaitTermination()
        return {r.start: r["count"] for r in jobs.read_batches(spark, out).collect()}

    # First run: minutes 0..9; the watermark ends at 8:50, so the windows
    # ending by then ([0:00, 1:00) .. [7:00, 8:00)) close.
    _add_file(spark, src, [_pkt(i, base + dt.timedelta(minutes=i)) for i in range(10)], "f1")
    first = run()
    assert len(first) == 8 and all(v == 1 for v in first.values())
    # Second run: a row 30 minutes behind the watermark is dropped; new rows count.
    _add_file(spark, src, [_pkt(100, base + dt.timedelta(minutes=3, seconds=5)),
                           _pkt(101, base + dt.timedelta(minutes=9, seconds=30)),
                           _pkt(102, base + dt.timedelta(minutes=20))], "f2")
    second = run()
    minute = lambda m: base + dt.timedelta(minutes=m)
    assert second[minute(3)] == 1                      # the late row did not change a closed window
    assert second[minute(9)] == 2                      # on-time row joined its open window
    assert minute(20) not in second                    # still open at the end of the run


def test_joinback_stream_matches_batch(spark, sf_small):
    s = C.q_stream_joinback(spark, sf_small)
    assert s.count() > 0
    # every streamed pair is a batch pair of a closed window
    b = C.q_window_joinback_inner(spark, sf_small)
    assert s.subtract(b.select("packet_id", "start", "n")).count() == 0


def test_joinback_state_is_evicted(spark, sf_small):
    src = C._stage_stream_input(spark, sf_small)
    out, ckpt = scratch_path(spark, "ev-out"), scratch_path(spark, "ev-ckpt")
    q = jobs.start_joinback(files.stream_packets_ndjson(spark, src), out, ckpt, "1 hour", "20 minutes",
                            available_now=True)
    q.awaitTermination()
    joins = [op for p in q.recentProgress for op in p.get("stateOperators", [])
             if op.get("operatorName") == "symmetricHashJoin"]
    assert joins and sum(op.get("numRowsRemoved", 0) for op in joins) > 0
    assert joins[-1]["numRowsTotal"] < max(op["numRowsTotal"] for op in joins)


def test_two_queries_from_one_source_and_console(spark, capsys):
    base = dt.datetime(2024, 1, 1)
    src = scratch_path(spark, "two-in")
    _add_file(spark, src, [_pkt(i, base + dt.timedelta(minutes=i)) for i in range(6)], "f1")
    outs = [scratch_path(spark, f"two-out{i}") for i in range(2)]
    q1 = jobs.start_window_features(files.stream_packets_ndjson(spark, f"{src}/*"), outs[0],
                                    scratch_path(spark, "two-c1"), "1 minute", None, available_now=True)
    q2 = jobs.start_window_features(files.stream_packets_ndjson(spark, f"{src}/*"), outs[1],
                                    scratch_path(spark, "two-c2"), "2 minutes", None, available_now=True)
    jobs.run_all([q1, q2], timeout=300)
    q1.awaitTermination()
    q2.awaitTermination()
    assert jobs.read_batches(spark, outs[0]).count() == 4   # watermark 4:50 closes [0:00,1:00)..[3:00,4:00)
    assert jobs.read_batches(spark, outs[1]).count() == 2
    from flowlens.sources import sinks
    sinks.console_batch_sink(3)(jobs.read_batches(spark, outs[0]), 7)
    assert "-- batch 7" in capsys.readouterr().out


def test_stream_quarantine_split_in_one_pass(spark):
    base = dt.datetime(2024, 1, 1)
    src, out, bad, ckpt = (scratch_path(spark, n) for n in ("qs-in", "qs-out", "qs-bad", "qs-ckpt"))
    empty_ip = json.loads(_pkt(50, base))
    empty_ip["layers"]["ip"] = {}
    _add_file(spark, src, [_pkt(i, base + dt.timedelta(seconds=i)) for i in range(4)]
              + [json.dumps(empty_ip), "not json"], "f1")
    ranges = spark.createDataFrame([], "ip_start bigint, ip_end bigint, city string, lon float, lat float")
    q = jobs.start_scoring(files.stream_packets_ndjson(spark, f"{src}/*"), ranges, [(0.0, 1.0)] * 7,
                           [(0, [0.0] * 7)], out, ckpt, quarantine_path=bad, available_now=True, spread=2,
                           local_ip="10.0.0.1")
    q.awaitTermination()
    assert sorted(r.packet_id for r in jobs.read_batches(spark, out).collect()) == [0, 1, 2, 3]
    reasons = sorted(r.reason for r in jobs.read_batches(spark, bad).collect())
    assert reasons == ["not_json", "null_ip_len"]
    raw = {r.reason: r.raw for r in jobs.read_batches(spark, bad).collect()}
    assert raw["not_json"] == "not json" and json.loads(raw["null_ip_len"])["frame"]["frame_frame_number"] == "50"
    # Without a path of its own the quarantine stands beside the output.
    out2, ckpt2 = scratch_path(spark, "qs-out2"), scratch_path(spark, "qs-ckpt2")
    jobs.start_scoring(files.stream_packets_ndjson(spark, f"{src}/*"), ranges, [(0.0, 1.0)] * 7, [(0, [0.0] * 7)],
                       out2, ckpt2, available_now=True).awaitTermination()
    assert [r.src_city for r in jobs.read_batches(spark, out2).collect()] == ["ERROR"] * 4
    assert [r.src_city for r in jobs.read_batches(spark, out).collect()] == ["LOCAL"] * 4  # the own address given
    assert jobs.read_batches(spark, jobs.quarantine_folder(out2)).count() == 2


def test_joinback_of_one_hot_stack(spark):
    """Nine packets in ten in one stack: pairs as in batch over several
    micro-batches, packets on window ends included, and the state spread."""
    base = dt.datetime(2024, 1, 1)
    src, out, ckpt = (scratch_path(spark, n) for n in ("hot-in", "hot-out", "hot-ckpt"))
    times = [base + dt.timedelta(milliseconds=250 * i) for i in range(240)]
    rows = [(i, t, "eth:ip:tcp" if i % 10 else "eth:ip:udp") for i, t in enumerate(times)]
    progress = []
    for part in range(3):
        _add_file(spark, src, [_pkt(i, t, s) for i, t, s in rows[part * 80:part * 80 + 80]], f"f{part}")
        q = jobs.start_joinback(files.stream_packets_ndjson(spark, f"{src}/*"), out, ckpt, "15 seconds", "5 seconds",
                                available_now=True)
        q.awaitTermination()
        progress += q.recentProgress
    got = sorted((r.packet_id, r.start, r.n) for r in jobs.read_batches(spark, out).collect())
    closed = times[-1] - dt.timedelta(seconds=10)
    want = []
    for k in range(-2, 12):
        start = base + dt.timedelta(seconds=5 * k)
        end = start + dt.timedelta(seconds=15)
        if end > closed:
            continue
        for stack in ("eth:ip:tcp", "eth:ip:udp"):
            n = sum(start <= t < end and s == stack for _, t, s in rows)
            want += [(i, start, n) for i, t, s in rows if s == stack and n and start <= t <= end]
    assert got == sorted(want)
    joins = [op for p in progress for op in p.get("stateOperators", []) if op.get("operatorName") == "symmetricHashJoin"]
    windows_held = 2 * 16 * 4 * jobs.SALTS  # stacks, windows, panes with the edge, salts
    assert joins and max(op["numRowsTotal"] for op in joins) <= len(rows) + windows_held  # no copies of packets


def test_joinback_salts_spread_a_pane(spark):
    """The keys of one pane of one stack fall into as many state keys as salts, evenly."""
    t = spark.range(8000).select(F.col("id").alias("packet_id"), F.lit(dt.datetime(2024, 1, 1)).alias("frame_time"))
    sizes = [r["count"] for r in t.groupBy(F.pmod(F.xxhash64("packet_id", "frame_time"), F.lit(jobs.SALTS))).count().collect()]
    assert len(sizes) == jobs.SALTS and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_late_rows_are_accounted_for(spark):
    base = dt.datetime(2024, 1, 1)
    src, out, ckpt = (scratch_path(spark, n) for n in ("la-in", "la-out", "la-ckpt"))

    def run():
        q = late.start_late_windows(files.stream_packets_ndjson(spark, f"{src}/*"), out, ckpt, "1 minute", available_now=True)
        q.awaitTermination()
        account = {r.batch: (r.rows, r.counted, r.late, r.untimed) for r in late.read_account(spark, out).collect()}
        windows = {r.start: r["count"] for r in late.read_windows(spark, out, "1 minute").collect()}
        return account, windows, sorted(r.packet_id for r in late.read_late(spark, out).collect())

    def minute(m):
        return base + dt.timedelta(minutes=m)

    # Minutes 0 to 9: the watermark is 8:50 afterwards.
    _add_file(spark, src, [_pkt(i, minute(i)) for i in range(10)], "f1")
    account, windows, gone = run()
    assert account == {0: (10, 10, 0, 0)} and windows == {minute(i): 1 for i in range(10)} and gone == []
    assert run()[0] == account                                   # nothing new
    untimed = _pkt(104, base).replace("2024-01-01T", "?")
    _add_file(spark, src, [_pkt(100, minute(3)), _pkt(101, minute(7) + dt.timedelta(seconds=59)),   # closed
                           _pkt(102, minute(8)), _pkt(103, minute(20)), untimed], "f2")             # open, new, no time
    account, windows, gone = run()
    assert account[1] == (5, 2, 2, 1) and gone == [100, 101]
    assert (windows[minute(3)], windows[minute(8)], windows[minute(20)]) == (1, 2, 1)
    _add_file(spark, src, [_pkt(105, minute(8)), _pkt(106, minute(19))], "f3")   # 8 closed, 19 open until 20:00
    account, windows, gone = run()
    assert account[2] == (2, 1, 1, 0) and gone == [100, 101, 105] and (windows[minute(8)], windows[minute(19)]) == (2, 1)
    assert sum(r[0] for r in account.values()) == sum(windows.values()) + len(gone) + 1
