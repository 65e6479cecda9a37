"""Structured Streaming jobs driven by files written in the test."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from quarry.operators import words as W
from quarry.sources.streams import text_file_stream
from quarry.streaming import logs as SL
from quarry.streaming.runner import read_batches, read_latest, run_to_files, run_to_table
from tests.conftest import rows


def _feed(tmp_path, name, files):
    d = tmp_path / name
    d.mkdir()
    for i, content in enumerate(files):
        p = d / f"f{i}.txt"
        p.write_text(content)
        t = time.time() - 100 + i  # strictly increasing modification times
        os.utime(p, (t, t))
    return str(d)


def test_word_count_is_per_batch(spark, tmp_path):
    feed = _feed(tmp_path, "words", ["a b a\n", "a c\n"])
    stream = text_file_stream(spark, feed, max_files_per_trigger=1)
    out = run_to_table(W.tokens(stream, "value"), "t-words", "append", per_batch=W.word_count)
    got = rows(read_batches(spark, out).select("batch", "word", "count"))
    # the second batch does not carry the first batch's counts
    assert got == [(0, "a", 2), (0, "b", 1), (1, "a", 1), (1, "c", 1)]


def test_hashtag_stream(spark, tmp_path):
    feed = _feed(tmp_path, "posts", ["user 1 did #view\n", "#a #b c\n"])
    stream = text_file_stream(spark, feed, max_files_per_trigger=1)
    out = run_to_files(W.hashtags(W.tokens(stream, "value")), "t-tags")
    assert rows(out) == [("#a",), ("#b",), ("#view",)]


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    feed = _feed(tmp_path, "bytes", ["a b c d e f\n"] * 6)
    stream = text_file_stream(spark, feed, max_bytes=24)  # two files
    out = run_to_table(W.tokens(stream, "value"), "t-bytes", "append", per_batch=W.word_count)
    got = read_batches(spark, out)
    assert got.agg(F.countDistinct("batch")).first()[0] == 3
    assert got.agg(F.sum("count")).first()[0] == 36


def test_a_failing_stream_is_raised(spark, tmp_path):
    feed = _feed(tmp_path, "fails", ["x\n"])
    bad = text_file_stream(spark, feed).select(F.raise_error(F.col("value")).alias("v"))
    with pytest.raises(Exception, match="x"):
        run_to_files(bad, "t-fails")


def test_latest_keeps_the_newest_version(spark, tmp_path):
    base = str(tmp_path / "latest")
    schema = "k string, n bigint, m string"
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], schema).write.parquet(f"{base}/batch=0")
    spark.createDataFrame([("a", 2, None)], schema).write.parquet(f"{base}/batch=10")
    spark.createDataFrame([("a", 7, "y"), ("c", 3, "z")], schema).write.parquet(f"{base}/batch=9")
    assert rows(read_latest(spark, base, ["k"])) == [("a", 2, None), ("b", 1, "x"), ("c", 3, "z")]


def _log(ts: str, ip: str, endpoint: str, size: int) -> str:
    return f'{ip} - - [{ts} +0000] "GET {endpoint} HTTP/1.1" 200 {size}\n'


def test_event_time_windows_with_watermark(spark, tmp_path):
    f0 = _log("01/Jan/2024:00:00:05", "1.1.1.1", "/a", 10) + _log("01/Jan/2024:00:00:15", "1.1.1.1", "/b", 20)
    f1 = _log("01/Jan/2024:00:00:25", "2.2.2.2", "/a", 30) + "not a log line\n"
    feed = _feed(tmp_path, "logs", [f0, f1])
    logs = SL.timed_logs(text_file_stream(spark, feed, 1), event_time=True, watermark="1 minute")
    out = run_to_table(SL.window_stats(logs, "20 seconds", "10 seconds"), "t-win", "update")
    got = rows(read_latest(spark, out, ["window_start_epoch"]), "window_start_epoch", "requests", "size_sum")
    base = 1704067200  # 2024-01-01T00:00:00Z
    assert got == [
        (base - 10, 1, 10),
        (base, 2, 30),
        (base + 10, 2, 50),
        (base + 20, 1, 30),
    ]


def test_windowed_top_endpoints_and_heavy_hitters(spark, tmp_path):
    lines = "".join(_log("01/Jan/2024:00:00:01", "9.9.9.9", e, 1) for e in ["/a", "/a", "/b", "/c", "/c", "/c"])
    feed = _feed(tmp_path, "logs2", [lines])
    logs = SL.timed_logs(text_file_stream(spark, feed), event_time=True)
    out = run_to_table(SL.window_endpoint_counts(logs, "1 hour", "1 hour"), "t-ep", "update")
    top = SL.top_endpoints_per_window(read_latest(spark, out, ["window_start_epoch", "endpoint"]), 2)
    assert rows(top, "endpoint", "count", "rank") == [("/a", 2, 2), ("/c", 3, 1)]
    logs = SL.timed_logs(text_file_stream(spark, feed), event_time=True)
    out = run_to_table(SL.window_heavy_hitters(logs, 5, "1 hour", "1 hour"), "t-hh", "update")
    assert rows(read_latest(spark, out, ["window_start_epoch", "ipAddress"]), "ipAddress", "count") == [
        ("9.9.9.9", 6)
    ]


def test_arrival_time_windows_cover_every_record_twice(spark, tmp_path):
    lines = "".join(_log("01/Jan/2024:00:00:01", "1.1.1.1", "/a", 1) for _ in range(5))
    feed = _feed(tmp_path, "logs3", [lines])
    logs = SL.timed_logs(text_file_stream(spark, feed), event_time=False)
    out = run_to_table(SL.window_stats(logs), "t-arrival", "update")
    total = read_latest(spark, out, ["window_start_epoch"]).agg(F.sum("requests")).first()[0]
    assert total == 10  # 20 s windows sliding by 10 s: each record in two windows


def test_running_stats(spark, tmp_path):
    feed = _feed(
        tmp_path,
        "logs4",
        [_log("01/Jan/2024:00:00:01", "1.1.1.1", "/a", 5), _log("01/Jan/2024:00:00:02", "1.1.1.1", "/a", 8)],
    )
    logs = SL.timed_logs(text_file_stream(spark, feed, 1))
    out = run_to_table(SL.running_stats(logs), "t-running", "update")
    r = read_latest(spark, out, []).first()
    assert (r.size_sum, r.requests, r.size_avg, r.size_min, r.size_max) == (13, 2, 6, 5, 8)


def test_keyword_track_on_a_stream(spark, tmp_path):
    from quarry.operators.filters import keyword_track

    feed = _feed(tmp_path, "kw", ["Spark is fast\nnothing\n", "I love SPARK and Kafka\n"])
    stream = text_file_stream(spark, feed, 1)
    out = run_to_files(keyword_track(stream, "value", ["spark", "flink"]), "t-kw")
    assert rows(out) == [("I love SPARK and Kafka",), ("Spark is fast",)]


def test_console_sink_starts_and_stops(spark, tmp_path):
    from quarry.streaming.runner import start_console

    feed = _feed(tmp_path, "console", ["a b\n"])
    q = start_console(W.tokens(text_file_stream(spark, feed), "value"), processing_time=None,
                      checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    assert q.isActive
    q.stop()


def _wait(ok, seconds=90):
    end = time.time() + seconds
    while not ok() and time.time() < end:
        time.sleep(0.5)
    assert ok()


def _table(spark, path):
    try:
        return rows(spark.read.parquet(path))
    except Exception:  # noqa: BLE001 - not written yet
        return []


def _add(feed, name, content):
    with open(os.path.join(feed, "." + name), "w") as f:
        f.write(content)
    os.rename(os.path.join(feed, "." + name), os.path.join(feed, name))


def test_continuous_apps_process_and_stop(spark, tmp_path):
    from quarry.streaming import apps

    # one hour later, the windows of the first record have closed
    logs_dir = _feed(tmp_path, "app-logs", [_log("01/Jan/2024:00:00:01", "1.1.1.1", "/a", 5)])
    words_dir = _feed(tmp_path, "app-words", ["x y x\n#no tags\n", "see #yes #also\n"])
    out, ck = str(tmp_path / "app-out"), str(tmp_path / "app-ck")
    qs = apps.start_log_reports(text_file_stream(spark, logs_dir), out, ck, event_time=True,
                                threshold=0, trigger="0 seconds")
    qs["word_count"] = apps.start_word_count(text_file_stream(spark, words_dir), out, ck)
    qs["hashtags"] = apps.start_hashtags(text_file_stream(spark, words_dir), out, ck, terms=["SEE"])

    def table(name):
        return _table(spark, f"{out}/{name}")

    try:
        _wait(lambda: len(table("parsed")) == 1)
        _add(logs_dir, "later.txt", _log("01/Jan/2024:01:00:00", "2.2.2.2", "/b", 7))
        _wait(lambda: len(table("window_endpoint_counts")) == 2)
        _wait(lambda: len(table("window_heavy_hitters")) == 2 and len(table("window_stats")) == 2)
        _wait(lambda: len(table("hashtags")) == 2)
        for name in ("running_stats", "word_count"):
            qs[name].processAllAvailable()
    finally:
        apps.stop_all(qs)
    assert read_latest(spark, f"{out}/running_stats", []).first().requests == 2
    counts = rows(read_batches(spark, f"{out}/word_count").select("word", "count"))
    assert ("x", 2) in counts and ("y", 1) in counts
    assert table("hashtags") == [("#also",), ("#yes",)]
    top = apps.read_window_top_endpoints(spark, out, k=1)
    assert rows(top, "endpoint", "count", "rank") == [("/a", 1, 1), ("/a", 1, 1)]  # two windows


def test_state_of_the_log_app_stops_growing(spark, tmp_path):
    from quarry.streaming import apps

    logs_dir = _feed(tmp_path, "grow-logs", [])
    out, ck = str(tmp_path / "grow-out"), str(tmp_path / "grow-ck")
    qs = apps.start_log_reports(text_file_stream(spark, logs_dir), out, ck, event_time=True,
                                trigger="0 seconds")
    state = []
    try:
        for hour in range(5):  # 20 hosts an hour; the default watermark is 10 minutes
            text = "".join(_log(f"01/Jan/2024:{hour:02d}:00:00", f"10.0.{hour}.{i}", "/a", 1)
                           for i in range(20))
            _add(logs_dir, f"h{hour}.txt", text)
            # two windows a host, and a batch without data that drops the old ones
            _wait(lambda: len(_table(spark, f"{out}/parsed")) == 20 * (hour + 1))
            q = qs["window_heavy_hitters"]
            q.processAllAvailable()
            state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    finally:
        apps.stop_all(qs)
    assert max(state) <= 80 and state[-1] <= 40


def test_windowed_reports_need_a_watermark(spark, tmp_path):
    from quarry.streaming import apps

    stream = text_file_stream(spark, _feed(tmp_path, "nowm", ["x\n"]))
    with pytest.raises(ValueError, match="watermark"):
        apps.start_log_reports(stream, str(tmp_path / "o"), str(tmp_path / "c"), watermark="")


def test_a_failing_report_is_raised_while_others_run(spark, tmp_path):
    from quarry.streaming import apps
    from quarry.streaming.runner import start_to_files

    feed = _feed(tmp_path, "mixed", ["x\n"])
    lines = text_file_stream(spark, feed)
    good = start_to_files(lines, str(tmp_path / "g"), str(tmp_path / "gc"), available_now=False,
                          processing_time="1 second", name="good")
    bad = start_to_files(lines.select(F.raise_error(F.col("value")).alias("v")), str(tmp_path / "b"),
                         str(tmp_path / "bc"), available_now=False, name="bad")
    try:
        began = time.time()
        with pytest.raises(RuntimeError, match="bad failed"):
            apps.await_all([good, bad], timeout_s=60)
        assert time.time() - began < 30 and good.isActive
    finally:
        apps.stop_all([good, bad])


def test_watermark_bounds_state(spark, tmp_path):
    # batch 0 moves the watermark to 01:00 - 10 min = 00:50. Spark only
    # guarantees to keep data newer than the watermark (older rows "may or
    # may not" be dropped), but it does evict every window that ended before
    # the watermark, so state does not grow with the length of the stream.
    from quarry.session import scratch_path
    from quarry.streaming.runner import start_to_table

    f0 = _log("01/Jan/2024:01:00:00", "1.1.1.1", "/a", 1)
    f1 = _log("31/Dec/2023:23:30:00", "2.2.2.2", "/old", 1) + _log("01/Jan/2024:01:05:00", "3.3.3.3", "/b", 1)
    feed = _feed(tmp_path, "late", [f0, f1])
    logs = SL.timed_logs(text_file_stream(spark, feed, 1), event_time=True, watermark="10 minutes")
    out = scratch_path(spark, "t-late-out")
    q = start_to_table(SL.window_endpoint_counts(logs, "1 hour", "1 hour"), out, scratch_path(spark, "t-late-ck"))
    q.awaitTermination(120)
    last = q.recentProgress[-1]
    assert last["eventTime"]["watermark"].startswith("2024-01-01T00:55")
    assert last["stateOperators"][0]["numRowsTotal"] == 2  # only the open 01:00 window's keys
    got = rows(read_latest(spark, out, ["window_start_epoch", "endpoint"]), "endpoint", "count")
    assert ("/a", 1) in got and ("/b", 1) in got


def test_word_count_batches_are_the_arrivals(spark):
    from quarry.streaming.jobs import stream_word_count_batches

    got = stream_word_count_batches(spark, "/root/testdata/sf0.001")
    assert sorted(r.batch for r in got.select("batch").distinct().collect()) == [0, 1, 2, 3]


def test_stream_app_cli_runs_for_a_bounded_time(tmp_path):
    import subprocess
    import sys

    feed = _feed(tmp_path, "cli-posts", ["user 1 did #view\n", "#a b\n"])
    out, ck = str(tmp_path / "cli-out"), str(tmp_path / "cli-ck")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run(
        [sys.executable, "-m", "quarry.streaming.apps", "hashtags", feed, out, ck, "--timeout", "20"],
        cwd=repo, capture_output=True, timeout=180,
    )
    assert proc.returncode == 0, proc.stderr.decode()[-2000:]
    files = [f for f in os.listdir(f"{out}/hashtags") if f.startswith("part-")]
    assert files
