"""Windowed streams in time order, ranked and acted on as windows close, and
several tables of one micro-batch."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarry.session import folder_exists, list_folder, scratch_path
from quarry.sources.streams import text_file_stream
from quarry.sources.tables import event_log_lines, table
from quarry.streaming import feeds
from quarry.streaming import logs as SL
from quarry.streaming.runner import (
    read_batches, start_to_tables, start_window_actions, tables_writer, window_actions,
)
from tests.conftest import local_dir, rows
from tests.test_streaming import _feed, _log

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
DAY = 86400
BASE = 1704067200  # 2024-01-01T00:00:00Z


def _stats(lines):
    logs = SL.timed_logs(lines, fields=["contentSize", "responseCode"], watermark="1 hour")
    return SL.window_stats(logs, "7 days", "1 day")


@needs_data
def test_state_stays_flat_while_the_feed_grows(spark):
    events = table(spark, SF, "events")
    open_for = dt.timedelta(days=7, hours=1)
    found, progress = feeds.run_in_time_order(
        events, event_log_lines, _stats, "t-flat", open_for, batch_bytes=1)
    days = events.select(F.to_date("ts")).distinct().count()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["numInputRows"]]
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress)
    assert days <= len(state) <= days + 1 and days > 20  # the heartbeat may come on its own
    # a day opens a window and closes one; the last batches have the heartbeat's windows too
    assert max(state[10:-2]) <= max(state[:10]) <= 9
    assert dropped == 0
    all_at_once, _ = feeds.run_in_time_order(events, event_log_lines, _stats, "t-once", open_for)
    assert rows(found) == rows(all_at_once) and found.count() == days + 6


def _line_rows(spark, lines):
    return spark.createDataFrame([(v, t) for v, t in lines], "value string, ts timestamp")


def test_lines_without_time_and_empty_tables(spark):
    at = dt.datetime(2024, 1, 3, 5)
    lines = [(_log("03/Jan/2024:05:00:00", "1.1.1.1", "/a", 1).strip(), at), ("junk", None)]
    found, _ = feeds.run_in_time_order(
        _line_rows(spark, lines), lambda d: d, _stats, "t-null", dt.timedelta(days=8))
    assert found.agg(F.sum("requests")).first()[0] == 7
    for none in ([], [("junk", None)]):
        found, _ = feeds.run_in_time_order(
            _line_rows(spark, none), lambda d: d, _stats, "t-none", dt.timedelta(days=8))
        assert found.collect() == [] and "requests" in found.columns


def test_days_are_delivered_up_to_a_size():
    days = [feeds.Day(dt.date(2024, 1, i + 1), f"d{i}", s) for i, s in enumerate([3, 4, 9, 1, 1])]
    assert [[d.size for d in g] for g in feeds.deliveries(days, 7)] == [[3, 4], [9], [1, 1]]
    assert feeds.deliveries([]) == []


def test_heartbeat_is_a_log_line(spark):
    line = feeds.heartbeat_line(dt.datetime(2024, 2, 9, 3, 4, 5))
    got = SL.timed_logs(spark.createDataFrame([(line,)], "value string"))
    assert got.select(F.unix_seconds("time")).first()[0] == BASE + 39 * DAY + 3 * 3600 + 245


@pytest.mark.parametrize("parts", [1, 64])
def test_top_endpoints_are_ranked_as_windows_close(spark, parts):
    text = {1: "abbccc", 2: "aab", 3: "zzyx"}
    lines = [(_log(f"0{d}/Jan/2024:10:00:00", "1.1.1.1", f"/{e}", 1).strip(),
              dt.datetime(2024, 1, d, 10)) for d, es in text.items() for e in es]

    def top(stream):
        logs = SL.timed_logs(stream, fields=["endpoint"], watermark="1 hour")
        return SL.window_top_endpoints(logs, 2, "2 days", "1 day", parts)

    found, progress = feeds.run_in_time_order(
        _line_rows(spark, lines), lambda d: d, top, "t-top", dt.timedelta(days=3), batch_bytes=1)
    assert rows(found, "window_start_epoch", "rank", "endpoint", "count") == [
        (BASE - DAY, 1, "/c", 3), (BASE - DAY, 2, "/b", 2),
        (BASE, 1, "/a", 3), (BASE, 2, "/b", 3),  # a tie, by endpoint
        (BASE + DAY, 1, "/a", 2), (BASE + DAY, 2, "/z", 2),
        (BASE + 2 * DAY, 1, "/z", 2), (BASE + 2 * DAY, 2, "/x", 1)]
    assert len(progress[-1]["stateOperators"]) == 3


def test_windows_shorter_than_their_slide_and_tumbling(spark):
    lines = [(_log(f"01/Jan/2024:00:{m:02d}:00", "1.1.1.1", "/a", 1).strip(),
              dt.datetime(2024, 1, 1, 0, m)) for m in range(0, 30, 2)]

    def top(stream):
        logs = SL.timed_logs(stream, fields=["endpoint"], watermark="1 minute")
        return SL.window_top_endpoints(logs, 1, "10 minutes", "10 minutes")

    found, _ = feeds.run_in_time_order(
        _line_rows(spark, lines), lambda d: d, top, "t-tumble", dt.timedelta(minutes=11))
    assert rows(found, "window_start_epoch", "count") == [(BASE, 5), (BASE + 600, 5), (BASE + 1200, 5)]


LINES = (_log("01/Jan/2024:00:00:01", "1.1.1.1", "/a", 5) + "no log line\n"
         + _log("01/Jan/2024:00:00:02", "1.1.1.1", "/b", 10**30)
         + _log("99/Xyz/2024:00:00:02", "1.1.1.1", "/c", 6))


def test_records_and_rejected_lines_of_one_batch(spark, tmp_path):
    for event_time, want in ((True, {"format", "size", "time"}), (False, {"format", "size"})):
        feed = _feed(tmp_path, f"tag{event_time}", [LINES, LINES])
        out, ck = scratch_path(spark, "t-tag"), scratch_path(spark, "t-tag-ck")
        tagged = SL.tagged_logs(text_file_stream(spark, feed, 1), event_time)
        start_to_tables(tagged, out, ck, SL.LINE_TABLES).awaitTermination()
        bad = read_batches(spark, f"{out}/rejected")
        good = read_batches(spark, f"{out}/parsed")
        assert {r.reason for r in bad.collect()} == want
        assert good.count() + bad.count() == 8 and bad.count() == 2 * len(want)
        assert sorted(r.batch for r in bad.select("batch").distinct().collect()) == [0, 1]
        assert all(r.time is not None and r.contentSize in (5, 6) for r in good.collect())
        assert "no log line" in {r.value for r in bad.collect()}


def test_lines_are_parsed_once_for_both_tables(spark, tmp_path):
    plan = SL.tagged_logs(spark.createDataFrame([("x",)], "value string"))
    assert plan._jdf.queryExecution().executedPlan().toString().count("regexp_replace(") == 1


def test_a_retried_batch_repeats_nothing(spark, tmp_path):
    """The second table fails in the first try; the restarted query runs the
    batch again, the first table is left as it is."""
    feed = _feed(tmp_path, "retry", [LINES])
    out, ck = scratch_path(spark, "t-retry"), scratch_path(spark, "t-retry-ck")
    written = []

    def parsed(df):
        written.append("parsed")
        return SL.records_of(df)

    def failing(df):
        return SL.rejected_of(df).withColumn("x", F.raise_error(F.lit("lost")))

    def start(rejected):
        tagged = SL.tagged_logs(text_file_stream(spark, feed))
        start_to_tables(tagged, out, ck, {"parsed": parsed, "rejected": rejected}).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        start(failing)
    assert not list_folder(spark, f"{out}/rejected")  # nothing half-written is to be seen
    files = sorted(os.listdir(local_dir(f"{out}/parsed/batch=0")))
    start(SL.rejected_of)
    assert written == ["parsed"]
    assert sorted(os.listdir(local_dir(f"{out}/parsed/batch=0"))) == files
    assert read_batches(spark, f"{out}/parsed").count() == 1
    assert read_batches(spark, f"{out}/rejected").count() == 3
    # the same batch once more, as after a crash before the commit
    again = spark.createDataFrame([("x",)], "value string")
    tables_writer(out, {"parsed": lambda d: d, "rejected": lambda d: d})(again, 0)
    assert read_batches(spark, f"{out}/rejected").count() == 3


def test_an_action_runs_once_for_each_closed_window(spark, tmp_path):
    """It fails at the second window; the retried batch goes on there."""
    text = "".join(_log(f"0{d}/Jan/2024:10:00:00", "1.1.1.1", "/a", d) for d in (1, 2, 3))
    feed = _feed(tmp_path, "act", [text, _log("09/Jan/2024:10:00:00", "1.1.1.1", "/a", 1)])
    marks, ck = scratch_path(spark, "t-marks"), scratch_path(spark, "t-act-ck")
    calls, fail = [], [True]

    def action(start, window):
        calls.append((start, window.first().size_sum))
        if fail and len(calls) == 2:
            fail.clear()
            raise RuntimeError("action failed")

    def start():
        logs = SL.timed_logs(text_file_stream(spark, feed, 1), watermark="1 hour")
        report = SL.window_stats(logs, "1 day", "1 day")
        start_window_actions(report, action, marks, ck).awaitTermination()

    with pytest.raises(Exception, match="action failed"):
        start()
    assert folder_exists(spark, f"{marks}/window={BASE}")
    start()
    assert calls == [(BASE, 1), (BASE + DAY, 2), (BASE + DAY, 2), (BASE + 2 * DAY, 3)]


def test_an_action_gets_all_rows_of_its_window(spark):
    batch = spark.createDataFrame(
        [(0, "a"), (0, "b"), (60, "c")], "window_start_epoch bigint, k string")
    seen = {}
    run = window_actions(lambda w, df: seen.setdefault(w, rows(df, "k")), scratch_path(spark, "m"))
    run(batch, 0)
    run(batch, 0)
    assert seen == {0: [("a",), ("b",)], 60: [("c",)]}


def test_the_log_app_writes_rejected_lines_and_closed_windows(spark, tmp_path):
    from quarry.streaming import apps
    from tests.test_streaming import _add, _table, _wait

    feed = _feed(tmp_path, "app", [LINES])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    acted = []
    qs = apps.start_log_reports(
        text_file_stream(spark, feed), out, ck, event_time=True, trigger="0 seconds", k=1,
        action=lambda w, df: acted.append((w, df.first().requests)))
    try:
        _wait(lambda: len(_table(spark, f"{out}/rejected")) == 3)
        _add(feed, "later.txt", _log("01/Jan/2024:01:00:00", "2.2.2.2", "/b", 7))
        _wait(lambda: len(_table(spark, f"{out}/window_top_endpoints")) == 2)
        _wait(lambda: len(acted) == 2)
    finally:
        apps.stop_all(qs)
    assert acted == [(BASE - 10, 1), (BASE, 1)]
    top = spark.read.parquet(f"{out}/window_top_endpoints")
    assert rows(top, "window_start_epoch", "endpoint", "count", "rank") == [
        (BASE - 10, "/a", 1, 1), (BASE, "/a", 1, 1)]
