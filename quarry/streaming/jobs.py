"""Streaming jobs run over a file feed derived from the tables.

Each job writes its input once as text files into the shared checkpoint folder
(the "feed"), reads it with the file stream source at most FEED_BATCH_BYTES per
micro-batch, runs the streaming query to completion with an availableNow
trigger, and returns the finished result table as a batch DataFrame.

The feed of a windowed report is laid down in the order of its time
(``quarry.streaming.feeds``) and has a watermark: a window is written once, as
it closes, and leaves the state, which holds the open windows only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import words as W
from quarry.operators.filters import keyword_track
from quarry.plans.words import TRACKED_TERMS
from quarry.session import folder_exists, make_folder, move_folder, scratch_path
from quarry.sources.streams import text_file_stream
from quarry.sources.tables import event_log_lines, event_posts, table
from quarry.streaming import logs as SL
from quarry.streaming.compaction import DAY, compact_days, read_days, with_day
from quarry.streaming.feeds import run_in_time_order
from quarry.streaming.runner import (
    read_batches, read_latest, run_to_files, run_to_table, start_to_table, start_to_tables,
)

FEED_BATCH_BYTES = 1 << 30  # input of one micro-batch, at most
# Window of the registered windowed log report: 7 days sliding by 1 day, so
# that per-window host counts are large enough for the threshold to select.
REPORT_WINDOW = "7 days"
REPORT_SLIDE = "1 day"
REPORT_WATERMARK = "1 hour"
REPORT_OPEN_FOR = dt.timedelta(days=7, hours=1)  # window and watermark
REPORT_HEAVY_HITTER_THRESHOLD = 10
REPORT_TOP_K = 10
ARRIVALS = 4  # of the per-batch word count: each is a micro-batch
TRACKED_POSTS = ["#signup", "did #error"]  # terms of the keyword-limited hashtag stream


def write_feed(df: DataFrame, name: str, line: str = "value") -> str:
    """Write a text feed, one file per partition; returns its folder."""
    path = scratch_path(df.sparkSession, name)
    df.select(line).write.text(path)
    return path


def feed_stream(df: DataFrame, name: str) -> DataFrame:
    return text_file_stream(df.sparkSession, write_feed(df, name), max_bytes=FEED_BATCH_BYTES)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("value"))


def _logs(spark: SparkSession, sf_dir: str, name: str, *fields: str) -> DataFrame:
    lines = event_log_lines(table(spark, sf_dir, "events"))
    return SL.timed_logs(feed_stream(lines, name), fields=list(fields))


# --- registered jobs ----------------------------------------------------------

def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch (stateless) word counts of a document feed; returned summed
    over batches, which equals the batch word count."""
    stream = feed_stream(_documents(spark, sf_dir), "words-feed")
    out = run_to_table(
        W.tokens(stream, "value"), "stream-word-count", output_mode="append",
        per_batch=W.word_count,
    )
    return (
        read_batches(spark, out, "word string, count bigint, batch bigint")
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
    )


def stream_word_count_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(batch, word, count): word counts of every micro-batch on its own.

    The documents arrive in ARRIVALS parts, by their id, each when the query
    has done the one before; so a batch is exactly one arrival and carries
    nothing over.
    """
    docs = _documents(spark, sf_dir)
    part = F.coalesce(F.pmod(F.col("doc_id"), F.lit(ARRIVALS)), F.lit(0))
    staged, feed, out, checkpoint = (
        scratch_path(spark, f"word-batches-{x}") for x in ("staged", "in", "out", "ckpt"))
    # written once, a folder for each arrival, which is then moved in as it is
    docs.select("value", part.alias("arrival")).write.partitionBy("arrival").text(staged)
    make_folder(spark, feed)
    words = W.tokens(text_file_stream(spark, feed, nested=True), "value")
    query = None
    try:
        for arrival in range(ARRIVALS):
            come = f"{staged}/arrival={arrival}"
            if folder_exists(spark, come):
                move_folder(spark, come, f"{feed}/{arrival}")
            query = query or start_to_table(
                words, out, checkpoint, "append", available_now=False, per_batch=W.word_count)
            query.processAllAvailable()
    finally:
        if query:
            query.stop()
    schema = "word string, count bigint, batch bigint"
    if not folder_exists(spark, out):  # an empty table has no batch
        return spark.createDataFrame([], schema)
    return read_batches(spark, out, schema)


def stream_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashtags of a post feed (stateless, append)."""
    posts = feed_stream(event_posts(table(spark, sf_dir, "events")), "posts-feed")
    return run_to_files(W.hashtags(W.tokens(posts, "value")), "stream-hashtags")


def stream_tracked_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashtags of the posts that mention a tracked term."""
    posts = feed_stream(event_posts(table(spark, sf_dir, "events")), "tracked-feed")
    tracked = keyword_track(posts, "value", TRACKED_POSTS)
    return run_to_files(W.hashtags(W.tokens(tracked, "value")), "stream-tracked-hashtags")


def stream_keyword_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a document feed that mention a tracked term (stateless,
    append): the keyword-limited post stream, re-aimed at any text stream."""
    stream = feed_stream(_documents(spark, sf_dir), "keyword-feed")
    return run_to_files(keyword_track(stream, "value", TRACKED_TERMS), "stream-keyword-track")


def stream_running_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the whole stream."""
    logs = _logs(spark, sf_dir, "running-feed", "contentSize")
    out = run_to_table(SL.running_stats(logs), "stream-running-stats")
    return read_latest(spark, out, [])


def _closed_windows(
    spark: SparkSession, sf_dir: str, name: str, fields: list[str],
    report: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Rows of a windowed report over the log lines in time order."""
    def over(lines: DataFrame) -> DataFrame:
        return report(SL.timed_logs(lines, fields=fields, watermark=REPORT_WATERMARK))

    events = table(spark, sf_dir, "events")
    return run_in_time_order(events, event_log_lines, over, name, REPORT_OPEN_FOR)[0]


def stream_log_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window stats (7-day windows sliding by 1 day) of a log feed."""
    return _closed_windows(
        spark, sf_dir, "stream-log-windows", ["contentSize", "responseCode"],
        lambda logs: SL.window_stats(logs, REPORT_WINDOW, REPORT_SLIDE))


def stream_window_heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window hosts with more than 10 requests."""
    return _closed_windows(
        spark, sf_dir, "stream-window-heavy-hitters", ["ipAddress"],
        lambda logs: SL.window_heavy_hitters(
            logs, REPORT_HEAVY_HITTER_THRESHOLD, REPORT_WINDOW, REPORT_SLIDE))


def stream_window_top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window endpoint counts kept by the stream; the top 10 per window are taken on read."""
    counts = _closed_windows(
        spark, sf_dir, "stream-window-endpoints", ["endpoint"],
        lambda logs: SL.window_endpoint_counts(logs, REPORT_WINDOW, REPORT_SLIDE))
    return SL.top_endpoints_per_window(counts, REPORT_TOP_K)


def stream_closed_top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 10 endpoints of every window, ranked in the stream as it closes."""
    return _closed_windows(
        spark, sf_dir, "stream-closed-top", ["endpoint"],
        lambda logs: SL.window_top_endpoints(logs, REPORT_TOP_K, REPORT_WINDOW, REPORT_SLIDE))


def stream_compacted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window stats in a folder for each day, the first half of the days
    compacted; read back over both."""
    def over(lines: DataFrame) -> DataFrame:
        logs = SL.timed_logs(lines, fields=["contentSize", "responseCode"],
                             watermark=REPORT_WATERMARK)
        return with_day(SL.window_stats(logs, REPORT_WINDOW, REPORT_SLIDE))

    out, compacted = (scratch_path(spark, f"stream-days-{x}") for x in ("out", "compacted"))
    events = table(spark, sf_dir, "events")
    written, _ = run_in_time_order(
        events, event_log_lines, over, "stream-days", REPORT_OPEN_FOR, out=out, partition_by=DAY)
    first, last = written.agg(F.min(DAY), F.max(DAY)).first()
    if first is None:
        return written.drop(DAY)
    compact_days(spark, out, compacted, first + (last - first) / 2)
    return read_days(spark, out, compacted).drop(DAY)


def stream_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of a log feed with their reason; the micro-batch that
    writes them writes the records too, each line parsed once."""
    lines = event_log_lines(table(spark, sf_dir, "events"))
    out, checkpoint = (scratch_path(spark, f"stream-rejected-{x}") for x in ("out", "ckpt"))
    tagged = SL.tagged_logs(feed_stream(lines, "rejected-feed"))
    start_to_tables(tagged, out, checkpoint, SL.LINE_TABLES).awaitTermination()
    return read_batches(spark, f"{out}/rejected", SL.REJECTED_SCHEMA).select("value", "reason")
