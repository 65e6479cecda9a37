"""Long-running streaming applications (start, then await termination).

Each starter takes a streaming DataFrame of text lines (``value``) -- e.g.
``sources.streams.text_file_stream`` or ``socket_stream`` -- and starts one
query per report with a processing-time trigger (the log reports share one
parsing query, so every line is parsed once). Results land in
``out_dir/<report>``, each query with its own checkpoint under
``checkpoint_dir/<report>``, so a restarted application resumes where it
stopped.

Windowed reports always have a watermark: a window is written once, when it
closes, by Spark's file sink, and then leaves the state, as an old window
leaves the reference's stream. So state and files stay in proportion to the
open windows and the results.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import words as W
from quarry.operators.filters import keyword_track
from quarry.streaming import logs as SL
from quarry.streaming.compaction import DAY, with_day
from quarry.streaming.runner import (
    BatchFn, WindowFn, start_to_files, start_to_table, start_to_tables, start_window_actions,
)

# --- fixed values: micro-batch intervals of the original applications -------
LOG_TRIGGER = "2 seconds"
WORD_TRIGGER = "10 seconds"
POST_TRIGGER = "2 seconds"
# ---------------------------------------------------------------------------

DEFAULT_WATERMARK = "10 minutes"


def _append(df: DataFrame, out_dir: str, checkpoint_dir: str, name: str, trigger: str,
            partition_by: str | None = None) -> StreamingQuery:
    return start_to_files(
        df, f"{out_dir.rstrip('/')}/{name}", f"{checkpoint_dir.rstrip('/')}/{name}",
        available_now=False, processing_time=trigger, name=name, partition_by=partition_by,
    )


def _start(df: DataFrame, out_dir: str, checkpoint_dir: str, name: str, mode: str, trigger: str,
           per_batch: BatchFn | None = None) -> StreamingQuery:
    return start_to_table(
        df,
        f"{out_dir.rstrip('/')}/{name}",
        f"{checkpoint_dir.rstrip('/')}/{name}",
        output_mode=mode,
        available_now=False,
        processing_time=trigger,
        name=name,
        per_batch=per_batch,
    )


def start_log_reports(
    lines: DataFrame,
    out_dir: str,
    checkpoint_dir: str,
    window: str = SL.DEFAULT_WINDOW,
    slide: str = SL.DEFAULT_SLIDE,
    event_time: bool = False,
    watermark: str = DEFAULT_WATERMARK,
    threshold: int = 10,
    trigger: str = LOG_TRIGGER,
    k: int = 10,
    action: WindowFn | None = None,
) -> dict[str, StreamingQuery]:
    """Windowed log reports: stats, heavy hitters, endpoint counts (the top-k of
    any k is read from them with :func:`read_window_top_endpoints`), the top
    ``k`` endpoints, and the running totals so far. Defaults: arrival-time
    20 s windows sliding by 10 s, a 2 s trigger, a watermark of 10 minutes.

    Lines are parsed once: a stateless query writes the records (with their
    time, so an arrival time is fixed at ingestion) to ``out_dir/parsed`` and
    the rejected lines with their reason to ``out_dir/rejected``, both from
    one micro-batch and each batch once; the report queries stream from the
    records and may start before there are any.

    The windowed reports lie in a folder for each day of their window's start;
    ``compaction.compact_days`` rewrites closed days into a few files, and
    ``compaction.read_days`` reads over both.

    ``action(window start, rows)``, if given, is called once for every window
    as it closes, with its stats.
    """
    if not watermark:
        raise ValueError("windowed reports need a watermark, else their state grows for ever")
    spark = lines.sparkSession
    out, checkpoints = out_dir.rstrip("/"), checkpoint_dir.rstrip("/")
    tagged = SL.tagged_logs(lines, event_time=event_time)
    queries = {"parsed_logs": start_to_tables(
        tagged, out, f"{checkpoints}/parsed", SL.LINE_TABLES, available_now=False,
        processing_time=trigger, name="parsed_logs",
    )}
    records = spark.readStream.schema(SL.records_of(tagged).schema).option(
        "recursiveFileLookup", "true").parquet(f"{out}/parsed")
    logs = records.withWatermark("time", watermark)
    for name, report in (
        ("window_stats", SL.window_stats(logs, window, slide)),
        ("window_heavy_hitters", SL.window_heavy_hitters(logs, threshold, window, slide)),
        ("window_endpoint_counts", SL.window_endpoint_counts(logs, window, slide)),
        ("window_top_endpoints", SL.window_top_endpoints(logs, k, window, slide)),
    ):
        queries[name] = _append(with_day(report), out_dir, checkpoint_dir, name, trigger, DAY)
    if action:
        queries["window_actions"] = start_window_actions(
            SL.window_stats(logs, window, slide), action, f"{out}/window_marks",
            f"{checkpoints}/window_actions", available_now=False, processing_time=trigger,
            name="window_actions")
    queries["running_stats"] = _start(SL.running_stats(records), out_dir, checkpoint_dir,
                                      "running_stats", "update", trigger)
    return queries


def read_window_top_endpoints(spark: SparkSession, out_dir: str, k: int = 10) -> DataFrame:
    """Top-k endpoints of every closed window of the running app."""
    counts = spark.read.parquet(f"{out_dir.rstrip('/')}/window_endpoint_counts").drop(DAY)
    return SL.top_endpoints_per_window(counts, k)


def start_word_count(lines: DataFrame, out_dir: str, checkpoint_dir: str,
                     trigger: str = WORD_TRIGGER) -> StreamingQuery:
    """Word counts of every micro-batch on its own (no running totals)."""
    return _start(W.tokens(lines, "value"), out_dir, checkpoint_dir, "word_count", "append", trigger,
                  per_batch=W.word_count)


def start_hashtags(lines: DataFrame, out_dir: str, checkpoint_dir: str,
                   trigger: str = POST_TRIGGER, terms: list[str] | None = None) -> StreamingQuery:
    """Hashtags of every post as it arrives; with ``terms``, only of posts that
    mention one of them."""
    if terms:
        lines = keyword_track(lines, "value", terms)
    return _append(W.hashtags(W.tokens(lines, "value")), out_dir, checkpoint_dir, "hashtags", trigger)


def await_all(queries: dict[str, StreamingQuery] | list[StreamingQuery],
              timeout_s: float | None = None, poll_s: float = 0.2) -> None:
    """Block until every query has stopped or ``timeout_s`` is over. A failure
    of any query is raised at once, while the others still run."""
    qs = list(queries.values()) if isinstance(queries, dict) else list(queries)
    end = time.monotonic() + timeout_s if timeout_s else None
    while True:
        running = [q for q in qs if q.isActive]
        for q in qs:
            if not q.isActive and q.exception() is not None:
                raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
        if not running or (end and time.monotonic() >= end):
            return
        time.sleep(poll_s)


def stop_all(queries: dict[str, StreamingQuery] | list[StreamingQuery]) -> None:
    """Stop every query of an application."""
    for q in (queries.values() if isinstance(queries, dict) else queries):
        q.stop()


def main(argv: list[str] | None = None) -> None:
    """``python -m quarry.streaming.apps <app> <input> <out_dir> <checkpoint_dir>``

    ``<input>`` is a directory of new text files, or ``host:port`` for a
    socket (word count). Runs until stopped, or for ``--timeout`` seconds.
    """
    import argparse

    from quarry.session import build_session
    from quarry.sources.streams import socket_stream, text_file_stream

    parser = argparse.ArgumentParser(prog="quarry.streaming.apps")
    parser.add_argument("app", choices=["log_reports", "word_count", "hashtags"])
    parser.add_argument("input")
    parser.add_argument("out_dir")
    parser.add_argument("checkpoint_dir")
    parser.add_argument("--event-time", action="store_true", help="window on the log's own time")
    parser.add_argument("--watermark", default=DEFAULT_WATERMARK,
                        help="how long a window waits for late records")
    parser.add_argument("--terms", nargs="*", default=None, help="hashtags: only posts that mention one")
    parser.add_argument("--timeout", type=float, default=None, help="stop after this many seconds")
    args = parser.parse_args(argv)

    spark = build_session(app_name=f"quarry-stream-{args.app}")
    host, _, port = args.input.rpartition(":")
    if args.app == "word_count" and host and port.isdigit():
        lines = socket_stream(spark, host, int(port))
    else:
        lines = text_file_stream(spark, args.input)
    if args.app == "log_reports":
        queries = start_log_reports(lines, args.out_dir, args.checkpoint_dir,
                                    event_time=args.event_time, watermark=args.watermark)
    elif args.app == "word_count":
        queries = {"word_count": start_word_count(lines, args.out_dir, args.checkpoint_dir)}
    else:
        queries = {"hashtags": start_hashtags(lines, args.out_dir, args.checkpoint_dir,
                                              terms=args.terms)}
    try:
        await_all(queries, args.timeout)
    finally:
        stop_all(queries)
        spark.stop()


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
