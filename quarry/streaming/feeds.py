"""Feeds laid down in the order of their time.

A table comes in its own order. For a windowed stream, which must let go of
old windows, its lines are first staged by day in one distributed write
(dealt by ranges of time), and the day folders are then moved into the folder
that the stream watches, oldest first: moving complete files is how the file
source wants to be fed. Every move is followed by the micro-batches it causes,
so the watermark follows the feed and no record is late.

The last days come with a heartbeat, a log line of a later time, as a server
that has nothing to report would send: it closes the windows that no later
record would close, and its own windows stay open.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import list_folder, make_folder, move_folder, scratch_path
from quarry.sources.streams import text_file_stream
from quarry.streaming.runner import start_to_files

BATCH_BYTES = 1 << 30  # days are delivered together up to this size


@dataclass
class Day:
    day: dt.date | None  # None: lines without a time
    path: str
    size: int


def stage_by_day(
    rows: DataFrame, lines_of: Callable[[DataFrame], DataFrame], name: str, time: str = "ts",
    line: str = "value",
) -> list[Day]:
    """Write the lines of ``rows`` as text, a folder for each day; the folders,
    oldest first and lines without a time before all others. ``lines_of``
    makes the lines, and keeps ``time``: rows are dealt before it."""
    spark = rows.sparkSession
    path = scratch_path(spark, f"{name}-days")
    lines = lines_of(rows.repartitionByRange(time))
    lines.select(line, F.to_date(time).alias("day")).write.partitionBy("day").text(path)
    days = []
    for folder, size in list_folder(spark, path):
        value = folder.rpartition("=")[2]
        known = value != "__HIVE_DEFAULT_PARTITION__"
        days.append(Day(dt.date.fromisoformat(value) if known else None, folder, size))
    return sorted(days, key=lambda d: (d.day or dt.date.min))


def deliveries(days: list[Day], batch_bytes: int = BATCH_BYTES) -> list[list[Day]]:
    """Consecutive days, together up to ``batch_bytes``; a larger day alone."""
    out: list[list[Day]] = []
    size = 0
    for d in days:
        if not out or size + d.size > batch_bytes:
            out.append([])
            size = 0
        out[-1].append(d)
        size += d.size
    return out


def heartbeat_line(time: dt.datetime) -> str:
    stamp = f"{time.day:02d}/{time:%b}/{time:%Y:%H:%M:%S}"
    return f'0.0.0.0 - - [{stamp} +0000] "GET /heartbeat HTTP/1.1" 200 0'


def _deliver(spark: SparkSession, feed: str, group: list[Day]) -> None:
    for d in group:
        move_folder(spark, d.path, f"{feed}/{d.path.rpartition('/')[2]}")


def _heartbeat(spark: SparkSession, feed: str, time: dt.datetime) -> None:
    beat = scratch_path(spark, "heartbeat")
    spark.range(1, numPartitions=1).select(F.lit(heartbeat_line(time)).alias("value")).write.text(beat)
    move_folder(spark, beat, f"{feed}/heartbeat")


def run_in_time_order(
    rows: DataFrame,
    lines_of: Callable[[DataFrame], DataFrame],
    report: Callable[[DataFrame], DataFrame],
    name: str,
    open_for: dt.timedelta,
    time: str = "ts",
    batch_bytes: int = BATCH_BYTES,
    out: str | None = None,
    partition_by: str | None = None,
) -> tuple[DataFrame, list[dict]]:
    """Run ``report``, an append-mode stream over text lines, over the lines of
    ``rows`` in the order of ``time``; its rows as a table, and the progress of
    every micro-batch. ``open_for``: how long after its first record a window
    can still be open (its length and the watermark's delay). ``out``: the
    table's folder, by default a new scratch folder."""
    spark = rows.sparkSession
    days = stage_by_day(rows, lines_of, name, time)
    feed, checkpoint = (scratch_path(spark, f"{name}-{x}") for x in ("feed", "ckpt"))
    out = out or scratch_path(spark, f"{name}-out")
    make_folder(spark, feed)
    groups = deliveries(days, batch_bytes)
    query = None
    stream = report(text_file_stream(spark, feed, nested=True))
    try:
        for group in groups:
            _deliver(spark, feed, group)
            if group is groups[-1] and group[-1].day:
                end = dt.datetime.combine(group[-1].day, dt.time()) + dt.timedelta(days=1)
                _heartbeat(spark, feed, end + 2 * open_for)
            query = query or start_to_files(
                stream, out, checkpoint, available_now=False, name=name, partition_by=partition_by)
            query.processAllAvailable()
        progress = list(query.recentProgress) if query else []
    finally:
        if query:
            query.stop()
    if not groups:  # an empty table
        return spark.createDataFrame([], stream.schema), []
    return spark.read.schema(stream.schema).parquet(out), progress
