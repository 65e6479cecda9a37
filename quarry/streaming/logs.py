"""Windowed access-log reports on a stream of log lines.

The reference windowed on arrival time (20 s windows sliding by 10 s) and ran
four SQL questions per window. Here each question is one streaming
aggregation keyed by the window:

* ``window_stats``: size sum / count / truncated mean / min / max and the
  number of response codes;
* ``window_ip_counts`` + threshold: heavy hitters per window;
* ``window_endpoint_counts``: requests per endpoint per window; the top-k per
  window is taken when the result is read (``top_endpoints_per_window``), or
  in the stream as the window closes (``window_top_endpoints``).

``tagged_logs`` keeps the lines that do not parse beside the records.

Time is either the log's own timestamp (event time, deterministic, supports
a watermark for late data and bounded state) or the arrival time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.weblog import LOG_FIELDS, log_time
from quarry.operators.topk import top_k_per_group
from quarry.operators.weblog import parse_access_log, tagged_log_lines

# Reference window: 20 seconds long, sliding every 10 seconds.
DEFAULT_WINDOW = "20 seconds"
DEFAULT_SLIDE = "10 seconds"


def timed_logs(
    lines: DataFrame, event_time: bool = True, watermark: str | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Parsed records (all fields, or only ``fields``) with a ``time`` column:
    log time or arrival time."""
    fields = list(fields or LOG_FIELDS)
    if event_time:
        taken = fields if "dateTimeString" in fields else [*fields, "dateTimeString"]
        logs = parse_access_log(lines, fields=taken).withColumn("time", log_time("dateTimeString"))
        logs = logs.where(F.col("time").isNotNull()).select(*fields, "time")
    else:
        lines = lines.withColumn("time", F.current_timestamp())
        logs = parse_access_log(lines, keep=["time"], fields=fields)
    if watermark:
        logs = logs.withWatermark("time", watermark)
    return logs


def tagged_logs(
    lines: DataFrame, event_time: bool = True, fields: list[str] | None = None
) -> DataFrame:
    """One row a line: ``time``, ``record``, and ``value`` and ``reason`` of a
    rejected line (see ``tagged_log_lines``). ``time``: the log's own, and a
    record whose time does not parse is rejected; or the time of arrival."""
    if event_time:
        return tagged_log_lines(lines, fields=fields, time="time")
    lines = lines.withColumn("time", F.current_timestamp())
    return tagged_log_lines(lines, keep=["time"], fields=fields)


def records_of(tagged: DataFrame) -> DataFrame:
    """The records of ``tagged_logs`` with their time."""
    return tagged.where(F.col("reason").isNull()).select("record.*", "time")


def rejected_of(tagged: DataFrame) -> DataFrame:
    """(value, reason) of the rejected lines of ``tagged_logs``."""
    return tagged.where(F.col("reason").isNotNull()).select("value", "reason")


# Tables of a stream of tagged lines.
LINE_TABLES = {"parsed": records_of, "rejected": rejected_of}
REJECTED_SCHEMA = "value string, reason string"


def _window(window: str, slide: str) -> Column:
    return F.window("time", window, slide)


def _bounds(w: Column) -> list[Column]:
    # epoch seconds: window arithmetic is zone-free, and so is the output
    return [
        F.unix_seconds(w.start).alias("window_start_epoch"),
        F.unix_seconds(w.end).alias("window_end_epoch"),
    ]


def window_stats(logs: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE) -> DataFrame:
    """Per window: size sum, request count, truncated mean, min, max and the number of response codes."""
    size = F.col("contentSize")
    agg = logs.groupBy(_window(window, slide).alias("w")).agg(
        F.sum(size).alias("size_sum"),
        F.count(F.lit(1)).alias("requests"),
        F.min(size).alias("size_min"),
        F.max(size).alias("size_max"),
        F.count("responseCode").alias("response_codes"),
    )
    return agg.select(
        *_bounds(F.col("w")),
        "size_sum",
        "requests",
        F.expr("size_sum div requests").alias("size_avg"),
        "size_min",
        "size_max",
        "response_codes",
    )


def window_ip_counts(logs: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE) -> DataFrame:
    """Requests per (window, ip address)."""
    agg = logs.groupBy(_window(window, slide).alias("w"), "ipAddress").agg(
        F.count(F.lit(1)).alias("count")
    )
    return agg.select(F.unix_seconds(F.col("w").start).alias("window_start_epoch"), "ipAddress", "count")


def window_heavy_hitters(
    logs: DataFrame, threshold: int = 10, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE
) -> DataFrame:
    """(window, ip, count) with count > threshold. Counts only grow, so the
    newest emitted version of a key is its final count."""
    return window_ip_counts(logs, window, slide).where(F.col("count") > threshold)


def window_endpoint_counts(
    logs: DataFrame, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE
) -> DataFrame:
    """Requests per (window, endpoint)."""
    agg = logs.groupBy(_window(window, slide).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("count")
    )
    return agg.select(F.unix_seconds(F.col("w").start).alias("window_start_epoch"), "endpoint", "count")


# Endpoints of a window are ranked in so many parts, by a hash of the endpoint.
RANK_PARTS = 64


def window_top_endpoints(
    logs: DataFrame, k: int = 10, window: str = DEFAULT_WINDOW, slide: str = DEFAULT_SLIDE,
    parts: int = RANK_PARTS,
) -> DataFrame:
    """Top-k endpoints of every window as it closes: (window_start_epoch,
    endpoint, count, rank), ties by endpoint. Needs a watermark and append mode.

    Three stateful operators in one query. The first counts; a closed window's
    counts go on to the second, which ranks each of ``parts`` parts of the
    endpoints and keeps k, and the third ranks the parts' best, ``parts`` x k
    rows a window at most. Endpoints are distinct by then, so their hash deals
    them evenly and one window's endpoints never meet in one row.
    """
    def best(rows: Column) -> Column:
        return F.slice(F.sort_array(rows), 1, k)

    def closing(w: str) -> Column:
        # a window's last instant lies in one stretch of the slide's length
        return F.window(F.window_time(w), slide).alias("w")

    counts = logs.groupBy(_window(window, slide).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("count"))
    entry = F.struct((-F.col("count")).alias("less"), "endpoint")
    part = F.pmod(F.xxhash64("endpoint"), F.lit(parts)).alias("part")
    some = counts.groupBy(closing("w"), part).agg(
        F.min(F.unix_seconds("w.start")).alias("start"), best(F.collect_list(entry)).alias("best"))
    top = some.groupBy(closing("w")).agg(
        F.min("start").alias("window_start_epoch"),
        best(F.flatten(F.collect_list("best"))).alias("best"))
    return top.select("window_start_epoch", F.posexplode("best").alias("rank", "e")).select(
        "window_start_epoch", "e.endpoint", (-F.col("e.less")).alias("count"),
        (F.col("rank") + 1).alias("rank"))


def top_endpoints_per_window(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top-k endpoints of every window from (window, endpoint, count) rows."""
    return top_k_per_group(counts, "window_start_epoch", "count", k, "endpoint", "rank")


def running_stats(logs: DataFrame) -> DataFrame:
    """Totals so far over the whole stream (the reference's commented-out
    running sum / count / min / max), one row updated every batch."""
    size = F.col("contentSize")
    agg = logs.agg(
        F.sum(size).alias("size_sum"),
        F.count(F.lit(1)).alias("requests"),
        F.min(size).alias("size_min"),
        F.max(size).alias("size_max"),
    )
    return agg.select(
        "size_sum", "requests", F.expr("size_sum div requests").alias("size_avg"), "size_min", "size_max"
    )
