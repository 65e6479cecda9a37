"""Web access-log analytics: parse, reject, statistics, counts, heavy hitters,
top endpoints. Every function takes/returns DataFrames and works on batch
and streaming input alike (except the ordered top-k, which needs a batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.weblog import (
    LOG_FIELDS, field_numbers, log_record, log_time, matched_groups, packed_groups, record_size,
)
from quarry.operators.aggregates import count_by, count_non_null, global_stats, more_than
from quarry.operators.topk import top_k


def _groups(lines: DataFrame, line: str, keep: list[str], fields: list[str]) -> DataFrame:
    # one projection each, so that neither the regex nor the split is run
    # again by what reads them several times
    numbers = field_numbers(fields)
    packed = lines.select(*keep, F.col(line).alias("_line"), packed_groups(line, numbers).alias("_p"))
    return packed.select(*keep, "_line", matched_groups("_p", "_line", numbers).alias("_g"))


def parse_access_log(
    lines: DataFrame, line: str = "value", keep: list[str] | None = None,
    fields: list[str] | None = None,
) -> DataFrame:
    """Typed access-log records; unparseable lines dropped.

    ``fields``: the record fields to extract, by default all of
    ``LOG_FIELDS``. A line yields zero or one record (``explode`` of a
    0/1-element array), like the reference's parse-then-filter-null. Being a
    generator, it also keeps Catalyst from pushing the validity test below the
    projection that produced the line, which would evaluate the regex and the
    line twice. ``keep`` carries extra input columns (e.g. an arrival
    timestamp).
    """
    keep, fields = keep or [], list(fields or LOG_FIELDS)
    g = F.col("_g")
    one = F.when(record_size(g).isNotNull(), F.array(log_record(g, fields)))
    return (
        _groups(lines, line, keep, fields)
        .select(*keep, F.explode(one).alias("_r"))
        .select(*keep, *[F.col("_r")[f].alias(f) for f in fields])
    )


def tagged_log_lines(
    lines: DataFrame, line: str = "value", keep: list[str] | None = None,
    fields: list[str] | None = None, time: str | None = None,
) -> DataFrame:
    """One row a line, each line parsed once: ``keep``, ``record`` (a struct of
    ``fields``, NULL for a rejected line), ``value`` (the line, if rejected)
    and ``reason``: 'format' where the pattern does not match, 'size' where
    the size does not fit 64 bits, else NULL. With ``time``, a column of that
    name has the log's time, and a record whose time does not parse is
    rejected too, reason 'time'."""
    keep, fields = keep or [], list(fields or LOG_FIELDS)
    stamp = ["dateTimeString"] if time else []
    taken = fields + [f for f in stamp if f not in fields]
    g = F.col("_g")
    at = log_time(F.get(g, field_numbers(taken).index(4) + 1)) if time else None
    bad = F.when(g.isNull(), F.lit("format")).when(record_size(g).isNull(), F.lit("size"))
    if time:
        bad = bad.when(at.isNull(), F.lit("time"))
    row = [F.when(bad.isNull(), log_record(g, fields, taken)).alias("record"),
           F.when(bad.isNotNull(), F.col("_line")).alias("value"), bad.alias("reason")]
    if time:
        row.append(at.alias(time))
    # a generator, like parse_access_log: what reads the row does not parse again
    return _groups(lines, line, keep, taken).select(
        *keep, F.explode(F.array(F.struct(*row))).alias("_t")).select(*keep, "_t.*")


def rejected_log_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """The lines ``parse_access_log`` drops (quarantine output, column ``value``).

    The reference only printed them from the executors.
    """
    bad = record_size(F.col("_g")).isNull()
    one = F.when(bad, F.array(F.col("_line")))
    return _groups(lines, line, [], ["contentSize"]).select(F.explode(one).alias("value"))


def log_stats(logs: DataFrame) -> DataFrame:
    """One row: content-size sum, request count, truncated average, min, max."""
    return global_stats(logs, "contentSize", prefix="size_").withColumnRenamed(
        "size_count", "requests"
    )


def response_code_counts(logs: DataFrame) -> DataFrame:
    """Requests per response code: (responseCode, count)."""
    return count_by(logs, "responseCode", "count")


def response_code_total(logs: DataFrame) -> DataFrame:
    """Number of records with a response code (= parsed lines)."""
    return count_non_null(logs, "responseCode", "response_codes")


def ip_counts(logs: DataFrame) -> DataFrame:
    """Requests per IP address: (ipAddress, count)."""
    return count_by(logs, "ipAddress", "count")


def heavy_hitters(logs: DataFrame, threshold: int = 10) -> DataFrame:
    """IP addresses with strictly more than ``threshold`` requests."""
    return more_than(ip_counts(logs), "count", threshold)


def endpoint_counts(logs: DataFrame) -> DataFrame:
    """Requests per endpoint: (endpoint, count)."""
    return count_by(logs, "endpoint", "count")


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    """The k most requested endpoints, ties broken by endpoint ascending."""
    return top_k(endpoint_counts(logs), "count", k, "endpoint")


# --- SQL spellings (the reference ran the same questions as SQL on a view);
# the records are passed to the statement, so no view of the session changes

def sql_log_stats(spark: SparkSession, logs: DataFrame) -> DataFrame:
    """``log_stats`` written as SQL."""
    return spark.sql(
        "SELECT sum(contentSize) AS size_sum, count(*) AS requests, "
        "sum(contentSize) div count(*) AS size_avg, "
        "min(contentSize) AS size_min, max(contentSize) AS size_max FROM {logs}",
        logs=logs,
    )


def sql_response_code_total(spark: SparkSession, logs: DataFrame) -> DataFrame:
    """``response_code_total`` written as SQL."""
    return spark.sql("SELECT count(responseCode) AS response_codes FROM {logs}", logs=logs)


def sql_heavy_hitters(spark: SparkSession, logs: DataFrame, threshold: int = 10) -> DataFrame:
    """GROUP BY + HAVING on the select alias."""
    return spark.sql(
        "SELECT ipAddress, count(*) AS count FROM {logs} "
        f"GROUP BY ipAddress HAVING count > {int(threshold)}",
        logs=logs,
    )


def sql_top_endpoints(spark: SparkSession, logs: DataFrame, k: int = 10) -> DataFrame:
    """``top_endpoints`` written as SQL (ORDER BY count DESC, endpoint LIMIT k)."""
    return spark.sql(
        "SELECT endpoint, count(*) AS count FROM {logs} "
        f"GROUP BY endpoint ORDER BY count DESC, endpoint ASC LIMIT {int(k)}",
        logs=logs,
    )
