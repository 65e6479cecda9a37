"""Access-log jobs over log lines derived from the events table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators import weblog as L
from quarry.operators.sketch import frequent_keys
from quarry.session import remove_folder, scratch_path
from quarry.sources.tables import log_lines

# Heavy-hitter threshold of the original jobs ("more than N = 10 times").
HEAVY_HITTER_THRESHOLD = 10
# Threshold of the registered queries: some hosts of the given tables pass it
# and some do not.
TABLE_THRESHOLD = 70


def logs_tables(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Records of the table's log lines; only ``fields``, if any are named."""
    return L.parse_access_log(log_lines(spark, sf_dir), fields=list(fields) or None)


def rejected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.rejected_log_lines(log_lines(spark, sf_dir))


def log_stats_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.log_stats(logs_tables(spark, sf_dir, "contentSize"))


def response_code_counts_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.response_code_counts(logs_tables(spark, sf_dir, "responseCode"))


def response_code_total_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.response_code_total(logs_tables(spark, sf_dir, "responseCode"))


def heavy_hitters_tables(
    spark: SparkSession, sf_dir: str, threshold: int = TABLE_THRESHOLD
) -> DataFrame:
    return L.heavy_hitters(logs_tables(spark, sf_dir, "ipAddress"), threshold)


def heavy_hitters_sketched_tables(
    spark: SparkSession, sf_dir: str, threshold: int = TABLE_THRESHOLD
) -> DataFrame:
    """``heavy_hitters`` with a count-min sketch in front of the exact count."""
    return frequent_keys(logs_tables(spark, sf_dir, "ipAddress"), "ipAddress", threshold)


def endpoint_counts_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.endpoint_counts(logs_tables(spark, sf_dir, "endpoint"))


def top_endpoints_tables(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    return L.top_endpoints(logs_tables(spark, sf_dir, "endpoint"), k)


def sql_log_stats_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.sql_log_stats(spark, logs_tables(spark, sf_dir, "contentSize"))


def sql_response_code_total_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.sql_response_code_total(spark, logs_tables(spark, sf_dir, "responseCode"))


def sql_having_tables(
    spark: SparkSession, sf_dir: str, threshold: int = TABLE_THRESHOLD
) -> DataFrame:
    return L.sql_heavy_hitters(spark, logs_tables(spark, sf_dir, "ipAddress"), threshold)


def sql_top_endpoints_tables(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    return L.sql_top_endpoints(spark, logs_tables(spark, sf_dir, "endpoint"), k)


def log_report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch report; its table of top endpoints."""
    out = scratch_path(spark, "log-report")
    paths = log_report(log_lines(spark, sf_dir), out)
    return spark.read.parquet(paths["top_endpoints"])


def log_report_stats_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch report; its stats, observed while the records were written."""
    out = scratch_path(spark, "log-report")
    paths = log_report(log_lines(spark, sf_dir), out)
    return spark.read.parquet(paths["log_stats"])


def _write_observed(parsed: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write the records, and the reports of the whole log that were observed
    on the way: they cost no scan of their own."""
    spark = parsed.sparkSession
    seen = Observation("log_report")
    # the expressions of the reports themselves
    size, code = F.col("contentSize"), F.col("responseCode")
    parsed.observe(
        seen, F.sum(size).alias("size_sum"), F.count(F.lit(1)).alias("requests"),
        F.min(size).alias("size_min"), F.max(size).alias("size_max"),
        F.count(code).alias("response_codes"),
    ).write.parquet(path)
    got = spark.createDataFrame([seen.get], (
        "size_sum bigint, requests bigint, size_min bigint, size_max bigint, "
        "response_codes bigint"))
    average = F.when(F.col("requests") > 0, F.expr("size_sum div requests")).alias("size_avg")
    return {
        "log_stats": got.select("size_sum", "requests", average, "size_min", "size_max"),
        "response_code_total": got.select("response_codes"),
    }


def log_report(
    lines: DataFrame,
    out_dir: str,
    threshold: int = HEAVY_HITTER_THRESHOLD,
    k: int = 10,
    mode: str = "errorifexists",
    materialize: str = "table",
) -> dict[str, str]:
    """The whole batch log analysis: parse once, then write every report under
    ``out_dir``. Returns report name -> folder.

    ``materialize='table'`` (default) writes the parsed records as a parquet
    table in the shared checkpoint folder and runs the reports on it. That
    cuts the lineage, so a lost executor costs nothing, and each grouped report
    reads only the column it needs. The reports of the whole log (stats, total
    of response codes) are observed while the table is written and read
    nothing. ``'cache'`` persists them in memory and local
    disk instead, like the original job's cache. The table is removed at the end.
    """
    if materialize not in ("table", "cache"):
        raise ValueError("materialize must be 'table' or 'cache'")
    spark = lines.sparkSession
    parsed = L.parse_access_log(lines)
    if materialize == "table":
        table_path = scratch_path(spark, "parsed-logs")
        totals = _write_observed(parsed, table_path)
        logs = spark.read.parquet(table_path)
    else:
        logs = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        totals = {"log_stats": L.log_stats(logs), "response_code_total": L.response_code_total(logs)}
    reports = {
        **totals,
        "response_code_counts": L.response_code_counts(logs),
        "heavy_hitters": L.heavy_hitters(logs, threshold),
        "top_endpoints": L.top_endpoints(logs, k),
    }
    paths = {}
    try:
        for name, df in reports.items():
            paths[name] = f"{out_dir.rstrip('/')}/{name}"
            df.write.mode(mode).parquet(paths[name])
    finally:
        if materialize == "cache":
            logs.unpersist()
        else:
            remove_folder(spark, table_path)
    return paths
