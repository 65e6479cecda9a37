"""Given parquet tables and the text inputs Spark derives from them.

The reference jobs read tab-separated users/transactions, a people CSV, a web
access log and posts. The driver's tables stand in for them; the log lines
and posts are built row by row from ``events`` with column expressions, so
their volume grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables of ``sf_dir``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session setting: the number of partitions that narrow inputs are dealt into
# before CPU-heavy per-row work. Unset, inputs are worked on as they are
# scanned, which is right wherever tables have many row groups.
INPUT_PARTITIONS = "spark.quarry.inputPartitions"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt into as many partitions as the session's
    ``spark.quarry.inputPartitions`` says; unchanged when that is not set."""
    n = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


# --- fixed values: English month names of the log's time stamps
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _log_stamp(ts: str) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` of a time without zone, field by field: the
    session's zone and its daylight-saving rules have no part in it."""
    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(ts))
    day = F.concat_ws("/", two(F.dayofmonth(ts)), month, F.lpad(F.year(ts).cast("string"), 4, "0"))
    second = F.floor(F.extract(F.lit("SECOND"), F.col(ts))).cast("int")
    clock = F.concat_ws(":", two(F.hour(ts)), two(F.minute(ts)), two(second))
    return F.concat_ws(":", day, clock)


def event_log_lines(events: DataFrame) -> DataFrame:
    """One access-log line per event (column ``value``) plus its ``ts``.

    ``10.0.<uid div 256>.<uid mod 256> - - [dd/MMM/yyyy:HH:mm:ss +0000]
    "GET /<event_type>?k=<props.k> HTTP/1.1" <code> <size>`` where code is
    404 for 'error', 401 for 'signup', else 200, and size is '-' (a line the
    parser must reject) when ``event_id % 97 = 0``, else round(value * 100).
    """
    uid = F.col("user_id")
    ip = F.concat_ws(
        ".", F.lit("10.0"), F.floor(uid / 256).cast("string"), (uid % 256).cast("string")
    )
    code = (
        F.when(F.col("event_type") == "error", F.lit("404"))
        .when(F.col("event_type") == "signup", F.lit("401"))
        .otherwise(F.lit("200"))
    )
    size = F.when(F.col("event_id") % 97 == 0, F.lit("-")).otherwise(
        F.round(F.col("value") * 100).cast("bigint").cast("string")
    )
    line = F.concat(
        ip,
        F.lit(" - - ["),
        _log_stamp("ts"),
        F.lit(' +0000] "GET /'),
        F.col("event_type"),
        F.lit("?k="),
        F.get_json_object(F.col("props"), "$.k"),
        F.lit(' HTTP/1.1" '),
        code,
        F.lit(" "),
        size,
    )
    return events.select(line.alias("value"), F.col("ts"))


def event_posts(events: DataFrame) -> DataFrame:
    """One short post per event: ``user <user_id> did #<event_type>``."""
    post = F.concat(
        F.lit("user "), F.col("user_id").cast("string"), F.lit(" did #"), F.col("event_type")
    )
    return events.select(post.alias("value"), F.col("ts"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of all events, spread for the regex work that follows."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    return event_log_lines(spread(events)).select("value")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of all events (cheap to tokenise: not spread)."""
    return event_posts(table(spark, sf_dir, "events")).select("value")
