"""Writers for the reference's output formats, with readers for round trips.

Writes are distributed (one file per task); no rows pass through the driver.
``mode`` follows ``DataFrameWriter``: 'errorifexists' is the reference's
default behaviour, 'overwrite' replaces its delete-then-write helper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_key_value_text(
    df: DataFrame, key: str, value: str, path: str, mode: str = "errorifexists"
) -> None:
    """``key<TAB>value`` lines, byte-compatible with Hadoop's TextOutputFormat.

    No quoting, like the original: a key may itself contain a tab, which
    ``read_key_value_text`` resolves by splitting on the *last* tab.
    """
    line = F.concat(
        F.coalesce(F.col(key).cast("string"), F.lit("null")),
        F.lit("\t"),
        F.coalesce(F.col(value).cast("string"), F.lit("null")),
    )
    df.select(line.alias("value")).write.mode(mode).text(path)


def read_key_value_text(
    spark: SparkSession,
    path: str,
    key: str = "key",
    value: str = "value",
    value_type: str = "bigint",
) -> DataFrame:
    """Read ``key<TAB>value`` lines back; the value holds no tab, so the key
    is everything before the last tab (no regex needed)."""
    line = F.col("value")
    val = F.substring_index(line, "\t", -1)
    k = F.substring(line, F.lit(1), F.length(line) - F.length(val) - 1)
    return spark.read.text(path).select(k.alias(key), val.cast(value_type).alias(value))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one object per row (NULL fields are omitted)."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_row_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as ``[v1,v2,...]`` text lines, the way ``Row.toString`` prints them."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    line = F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_stage_snapshot(df: DataFrame, debug_dir: str, stage: str) -> DataFrame:
    """Write a stage for debugging and return it as read back, so that later
    stages go on from the written rows."""
    path = f"{debug_dir.rstrip('/')}/{stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
