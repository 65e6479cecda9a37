"""Line-oriented text scans and SQL directly on files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as ``DataFrame[value: string]``, one row per line.

    Splits on LF, CRLF and CR; files are split into tasks by
    ``spark.sql.files.maxPartitionBytes``, so one large file is still read in
    parallel.
    """
    return spark.read.text(path)


def sql_on_file(spark: SparkSession, path: str, fmt: str = "text", columns: str = "*") -> DataFrame:
    """``SELECT <columns> FROM <fmt>.`path```: query a file with no table.

    The path goes inside back-quotes; a back-quote in the path is doubled.
    """
    if fmt not in {"text", "csv", "json", "parquet", "orc"}:
        raise ValueError(f"unsupported file format {fmt!r}")
    quoted = path.replace("`", "``")
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{quoted}`")
