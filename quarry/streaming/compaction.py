"""Compaction of the output of long-running streams.

A stream that triggers every 2 s leaves some 43,200 batches of small files a
day. Windowed reports are therefore written in a folder for each day
(``partition_by`` of ``start_to_files``), and the files of days that can get no
more rows are rewritten into a few:

* :func:`compact_days` reads the days through the file sink's own log, so only
  committed files count, and moves each rewritten day into the compacted folder
  at once. The sink's files and log stay as they are: the running stream and
  streams that read from it do not notice.
* :func:`read_days` reads compacted days from there and all others through
  the log. The day is a partition, so files of compacted days are not opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import folder_exists, list_folder, move_folder, remove_folder, scratch_path

DAY = "day"
TARGET_BYTES = 256 << 20  # of a compacted file, about


def with_day(df: DataFrame, epoch: str = "window_start_epoch") -> DataFrame:
    """``df`` with the UTC day of its epoch seconds, to partition by."""
    days = F.floor(F.col(epoch) / 86400).cast("int")
    return df.withColumn(DAY, F.date_from_unix_date(days))


def compacted_days(spark: SparkSession, compacted_dir: str) -> list[dt.date]:
    """The days that have been compacted, oldest first."""
    if not folder_exists(spark, compacted_dir):
        return []
    found = (path.rpartition("=")[2] for path, _ in list_folder(spark, compacted_dir))
    return sorted(dt.date.fromisoformat(d) for d in found)


def compact_days(spark: SparkSession, out_dir: str, compacted_dir: str, before: dt.date) -> list[dt.date]:
    """Compact every day of the sink's table before ``before`` that is not yet;
    returns them. ``before`` must not be later than the stream's watermark: a
    day gets no more rows once its windows have closed. A run that fails
    leaves finished days in place, and the next one does the rest."""
    base = compacted_dir.rstrip("/")
    done = compacted_days(spark, base)
    live = spark.read.parquet(out_dir)
    todo = [r[0] for r in live.where(F.col(DAY) < F.lit(before)).select(DAY).distinct()
            .orderBy(DAY).collect() if r[0] not in done]
    if not todo:
        return []
    sizes = {p.rpartition("=")[2]: n for p, n in list_folder(spark, out_dir)}
    files = max(1, -(-max(sizes.get(str(d), 0) for d in todo) // TARGET_BYTES))
    aside = scratch_path(spark, "compacted")
    # a day's rows are dealt to `files` tasks, whatever its share of the rows
    rows = live.where(F.col(DAY).isin(todo)).withColumn("_file", F.floor(F.rand(0) * files))
    rows.repartition(F.col(DAY), F.col("_file")).drop("_file").write.partitionBy(DAY).parquet(aside)
    for path, _ in list_folder(spark, aside):
        move_folder(spark, path, f"{base}/{path.rpartition('/')[2]}")
    remove_folder(spark, aside)
    return todo


def read_days(spark: SparkSession, out_dir: str, compacted_dir: str) -> DataFrame:
    """All committed rows, compacted days from ``compacted_dir``."""
    live = spark.read.parquet(out_dir)
    done = compacted_days(spark, compacted_dir)
    if not done:
        return live
    packed = spark.read.schema(live.schema).parquet(compacted_dir)
    # only what was listed: a day that is moved in meanwhile is still read live
    return live.where(~F.col(DAY).isin(done)).unionByName(packed.where(F.col(DAY).isin(done)))
