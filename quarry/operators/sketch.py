"""Thresholds over very many keys: a count-min sketch in front of the exact count.

``count_by`` followed by ``more_than`` shuffles a row for every key that a task
has seen, though few keys pass. Here the rows are first counted into a table
of ``hashes`` x ``width`` counters (a key adds to one counter of each of
``hashes`` rows, by its hash). A counter is at least the count of each of its
keys; so a key with a counter not over the threshold is surely under it, and
its rows stay out of the exact count. Keys that are left are counted exactly:
the result is the same for any size of the sketch.

The counters are an aggregate like any other: every task combines its rows
into ``hashes`` x ``width`` partial counters at most, and they are merged by
their number over all reducers. The counters over the threshold, at most
``width`` numbers a hash, are broadcast.

The input is read twice. That is worth it where most keys are rare and the
shuffle of keys costs more than another scan; ``width`` should be a few times
the number of keys over the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregates import count_by, more_than
from quarry.session import scratch_path

WIDTH = 1 << 18
HASHES = 2


def _counter(key: str, row: int, width: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), F.col(key)), F.lit(width)).cast("int")


def heavy_counters(
    df: DataFrame, key: str, threshold: int, width: int = WIDTH, hashes: int = HASHES
) -> DataFrame:
    """(row, counter) of the sketch's counters over ``threshold``; at most
    ``hashes`` x ``width`` rows."""
    cells = [F.struct(F.lit(r).alias("row"), _counter(key, r, width).alias("counter"))
             for r in range(hashes)]
    cell = df.select(F.explode(F.array(*cells)).alias("c"))
    return more_than(cell.groupBy("c.row", "c.counter").agg(F.count(F.lit(1)).alias("n")),
                     "n", threshold).select("row", "counter")


def maybe_over(
    df: DataFrame, key: str, threshold: int, width: int = WIDTH, hashes: int = HASHES
) -> DataFrame:
    """The rows of ``df`` without those of keys that occur ``threshold`` times
    or less for certain."""
    spark = df.sparkSession
    path = scratch_path(spark, "heavy-counters")
    heavy_counters(df, key, threshold, width, hashes).write.parquet(path)
    heavy = spark.read.schema("row int, counter int").parquet(path)
    for r in range(hashes):
        at_most_width = heavy.where(F.col("row") == r).select("counter")
        df = df.join(F.broadcast(at_most_width),
                     _counter(key, r, width) == F.col("counter"), "left_semi")
    return df


def frequent_keys(
    df: DataFrame, key: str, threshold: int, width: int = WIDTH, hashes: int = HASHES
) -> DataFrame:
    """(key, count) of the keys that occur more than ``threshold`` times."""
    return more_than(count_by(maybe_over(df, key, threshold, width, hashes), key, "count"),
                     "count", threshold)
