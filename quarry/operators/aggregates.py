"""Grouped and global aggregations.

All are algebraic built-ins, so Spark plans them as a map-side partial
aggregate, a shuffle of one partial row per key and task, and a final merge.
A key that holds a third of all rows therefore costs one row per task in the
shuffle, not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key: str | list[str], name: str = "count") -> DataFrame:
    """Rows per key (the reference's ``mapToPair(x -> (x, 1)).reduceByKey(+)``)."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def more_than(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Strict threshold on an aggregate column (HAVING ``column > threshold``)."""
    return df.where(F.col(column) > F.lit(threshold))


def distinct_count_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Number of distinct ``value``s per ``key``, NULL counted as a value.

    distinct(key, value) then count per key: two partial+final aggregations,
    each shuffle carrying already de-duplicated pairs.
    """
    return df.select(key, value).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(name))


def distinct_count_small_domain(
    df: DataFrame, key: str, value: str, name: str, domain_size: int
) -> DataFrame:
    """Exact number of distinct ``value``s per ``key`` for integer values known
    to lie in ``[0, domain_size)``, ``domain_size <= 63`` (e.g. nation keys).

    Each value sets one bit; ``bit_or`` of the bits is algebraic, so Spark
    runs one partial aggregate and ONE shuffle of at most one row per task and
    key (``distinct_count_by`` needs two). NULL counts as a value (bit
    ``domain_size``). A value outside the domain fails the job rather than
    being miscounted.
    """
    if not 0 < domain_size <= 63:
        raise ValueError("domain_size must be in 1..63")
    v = F.col(value)
    bit = (
        F.when(v.isNull(), F.lit(domain_size))
        .when((v < 0) | (v >= domain_size),
              F.raise_error(F.lit(f"{value} outside [0, {domain_size})")).cast("int"))
        .otherwise(v.cast("int"))
    )
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return df.groupBy(key).agg(F.bit_count(F.bit_or(mask)).cast("bigint").alias(name))


def global_stats(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """sum, count(*), truncated mean (sum div count), min and max in one pass."""
    c = F.col(column)
    total = F.sum(c)
    n = F.count(F.lit(1))
    return df.agg(
        total.alias(f"{prefix}sum"),
        n.alias(f"{prefix}count"),
        # integer division truncating toward zero, as the reference's long /
        # long; NULL (not an error) on empty input.
        F.when(n > 0, F.expr(f"sum(`{column}`) div count(1)")).alias(f"{prefix}avg"),
        F.min(c).alias(f"{prefix}min"),
        F.max(c).alias(f"{prefix}max"),
    )


def count_non_null(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row: the number of non-NULL values of ``column``."""
    return df.agg(F.count(F.col(column)).alias(name))
