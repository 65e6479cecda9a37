"""Two tables bucketed on their join key, for joins that are run again and again.

Both tables are dealt into the same number of buckets by the key when they are
written, so every later join on it reads bucket by bucket: its plan has no
exchange. That fixes which task a key's rows meet in, and Spark cannot split a
bucket. So keys of the right table that hold more than a bucket's share of its
rows (fewer keys than buckets) are kept apart, unbucketed, and join by an ordinary
shuffle, whose skewed partitions are split at run time. Rows without a key,
which join with nothing, are kept there too.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregates import count_by
from quarry.session import scratch_path


@dataclass
class BucketedPair:
    """``left`` and ``right`` are bucketed on their keys; ``hot_right`` holds
    the right rows kept apart, ``hot_left`` the left rows of their keys (None:
    there are none)."""

    left: DataFrame
    right: DataFrame
    left_key: str
    right_key: str
    hot_left: DataFrame | None
    hot_right: DataFrame | None
    tables: list[str]

    def join(self, how: str = "inner") -> DataFrame:
        """left JOIN right on the keys, 'inner' or 'right' (every right row)."""
        if how not in ("inner", "right"):
            raise ValueError("how must be 'inner' or 'right'")

        def on(left: DataFrame, right: DataFrame) -> DataFrame:
            return left.join(right, left[self.left_key] == right[self.right_key], how)

        near = on(self.left, self.right)
        return near if self.hot_right is None else near.unionByName(
            on(self.hot_left, self.hot_right))

    def drop(self) -> None:
        """Forget the tables' names (their files belong to the scratch folder)."""
        for t in self.tables:
            self.left.sparkSession.sql(f"DROP TABLE IF EXISTS {t}")


def _bucketed(df: DataFrame, key: str, buckets: int, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    table = f"quarry_{name}_{uuid.uuid4().hex}"
    # dealt as the buckets are, so a bucket is one file
    writer = df.repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", scratch_path(spark, f"bucketed-{name}")).format("parquet").saveAsTable(table)
    return spark.table(table), table


def bucket_together(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, buckets: int | None = None
) -> BucketedPair:
    """Write both tables bucketed on their keys, which must be of one type.
    ``buckets``: by default the session's number of shuffle partitions."""
    spark = left.sparkSession
    if left.schema[left_key].dataType != right.schema[right_key].dataType:
        raise TypeError(f"{left_key} and {right_key} must be of one type")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = count_by(right.select(right_key), right_key, "rows")
    path = scratch_path(spark, "bucketed-counts")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("rows")).first()[0] or 0
    key, n = F.col(right_key), F.col("rows")
    # at most `buckets` keys, and the null key
    hot = counts.where(key.isNull() | (n * buckets > total)).select(F.col(right_key).alias("_hot"))
    near, left_b = _bucketed(left, left_key, buckets, "left")
    if hot.isEmpty():
        far, right_b = _bucketed(right, right_key, buckets, "right")
        return BucketedPair(near, far, left_key, right_key, None, None, [left_b, right_b])
    same = F.col(right_key) == F.col("_hot")
    cold = right.where(key.isNotNull()).join(hot, same, "left_anti")
    far, right_b = _bucketed(cold, right_key, buckets, "right")
    apart = right.join(hot, F.col(right_key).eqNullSafe(F.col("_hot")), "left_semi")
    hot_path = scratch_path(spark, "bucketed-hot")
    apart.write.parquet(hot_path)
    hot_left = left.join(hot, F.col(left_key) == F.col("_hot"), "left_semi")
    return BucketedPair(near, far, left_key, right_key, hot_left,
                        spark.read.schema(apart.schema).parquet(hot_path), [left_b, right_b])
