"""Hot keys: one key holding a third of all rows must not land in one task
as raw rows. Aggregations pre-aggregate per task; sort-merge joins are split
by AQE's skew handling (thresholds lowered here to test size)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators.aggregates import count_by, distinct_count_by
from quarry.operators.joins import inner_join, left_join_checked
from tests.conftest import conf


def _hot(spark, n=30000):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys.
    # The pad makes rows incompressible: skew is detected on shuffle bytes.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") % 7).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )


def _final_plan(df) -> str:
    # run the DataFrame's own query execution so AQE's final plan is shown
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_aggregates_are_partial_before_the_shuffle(spark):
    df = _hot(spark).repartition(8)
    counts = count_by(df, "k")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert dict((r.k, r["count"]) for r in counts.collect())[0] == 10000
    d = distinct_count_by(df, "k", "v", "n")
    assert dict((r.k, r.n) for r in d.collect())[0] == 7


def test_hot_join_key_is_split_by_aqe(spark):
    left = _hot(spark).repartition(8)
    right = spark.range(1001).select(F.col("id").alias("k2"), (F.col("id") * 10).alias("w"))
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        joined = inner_join(left, right, F.col("k") == F.col("k2"))
        plan = _final_plan(joined)
        assert "skew=true" in plan
        assert joined.where(F.col("k") == 0).count() == 10000
        outer = left_join_checked(left, right, F.col("k") == F.col("k2"), ["w"], "error")
        plan = _final_plan(outer)
        assert "skew=true" in plan
        assert outer.count() == 30000


def test_small_domain_distinct_count_matches_generic(spark):
    from quarry.operators.aggregates import distinct_count_small_domain

    df = _hot(spark).select("k", (F.col("v") * 3).alias("v"))  # values 0..18
    want = sorted(map(tuple, distinct_count_by(df, "k", "v", "n").collect()))
    got = sorted(map(tuple, distinct_count_small_domain(df, "k", "v", "n", 25).collect()))
    assert got == want


def test_small_domain_null_and_out_of_domain(spark):
    import pytest

    from quarry.operators.aggregates import distinct_count_small_domain

    df = spark.createDataFrame([(1, 0), (1, None), (1, 0), (2, 24)], "k int, v int")
    assert sorted(map(tuple, distinct_count_small_domain(df, "k", "v", "n", 25).collect())) == [(1, 2), (2, 1)]
    bad = spark.createDataFrame([(1, 25)], "k int, v int")
    with pytest.raises(Exception, match="outside"):
        distinct_count_small_domain(bad, "k", "v", "n", 25).collect()
    with pytest.raises(ValueError):
        distinct_count_small_domain(df, "k", "v", "n", 64)
