"""Equi-joins with an explicit policy for unmatched rows.

No join hints. Sessions built by ``quarry.session`` disable broadcasts from
plan estimates and let AQE convert a sort-merge join into a broadcast join
only when a side's *measured* shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the join stays
sort-merge, and AQE splits skewed partitions
(``spark.sql.adaptive.skewJoin.enabled``). So what is broadcast is always
size-checked, with sort-merge as the fallback.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMATCHED_POLICIES = ("error", "drop", "keep")
MATCH_FLAG = "_right_matched"


def flag_right(right: DataFrame) -> DataFrame:
    """Add a non-null marker so a left join can tell 'no partner' apart from
    'partner whose value is NULL'."""
    return right.withColumn(MATCH_FLAG, F.lit(True))


def require_match(df: DataFrame, checked: list[str], on_unmatched: str, what: str) -> DataFrame:
    """Apply the unmatched-row policy after a left join with a flagged right side.

    'error' fails the job on the first unmatched row (the reference calls
    ``Optional.get()`` on an absent value); the check is attached to the
    checked value columns themselves, so it cannot be pruned away while those
    values are used. 'drop' removes such rows (Catalyst then plans an inner
    join). 'keep' leaves NULLs.
    """
    if on_unmatched not in UNMATCHED_POLICIES:
        raise ValueError(f"on_unmatched must be one of {UNMATCHED_POLICIES}")
    flag = F.col(MATCH_FLAG)
    if on_unmatched == "drop":
        df = df.where(flag.isNotNull())
    elif on_unmatched == "error":
        fail = F.raise_error(F.lit(f"unmatched row: no {what} for a join key"))
        df = df.select(
            *[
                (F.when(flag.isNull(), fail).otherwise(F.col(c)).alias(c) if c in checked else F.col(c))
                for c in df.columns
            ]
        )
    return df.drop(MATCH_FLAG)


def left_join_checked(
    left: DataFrame,
    right: DataFrame,
    condition: Column | str | list[str],
    checked: list[str],
    on_unmatched: str = "error",
    what: str = "partner",
) -> DataFrame:
    """``left LEFT OUTER JOIN right`` then the unmatched-row policy."""
    joined = left.join(flag_right(right), condition, "left")
    return require_match(joined, checked, on_unmatched, what)


def inner_join(left: DataFrame, right: DataFrame, condition: Column | str | list[str]) -> DataFrame:
    """Plain inner equi-join (keys compared with their own type: string ids
    ``"01"`` and ``"1"`` do not match)."""
    return left.join(right, condition, "inner")
