"""Top-k and arg-max with deterministic tie-breaks.

Every ordering adds the key ascending after the measure, so ties (common in
count data) resolve the same way on every run and on every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, tie_key: str | list[str]) -> DataFrame:
    """The k rows with the largest ``measure``.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its own
    k best rows and only k rows per task reach the final merge -- no full sort.
    """
    ties = [tie_key] if isinstance(tie_key, str) else tie_key
    return df.orderBy(F.col(measure).desc(), *[F.col(t).asc() for t in ties]).limit(k)


def arg_max(df: DataFrame, measure: str, tie_key: str | list[str]) -> DataFrame:
    """The row with the largest ``measure`` (0 rows on empty input)."""
    return top_k(df, measure, 1, tie_key)


def top_k_per_group(
    df: DataFrame,
    group: str | list[str],
    measure: str,
    k: int,
    tie_key: str | list[str],
    rank_name: str = "rank",
) -> DataFrame:
    """The k best rows of every group, with their 1-based rank.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each task forwards at most k rows per group: a hot group
    does not ship all of its rows to one task.
    """
    groups = [group] if isinstance(group, str) else group
    ties = [tie_key] if isinstance(tie_key, str) else tie_key
    w = Window.partitionBy(*groups).orderBy(F.col(measure).desc(), *[F.col(t).asc() for t in ties])
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)
