"""Exact money sums.

Summing doubles gives order-dependent last bits, so a distributed sum would
differ run to run and from any oracle. Integer amounts are summed as bigint
and decimals at their own scale. Doubles are summed as DECIMAL(38,10): ten
decimal places and amounts up to 10^28 are kept. Only the final value is turned back into a double.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FROM_DOUBLE = "decimal(38,10)"


def exact_sum(df: DataFrame, amount: str) -> Column:
    """Exact, order-independent sum of a column of ``df``."""
    kind = df.schema[amount].dataType
    if isinstance(kind, T.IntegralType):
        return F.sum(F.col(amount).cast("bigint"))
    if isinstance(kind, T.DecimalType):
        return F.sum(amount)
    return F.sum(F.col(amount).cast(FROM_DOUBLE))


def finished(df: DataFrame, amount: str, total: Column) -> Column:
    """``total`` in the type users expect: integers stay, all else is double."""
    integral = isinstance(df.schema[amount].dataType, T.IntegralType)
    return total if integral else total.cast("double")
