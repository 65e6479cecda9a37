"""Row filters. Written as plain comparisons so Catalyst can push them into
the parquet scan (``PushedFilters``) and skip row groups by their min/max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import mentions_any


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Closed range ``low <= column <= high``."""
    c = F.col(column)
    return df.where((c >= F.lit(low)) & (c <= F.lit(high)))


def keyword_track(df: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """Rows whose text mentions any of the terms, case-insensitively.

    The reference delegated this matching to a remote service; the
    any-of / case-insensitive substring rule is this package's definition.
    """
    return df.where(mentions_any(text, terms))
