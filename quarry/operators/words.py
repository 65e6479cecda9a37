"""Tokenising and counting words.

``explode`` is a generator inside whole-stage codegen; the count is a
partial + final aggregation, so a very frequent word ("the") costs one
shuffled row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import is_hashtag, java_split, split_lines
from quarry.operators.aggregates import count_by, more_than


def lines(df: DataFrame, text: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One row per line of a multi-line text column (column ``line``)."""
    keep = keep or []
    return df.select(*keep, F.explode(split_lines(text)).alias("line"))


def tokens(df: DataFrame, line: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One row per space-separated token of a line (column ``word``), Java
    split rules (trailing empties dropped)."""
    keep = keep or []
    return df.select(*keep, F.explode(java_split(line, " ")).alias("word"))


def document_tokens(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Tokens of whole documents: split into lines, then on spaces."""
    return tokens(lines(df, text, keep), "line", keep)


def word_count(words: DataFrame, word: str = "word") -> DataFrame:
    """(word, count) over a token column."""
    return count_by(words, word, "count")


def frequent_words(words: DataFrame, threshold: int = 4, word: str = "word") -> DataFrame:
    """Words seen strictly more than ``threshold`` times."""
    return more_than(word_count(words, word), "count", threshold)


def hashtags(words: DataFrame, word: str = "word") -> DataFrame:
    """Tokens that start with '#' (column ``hashtag``)."""
    return words.where(is_hashtag(word)).select(F.col(word).alias("hashtag"))
