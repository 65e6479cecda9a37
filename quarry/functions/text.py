"""Text column functions: line splitting, Java-compatible tokenising, predicates.

All are built-in Spark expressions (no UDF), so they run inside whole-stage
codegen and work unchanged on batch and streaming DataFrames.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line terminators recognised by Spark's text source (and Hadoop's line
# reader): CRLF, lone CR, lone LF. Alternation order matters: CRLF first.
LINE_BREAK = r"\r\n|\r|\n"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: str | Column) -> Column:
    """Lines of a text value, as if the value were one record of a text file.

    ``"a\\nb"`` -> ``[a, b]``; a trailing terminator yields a final empty line,
    which is what a text file gets when the value is written as one record.
    Text without CR (the common case) is split on the single character LF,
    which takes Java's non-regex split path.
    """
    c = _col(text)
    return F.when(c.contains("\r"), F.split(c, LINE_BREAK, -1)).otherwise(F.split(c, "\n", -1))


def java_split(value: str | Column, sep: str = " ") -> Column:
    """``String.split(sep)`` with Java's rules, for a literal separator.

    Leading and interior empty strings are kept, trailing ones are dropped;
    ``""`` gives ``[""]`` and a value made only of separators gives ``[]``.
    Spark's own ``split`` keeps trailing empties, hence the strip first.
    """
    c = _col(value)
    if sep == " ":
        # rtrim removes exactly the trailing spaces (ASCII 0x20 only).
        stripped = F.rtrim(c)
    else:
        # only a value that ends in a separator takes a regex
        trailing = F.regexp_replace(c, "(?:" + re.escape(sep) + r")+\z", "")
        stripped = F.when(c.endswith(sep), trailing).otherwise(c)
    return (
        F.when(c == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, re.escape(sep), -1))
    )


def is_hashtag(word: str | Column) -> Column:
    """Token starts with '#'."""
    return _col(word).startswith("#")


def mentions_any(text: str | Column, terms: list[str]) -> Column:
    """Case-insensitive 'text contains any of the terms' (keyword tracking)."""
    if not terms:
        raise ValueError("at least one term is required")
    low = F.lower(_col(text))
    return reduce(lambda a, b: a | b, [low.contains(t.lower()) for t in terms])
