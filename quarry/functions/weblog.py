"""Common-log-format parsing as column expressions.

One ``regexp_replace`` pass decides whether a line parses and packs the capture
groups that are asked for: a match is replaced by a newline and the groups,
each with a newline before it. A line of a text file holds no newline, so a
replaced line is told by its first character. That is one regex evaluation
per line, and it stays JVM-side.
``quarry.operators.weblog`` turns the groups into records.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the reference job's definitions -------------
# Access-log line pattern, anchored at the start only (a match may be followed
# by more text, e.g. the Combined-format referrer and agent).
# Groups: 1 ip, 2 client identd, 3 user id, 4 date-time, 5 method,
# 6 endpoint, 7 protocol, 8 response code, 9 content size.
LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+)'
# Field names of the parsed record, in group order.
LOG_FIELDS = (
    "ipAddress",
    "clientIdentd",
    "userID",
    "dateTimeString",
    "method",
    "endpoint",
    "protocol",
    "responseCode",
    "contentSize",
)
# ---------------------------------------------------------------------------

# Log time format; a single 'H' accepts one-digit hours such as 9:55:27.
LOG_TIME_FORMAT = "dd/MMM/yyyy:H:mm:ss Z"

def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def packed_groups(line: str | Column, numbers: list[int]) -> Column:
    """The line with a match replaced by the groups ``numbers``, a newline
    before each; NULL for a line that holds a newline itself."""
    c = _col(line)
    pack = "".join(f"\n${i}" for i in numbers)
    return F.when(~c.contains("\n"), F.regexp_replace(c, LOG_PATTERN + r"[\s\S]*", pack))


def matched_groups(packed: str | Column, line: str | Column, numbers: list[int]) -> Column:
    """array<string> of the groups of a matching line (after an empty first
    element), NULL for a line that does not match. ``packed``: the column of
    :func:`packed_groups`, made in a projection of its own.

    Groups never contain a newline unless the line itself does (text-file
    lines never do); such lines take the per-group extraction path.
    """
    p, c = _col(packed), _col(line)
    per_group = F.array(F.lit(""), *[F.regexp_extract(c, LOG_PATTERN, i) for i in numbers])
    return F.when(p.startswith("\n"), F.split(p, "\n")).when(
        c.contains("\n") & c.rlike(LOG_PATTERN), per_group)


def field_numbers(fields: list[str]) -> list[int]:
    """Groups to take for ``fields``; the size comes too, it decides validity."""
    wanted = {LOG_FIELDS.index(f) + 1 for f in fields}
    return sorted(wanted | {len(LOG_FIELDS)})


def log_record(groups: str | Column, fields: list[str], taken: list[str] | None = None) -> Column:
    """Typed record struct of ``fields`` from a groups array of the fields
    ``taken`` (by default the same)."""
    g, numbers = _col(groups), field_numbers(taken or fields)
    out = []
    for f in fields:
        text = F.get(g, numbers.index(LOG_FIELDS.index(f) + 1) + 1)
        kind = {"responseCode": "int", "contentSize": "bigint"}.get(f)
        out.append((text.try_cast(kind) if kind else text).alias(f))
    return F.struct(*out)


def record_size(groups: str | Column) -> Column:
    """Content size (the last group) of a groups array; NULL when it does not
    fit in 64 bits (the pattern's ``\\d+`` is unbounded), which makes the line
    malformed."""
    return F.element_at(_col(groups), -1).try_cast("bigint")


def log_time(date_time_string: str | Column) -> Column:
    """Parse the bracketed log time to a TIMESTAMP (NULL when malformed)."""
    return F.try_to_timestamp(_col(date_time_string), F.lit(LOG_TIME_FORMAT))
