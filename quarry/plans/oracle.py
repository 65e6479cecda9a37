"""DuckDB SQL that computes the same answer as each registered Spark query.

Used by the correctness check at sf0.01 (views for every table are
pre-registered). Column names and types are aligned with the Spark side:
counts BIGINT, money as DOUBLE after an exact DECIMAL(38,10) sum.
"""

from __future__ import annotations

# The access-log pattern, spelled out for DuckDB on its own: a wrong pattern on
# the Spark side shows.
_P = (
    r'^(\S+) (\S+) (\S+) \[([0-9A-Za-z_:/]+\s[-+][0-9]{4})\] "(\S+) (\S+) (\S+)" '
    r'([0-9]{3}) ([0-9]+)'
)

# Lines of every document (text-record semantics: LF / CRLF / CR).
_DOC_LINES = r"""
SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents
"""


def _java_tokens(col: str) -> str:
    """DuckDB spelling of Java ``split(" ")`` on ``col`` (a list of tokens)."""
    return (
        f"CASE WHEN {col} = '' THEN ['']"
        f" WHEN rtrim({col}, ' ') = '' THEN []::VARCHAR[]"
        f" ELSE string_split(rtrim({col}, ' '), ' ') END"
    )


_DOC_WORDS = f"""
WITH lines AS ({_DOC_LINES}),
words AS (SELECT unnest({_java_tokens('line')}) AS word FROM lines)
"""

# One synthesised access-log line per event (see sources.tables.event_log_lines).
_LOG_LINES = """
SELECT '10.0.' || CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR) || '.'
       || CAST(user_id % 256 AS VARCHAR)
       || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /'
       || event_type || '?k=' || json_extract_string(props, '$.k') || ' HTTP/1.1" '
       || CASE WHEN event_type = 'error' THEN '404'
               WHEN event_type = 'signup' THEN '401' ELSE '200' END
       || ' '
       || CASE WHEN event_id % 97 = 0 THEN '-'
               ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS value,
       ts
FROM events
"""

_LOGS = f"""
WITH lines AS ({_LOG_LINES}),
extracted AS (
  SELECT regexp_extract(value, '{_P}', 1) AS ipAddress,
         regexp_extract(value, '{_P}', 2) AS clientIdentd,
         regexp_extract(value, '{_P}', 3) AS userID,
         regexp_extract(value, '{_P}', 4) AS dateTimeString,
         regexp_extract(value, '{_P}', 5) AS method,
         regexp_extract(value, '{_P}', 6) AS endpoint,
         regexp_extract(value, '{_P}', 7) AS protocol,
         CAST(regexp_extract(value, '{_P}', 8) AS INTEGER) AS responseCode,
         TRY_CAST(regexp_extract(value, '{_P}', 9) AS BIGINT) AS contentSize,
         ts
  FROM lines WHERE regexp_matches(value, '{_P}')),
logs AS (SELECT * FROM extracted WHERE contentSize IS NOT NULL)
"""

_LOG_FIELDS = (
    "ipAddress, clientIdentd, userID, dateTimeString, method, endpoint, protocol, "
    "responseCode, contentSize"
)

_TXN_LOCATIONS = """
SELECT l.l_partkey, c.c_nationkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

_SPEND_BY_LOCATION = """
SELECT n.n_name AS location,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(38,10))) AS DOUBLE) AS total_spend
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
"""

_INNER_JOIN = """
SELECT c.c_custkey, c.c_mktsegment, o.o_orderkey, o.o_totalprice
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
"""

_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"

_WORD_COUNT = f"{_DOC_WORDS} SELECT word, count(*) AS count FROM words GROUP BY word"

_FREQUENT_WORDS = f"{_WORD_COUNT} HAVING count(*) > 4"

_RANGE = "SELECT p_name AS name FROM part WHERE p_size BETWEEN 22 AND 25"

_PART_CSV_LINE = (
    "SELECT concat_ws(',', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, "
    "CAST(p_size AS VARCHAR)) AS value FROM part"
)

_POSTS_HASHTAGS = f"""
WITH posts AS (SELECT 'user ' || CAST(user_id AS VARCHAR) || ' did #' || event_type AS value
               FROM events),
words AS (SELECT unnest({_java_tokens('value')}) AS word FROM posts)
SELECT word AS hashtag FROM words WHERE starts_with(word, '#')
"""

_LOG_STATS = f"""{_LOGS}
SELECT CAST(sum(contentSize) AS BIGINT) AS size_sum, count(*) AS requests,
       CAST(sum(contentSize) AS BIGINT) // count(*) AS size_avg,
       min(contentSize) AS size_min, max(contentSize) AS size_max
FROM logs
"""

_TOP_ENDPOINTS = f"""{_LOGS}
SELECT endpoint, count(*) AS count FROM logs GROUP BY endpoint
ORDER BY count DESC, endpoint ASC LIMIT 10
"""

_HEAVY_HITTERS = f"""{_LOGS}
SELECT ipAddress, count(*) AS count FROM logs GROUP BY ipAddress HAVING count(*) > 70
"""

_CODE_TOTAL = f"{_LOGS} SELECT count(responseCode) AS response_codes FROM logs"

# Windowed log report: 7 day windows sliding by 1 day on the log time.
# Window bounds are epoch seconds, so no time zone is involved. A record at
# time t lies in the 7 windows starting at floor_day(t) - i days, i = 0..6.
_WINDOWED_LOGS = f"""{_LOGS},
timed AS (
  SELECT *, CAST(epoch(strptime(dateTimeString, '%d/%b/%Y:%H:%M:%S %z')) AS BIGINT) AS t
  FROM logs),
windows AS (
  {" UNION ALL ".join(
      f"SELECT *, (t // 86400 - {i}) * 86400 AS window_start_epoch FROM timed" for i in range(7))})
"""

_WINDOW_STATS = f"""{_WINDOWED_LOGS}
SELECT window_start_epoch, window_start_epoch + 604800 AS window_end_epoch,
       CAST(sum(contentSize) AS BIGINT) AS size_sum, count(*) AS requests,
       CAST(sum(contentSize) AS BIGINT) // count(*) AS size_avg,
       min(contentSize) AS size_min, max(contentSize) AS size_max,
       count(responseCode) AS response_codes
FROM windows GROUP BY window_start_epoch"""

_WINDOW_TOP_ENDPOINTS = f"""{_WINDOWED_LOGS},
  counts AS (SELECT window_start_epoch, endpoint, count(*) AS count
       FROM windows GROUP BY window_start_epoch, endpoint),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY window_start_epoch
                                    ORDER BY count DESC, endpoint ASC) AS rank
       FROM counts)
  SELECT window_start_epoch, endpoint, count, CAST(rank AS INTEGER) AS rank
  FROM ranked WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {
    # users x transactions
    "product_distinct_locations": f"""
        SELECT l_partkey, count(DISTINCT c_nationkey) AS locations
        FROM ({_TXN_LOCATIONS}) GROUP BY l_partkey""",
    "left_join": _TXN_LOCATIONS,
    "left_join_keep": _TXN_LOCATIONS.replace(
        "JOIN customer c", "JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c"),
    "left_join_drop": _TXN_LOCATIONS.replace("LEFT JOIN customer c", "JOIN customer c")
    + " WHERE c.c_acctbal > 0",
    "distinct_pairs": f"SELECT DISTINCT * FROM ({_TXN_LOCATIONS})",
    "inner_join": _INNER_JOIN,
    "bucketed_join": _INNER_JOIN,
    "bucketed_reports": f"""
        WITH joined AS (SELECT c_mktsegment, c_nationkey, {_CENTS} AS cents,
                               year(o_orderdate) * 100 + month(o_orderdate) AS month
                        FROM customer JOIN orders ON c_custkey = o_custkey)
        SELECT 'segment' AS report, c_mktsegment AS item, CAST(sum(cents) AS BIGINT) AS value
        FROM joined GROUP BY c_mktsegment
        UNION ALL
        SELECT 'nation', CAST(c_nationkey AS VARCHAR), CAST(sum(cents) AS BIGINT)
        FROM joined GROUP BY c_nationkey
        UNION ALL
        SELECT 'nations', CAST(month AS VARCHAR), count(DISTINCT c_nationkey)
        FROM joined GROUP BY month""",
    "spend_by_group": """
        SELECT c.c_mktsegment,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(38,10))) AS DOUBLE) AS total_spend
        FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
        GROUP BY c.c_mktsegment""",
    "spend_by_location": _SPEND_BY_LOCATION,
    "top_location": f"""
        SELECT * FROM ({_SPEND_BY_LOCATION})
        ORDER BY total_spend DESC, location ASC LIMIT 1""",
    # words
    "word_count": _WORD_COUNT,
    "frequent_words": _FREQUENT_WORDS,
    "frequent_words_sketched": _FREQUENT_WORDS,
    "tokenize": f"""
        WITH lines AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line
                       FROM documents),
        words AS (SELECT doc_id, unnest({_java_tokens('line')}) AS word FROM lines)
        SELECT doc_id, count(*) AS tokens FROM words GROUP BY doc_id""",
    "token_positions": f"""
        WITH docs AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS ls
                      FROM documents),
        lines AS (SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no,
                         unnest(ls) AS line FROM docs),
        toks AS (SELECT doc_id, line_no, {_java_tokens('line')} AS ws FROM lines)
        SELECT doc_id, line_no, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS token_no,
               unnest(ws) AS word
        FROM toks""",
    "hashtags": _POSTS_HASHTAGS,
    "keyword_track_filter": """
        SELECT doc_id FROM documents
        WHERE contains(lower(text), 'password') OR contains(lower(text), 'license')""",
    # web log
    "parse_access_log": f"{_LOGS} SELECT {_LOG_FIELDS} FROM logs",
    "rejected_log_lines": f"""
        WITH lines AS ({_LOG_LINES})
        SELECT value FROM lines
        WHERE NOT coalesce(regexp_matches(value, '{_P}')
                  AND TRY_CAST(regexp_extract(value, '{_P}', 9) AS BIGINT) IS NOT NULL, false)""",
    "log_stats": _LOG_STATS,
    "sql_log_stats": _LOG_STATS,
    "response_code_counts": f"""{_LOGS}
        SELECT responseCode, count(*) AS count FROM logs GROUP BY responseCode""",
    "response_code_total": _CODE_TOTAL,
    "sql_response_code_total": _CODE_TOTAL,
    "heavy_hitters": _HEAVY_HITTERS,
    "heavy_hitters_sketched": _HEAVY_HITTERS,
    "sql_having": _HEAVY_HITTERS,
    "endpoint_counts": f"{_LOGS} SELECT endpoint, count(*) AS count FROM logs GROUP BY endpoint",
    "top_endpoints": _TOP_ENDPOINTS,
    "log_report": _TOP_ENDPOINTS,
    "log_report_stats": _LOG_STATS,
    "sql_top_endpoints": _TOP_ENDPOINTS,
    # people / files / sinks
    "range_filter": _RANGE,
    "sql_range_filter": _RANGE,
    "labelled_names": f"SELECT 'Name: ' || name AS label FROM ({_RANGE})",
    "csv_typed_people": "SELECT p_name AS name, p_size AS age FROM part",
    "dynamic_schema_scan": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
               CAST(p_size AS VARCHAR) AS p_size FROM part""",
    "positional_project": "SELECT o_custkey AS user_id, o_orderkey AS trans_id FROM orders",
    "tsv_typed_scan": "SELECT o_custkey AS user_id, o_orderkey AS trans_id FROM orders",
    "stage_snapshots": """
        SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS prod_id,
               CAST(c_nationkey AS VARCHAR) AS location
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "overwrite_sink": _RANGE,
    "tsv_users_scan": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               CASE WHEN c_acctbal < 0 THEN '' ELSE c_name || '@example.com' END AS email,
               'EN' AS language, CAST(c_nationkey AS VARCHAR) AS location, 30 AS age,
               c_mktsegment AS gender
        FROM customer""",
    "tsv_distinct_locations": """
        SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS prod_id,
               count(DISTINCT c_nationkey) AS locations
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "tsv_spend_by_group": f"""
        SELECT c_mktsegment AS gender, CAST(sum({_CENTS}) AS BIGINT) AS total_spend
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "tsv_top_location": f"""
        SELECT CAST(c_nationkey AS VARCHAR) AS location,
               CAST(sum({_CENTS}) AS BIGINT) AS total_spend
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    "text_line_scan": f"SELECT line AS value FROM ({_DOC_LINES})",
    "sql_on_file": _PART_CSV_LINE,
    "json_sink_roundtrip": _PART_CSV_LINE,
    "parquet_sink_roundtrip": _RANGE,
    "row_text_sink": "SELECT '[' || p_name || ']' AS value FROM part WHERE p_size BETWEEN 22 AND 25",
    "tsv_sink_roundtrip": _WORD_COUNT,
    # streams (results of the finished stream, read back as a table)
    "stream_word_count": _WORD_COUNT,
    "stream_word_count_batches": f"""
        WITH lines AS (SELECT coalesce(((doc_id % 4) + 4) % 4, 0) AS batch,
                              unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line
                       FROM documents),
        words AS (SELECT batch, unnest({_java_tokens('line')}) AS word FROM lines)
        SELECT batch, word, count(*) AS count FROM words GROUP BY batch, word""",
    "stream_hashtags": _POSTS_HASHTAGS,
    "stream_tracked_hashtags": _POSTS_HASHTAGS.replace(
        "FROM events),",
        "FROM events WHERE event_type LIKE 'signup%' OR event_type LIKE 'error%'),"),
    "stream_keyword_track": f"""
        SELECT line AS value FROM ({_DOC_LINES})
        WHERE contains(lower(line), 'password') OR contains(lower(line), 'license')""",
    "stream_running_stats": _LOG_STATS,
    "stream_log_windows": _WINDOW_STATS,
    "stream_compacted_windows": _WINDOW_STATS,
    "stream_window_heavy_hitters": f"""{_WINDOWED_LOGS}
        SELECT window_start_epoch, ipAddress, count(*) AS count
        FROM windows GROUP BY window_start_epoch, ipAddress HAVING count(*) > 10""",
    "stream_window_top_endpoints": _WINDOW_TOP_ENDPOINTS,
    "stream_closed_top_endpoints": _WINDOW_TOP_ENDPOINTS,
    "stream_rejected_lines": f"""
        WITH lines AS ({_LOG_LINES}),
        found AS (SELECT value, CASE WHEN NOT coalesce(regexp_matches(value, '{_P}'), false)
                                     THEN 'format'
                                     WHEN TRY_CAST(regexp_extract(value, '{_P}', 9) AS BIGINT)
                                          IS NULL THEN 'size' END AS reason FROM lines)
        SELECT value, reason FROM found WHERE reason IS NOT NULL""",
}
