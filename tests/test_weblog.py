from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from quarry.functions.weblog import LOG_FIELDS, log_time
from quarry.operators import weblog as L
from quarry.session import scratch
from tests.conftest import conf, local_dir, rows

GOOD = '203.0.113.7 - - [02/Feb/2019:18:40:11 -0500] "GET /catalog/view/42 HTTP/1.1" 403 9731'
COMBINED = (
    '198.51.100.23 - dana [15/Aug/2021:06:07:08 +0200] "POST /form HTTP/1.0" 200 512 '
    '"http://ref.example/page" "Agent/1.0"'
)
ONE_DIGIT_HOUR = '192.0.2.9 - - [30/Jun/2022:7:08:09 +0100] "GET /index.html HTTP/1.1" 200 77'
DASH_SIZE = '10.0.0.2 - - [11/Nov/2020:10:06:51 -0800] "GET /x HTTP/1.1" 304 -'
TWO_TOKEN_REQUEST = '10.0.0.3 - - [11/Nov/2020:10:06:51 -0800] "GET /x" 200 10'
HUGE_SIZE = '10.0.0.4 - - [11/Nov/2020:10:06:51 -0800] "GET /x HTTP/1.1" 200 ' + "9" * 25


def lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value string")


def test_parse_fields(spark):
    df = L.parse_access_log(lines(spark, GOOD))
    assert df.columns == list(LOG_FIELDS)
    r = df.first()
    assert r.asDict() == {
        "ipAddress": "203.0.113.7",
        "clientIdentd": "-",
        "userID": "-",
        "dateTimeString": "02/Feb/2019:18:40:11 -0500",
        "method": "GET",
        "endpoint": "/catalog/view/42",
        "protocol": "HTTP/1.1",
        "responseCode": 403,
        "contentSize": 9731,
    }
    assert dict(df.dtypes)["responseCode"] == "int"
    assert dict(df.dtypes)["contentSize"] == "bigint"


@pytest.mark.parametrize(
    "line,ok",
    [
        (GOOD, True),
        (COMBINED, True),  # anchored at the start only: suffix accepted
        (ONE_DIGIT_HOUR, True),
        (DASH_SIZE, False),
        (TWO_TOKEN_REQUEST, False),
        ("", False),
        (HUGE_SIZE, False),  # size does not fit in 64 bits
        ("garbage " + GOOD, False),
    ],
)
def test_parse_or_reject(spark, line, ok):
    df = lines(spark, line)
    assert L.parse_access_log(df).count() == (1 if ok else 0)
    assert L.rejected_log_lines(df).count() == (0 if ok else 1)


def test_null_line_is_rejected(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert L.parse_access_log(df).count() == 0
    assert L.rejected_log_lines(df).count() == 1


def test_line_with_newline_takes_slow_path(spark):
    df = lines(spark, GOOD + "\ntrailing text")
    assert L.parse_access_log(df).first().contentSize == 9731


def test_combined_fields(spark):
    r = L.parse_access_log(lines(spark, COMBINED)).first()
    assert (r.userID, r.endpoint, r.contentSize) == ("dana", "/form", 512)


def test_log_time_one_digit_hour(spark):
    df = lines(spark, "30/Jun/2022:7:08:09 +0100", "bad")
    got = [r.t for r in df.select(F.unix_seconds(log_time("value")).alias("t")).collect()]
    assert got == [1656569289, None]  # 2022-06-30T06:08:09Z


def _sample(spark):
    ls = []
    # 12 requests from .1 (sizes 1..12), 3 from .2, one 404
    for i in range(1, 13):
        ls.append(f'10.0.0.1 - - [11/Nov/2020:10:05:{i:02d} -0800] "GET /a HTTP/1.1" 200 {i}')
    for e in ["/b", "/b", "/c"]:
        ls.append(f'10.0.0.2 - - [11/Nov/2020:10:06:00 -0800] "GET {e} HTTP/1.1" 401 5')
    ls.append('10.0.0.3 - - [11/Nov/2020:10:07:00 -0800] "GET /d HTTP/1.1" 404 0')
    ls.append(DASH_SIZE)
    return L.parse_access_log(lines(spark, *ls))


def test_stats_truncated_average(spark):
    s = L.log_stats(_sample(spark)).first()
    total = sum(range(1, 13)) + 15
    assert (s.size_sum, s.requests, s.size_avg, s.size_min, s.size_max) == (total, 16, total // 16, 0, 12)


def test_stats_empty_input(spark):
    s = L.log_stats(L.parse_access_log(lines(spark, DASH_SIZE))).first()
    assert (s.size_sum, s.requests, s.size_avg) == (None, 0, None)


def test_codes_hitters_endpoints(spark):
    logs = _sample(spark)
    assert rows(L.response_code_counts(logs)) == [(200, 12), (401, 3), (404, 1)]
    assert L.response_code_total(logs).first().response_codes == 16
    assert rows(L.heavy_hitters(logs, 10)) == [("10.0.0.1", 12)]
    assert L.heavy_hitters(logs, 12).count() == 0  # strictly more than
    top = [tuple(r) for r in L.top_endpoints(logs, 3).collect()]
    assert top == [("/a", 12), ("/b", 2), ("/c", 1)]  # '/c' beats '/d' on the tie


def test_sql_spellings_match(spark):
    logs = _sample(spark)
    assert rows(L.sql_log_stats(spark, logs)) == rows(L.log_stats(logs))
    assert rows(L.sql_heavy_hitters(spark, logs, 10)) == rows(L.heavy_hitters(logs, 10))
    assert rows(L.sql_top_endpoints(spark, logs, 3)) == rows(L.top_endpoints(logs, 3))
    assert rows(L.sql_response_code_total(spark, logs)) == rows(L.response_code_total(logs))


def test_only_the_wanted_fields(spark):
    df = L.parse_access_log(lines(spark, GOOD, HUGE_SIZE, DASH_SIZE), fields=["endpoint", "ipAddress"])
    assert df.columns == ["endpoint", "ipAddress"]
    assert rows(df) == [("/catalog/view/42", "203.0.113.7")]  # the size still decides validity


def test_sql_spellings_leave_views_alone(spark):
    spark.createDataFrame([(1,)], "mine int").createOrReplaceTempView("logs")
    L.sql_log_stats(spark, _sample(spark)).collect()
    assert spark.table("logs").columns == ["mine"]
    spark.catalog.dropTempView("logs")


def test_log_text_does_not_depend_on_the_session_zone(spark):
    from quarry.sources.tables import event_log_lines

    events = spark.sql(
        "SELECT 1L AS event_id, TIMESTAMP_NTZ '2024-03-10 02:30:05.75' AS ts, 300L AS user_id, "
        "'click' AS event_type, 1.5D AS value, '{\"k\": 7}' AS props")
    want = '10.0.1.44 - - [10/Mar/2024:02:30:05 +0000] "GET /click?k=7 HTTP/1.1" 200 150'
    for zone in ("UTC", "America/New_York"):
        with conf(spark, spark__sql__session__timeZone=zone):
            df = event_log_lines(events)
            assert df.first().value == want
            t = L.parse_access_log(df).select(F.unix_seconds(log_time("dateTimeString")))
            assert t.first()[0] == 1710037805


def test_log_report_writes_every_report(spark, tmp_path):
    from quarry.plans.weblog import log_report

    raw = _sample(spark)  # parsed; rebuild the raw lines for the job
    assert raw.count() == 16
    ls = []
    for i in range(1, 13):
        ls.append(f'10.0.0.1 - - [11/Nov/2020:10:05:{i:02d} -0800] "GET /a HTTP/1.1" 200 {i}')
    ls.append(DASH_SIZE)
    paths = log_report(lines(spark, *ls), str(tmp_path / "report"), threshold=10, k=1)
    cached = log_report(lines(spark, *ls), str(tmp_path / "report2"), threshold=10, k=1, materialize="cache")
    assert rows(spark.read.parquet(cached["top_endpoints"])) == [("/a", 12)]
    assert sorted(paths) == sorted(
        ["log_stats", "response_code_counts", "response_code_total", "heavy_hitters", "top_endpoints"]
    )
    assert rows(spark.read.parquet(paths["heavy_hitters"])) == [("10.0.0.1", 12)]
    assert rows(spark.read.parquet(paths["top_endpoints"])) == [("/a", 12)]
    assert spark.read.parquet(paths["log_stats"]).first().requests == 12
    with scratch(spark) as made:  # the parsed table is gone when the reports are written
        log_report(lines(spark, *ls), str(tmp_path / "report3"))
        assert made and not any(os.path.exists(local_dir(p)) for p in made)
