"""Schema-on-read scans and sinks, with the reference's people rows."""

from __future__ import annotations

import json
import os

import pytest

from quarry import sinks
from quarry.operators.filters import in_range
from quarry.sources import delimited as D
from quarry.sources import text as TXT
from tests.conftest import rows

# fixed values: the people rows of the golden results
PEOPLE = "Rahul,32\nAmitav,24\nSagar,22\nGurpreet,25\nRimi, 25"  # no final newline


def test_people_csv_trims_age(spark, write_text):
    people = D.read_people(spark, write_text(PEOPLE))
    assert dict(people.dtypes) == {"name": "string", "age": "int"}
    assert ("Rimi", 25) in rows(people)


def test_range_filter_golden(spark, write_text):
    people = D.read_people(spark, write_text(PEOPLE))
    names = sorted(r.name for r in in_range(people, "age", 22, 25).collect())
    assert names == sorted(["Amitav", "Sagar", "Gurpreet", "Rimi"])


def test_range_filter_reaches_parquet_scan(spark, tmp_path):
    p = str(tmp_path / "people.parquet")
    spark.createDataFrame([("a", 22), ("b", 30)], "name string, age int").write.parquet(p)
    df = in_range(spark.read.parquet(p), "age", 22, 25).select("name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(age,22)" in plan
    assert rows(df) == [("a",)]


def test_header_file_schema(spark, write_text):
    header = write_text("  name,age \n", "header.txt")
    schema = D.header_schema(spark, header)
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("name", "string", True),
        ("age", "string", True),
    ]
    df = D.read_with_header_file(spark, write_text(PEOPLE), header)
    df.createOrReplaceTempView("people_t")
    got = sorted(r.name for r in spark.sql("SELECT name FROM people_t").collect())
    assert got == sorted(["Rahul", "Amitav", "Sagar", "Gurpreet", "Rimi"])
    # values are not trimmed
    assert ("Rimi", " 25") in rows(df)


def test_multi_line_header(spark, write_text):
    header = write_text("name,\n age\n", "h2.txt")
    assert [f.name for f in D.header_schema(spark, header)] == ["name", "age"]


def test_sql_on_file_to_json(spark, write_text, tmp_path):
    src = write_text(PEOPLE)
    df = TXT.sql_on_file(spark, src)
    out = str(tmp_path / "json")
    sinks.write_json(df, out)
    lines = []
    for f in sorted(os.listdir(out)):
        if f.startswith("part-"):
            lines += [json.loads(x) for x in open(os.path.join(out, f)).read().splitlines()]
    assert sorted(x["value"] for x in lines) == sorted(PEOPLE.split("\n"))
    back = sinks.read_json(spark, out, "value string")
    assert rows(back) == sorted((x,) for x in PEOPLE.split("\n"))


def test_tsv_sink_roundtrip_with_tab_in_key(spark, tmp_path):
    df = spark.createDataFrame([("M", 700), ("F", 600), ("a\tb", 1), ("", 2)], "k string, v bigint")
    out = str(tmp_path / "tsv")
    sinks.write_key_value_text(df, "k", "v", out)
    text = sorted(r.value for r in spark.read.text(out).collect())
    assert "M\t700" in text and "F\t600" in text
    back = sinks.read_key_value_text(spark, out, "k", "v")
    assert rows(back) == rows(df)


def test_row_text_and_parquet_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Amitav",), ("Rimi",)], "name string")
    out = str(tmp_path / "rows")
    sinks.write_row_text(df, out)
    assert rows(spark.read.text(out)) == [("[Amitav]",), ("[Rimi]",)]
    pq = str(tmp_path / "pq")
    sinks.write_parquet(df, pq)
    assert rows(sinks.read_parquet(spark, pq)) == rows(df)


def test_sink_refuses_existing_path_by_default(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "name string")
    out = str(tmp_path / "once")
    sinks.write_parquet(df, out)
    try:
        sinks.write_parquet(df, out)
        raised = False
    except Exception:  # noqa: BLE001
        raised = True
    assert raised
    sinks.write_parquet(df, out, mode="overwrite")


def test_positional_fields(spark):
    from quarry.sources.delimited import positional_fields

    df = spark.createDataFrame([("1\t7\t3\t300\tdesc",), ("9\t8",)], "value string")
    got = rows(df.select(*positional_fields("value", "\t", {"user": 2, "prod": 1})))
    assert got == [(None, "8"), ("3", "7")]


def test_cluster_conf_sizes_partitions():
    from quarry.session import cluster_conf

    tb = 1024**4
    c = cluster_conf(total_cores=8000, largest_shuffle_bytes=20 * tb)
    assert int(c["spark.sql.shuffle.partitions"]) == 81920  # 20 TB / 256 MB
    assert cluster_conf(8000, 1024**3)["spark.sql.shuffle.partitions"] == "24000"  # 3 waves
    assert cluster_conf(8000, 100 * tb)["spark.sql.shuffle.partitions"] == "100000"  # capped
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_empty_fields_are_kept(spark, write_text):
    r = D.read_users(spark, write_text("1\t\tEN\tUS\t30\tM")).first()
    assert (r.id, r.email, r.language, r.location, r.age, r.gender) == ("1", "", "EN", "US", 30, "M")
    header = write_text("a,b,c\n", "h3.txt")
    df = D.read_with_header_file(spark, write_text(",x y,\"q\""), header)
    assert rows(df) == [("", "x y", '"q"')]


@pytest.mark.parametrize("line", ["7\tx\t3\t5\td", "1\t99999999999\t3\t5\td", "1\t 7\t3\t5\td", "1"])
def test_malformed_rows(spark, write_text, line):
    path = write_text(f"1\t7\t3\t300\tgood\n{line}")
    with pytest.raises(Exception, match="malformed row"):
        D.read_transactions(spark, path).select("prod_id").collect()
    lenient = D.read_transactions(spark, path, on_malformed="null").select("prod_id")
    assert rows(lenient) == [(None,), (7,)]
    assert rows(D.malformed_lines(spark, path, D.TRANSACTIONS)) == [(line,)]
    with pytest.raises(ValueError):
        D.read_transactions(spark, path, on_malformed="skip")


def test_unused_fields_fail_nothing(spark, write_text):
    df = D.read_transactions(spark, write_text("x\t7\t3"))
    assert rows(df.select("prod_id", "user_id")) == [(7, "3")]


def test_amounts_beyond_int(spark, write_text):
    df = D.read_transactions(spark, write_text("1\t7\t3\t3000000000\td"))
    assert df.first().purchase_amt == 3_000_000_000


def test_people_without_an_age_fail(spark, write_text):
    with pytest.raises(Exception, match="malformed row"):
        D.read_people(spark, write_text("Ann,3\nBob")).collect()


def test_header_must_be_one_small_file(spark, write_text, tmp_path):
    big = write_text("x" * (D.MAX_HEADER_BYTES + 1), "big.txt")
    folder = tmp_path / "many"
    folder.mkdir()
    for n in "ab":
        (folder / f"{n}.txt").write_text("a,b")
    for path in (big, str(folder)):
        with pytest.raises(ValueError, match="not one header file"):
            D.header_schema(spark, path)
