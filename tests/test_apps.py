"""Batch applications end to end: fixture files in, reference-format files out."""

from __future__ import annotations

import json
import os

import pytest

from quarry.plans import apps
from tests.test_commerce import TXNS, USERS  # fixed values, with the outputs expected below
from tests.test_files import PEOPLE


def lines_of(folder: str) -> list[str]:
    out = []
    for f in sorted(os.listdir(folder)):
        if f.startswith("part-"):
            with open(os.path.join(folder, f)) as fh:
                out += fh.read().splitlines()
    return sorted(out)


def test_distinct_locations_output(spark, write_text, tmp_path):
    out = apps.distinct_locations(spark, write_text(TXNS), write_text(USERS), str(tmp_path / "o"))
    assert lines_of(out) == ["1\t3", "2\t1"]


def test_purchase_by_gender_output(spark, write_text, tmp_path):
    out = apps.purchase_by_gender(spark, write_text(TXNS), write_text(USERS), str(tmp_path / "o"))
    assert lines_of(out) == ["F\t600", "M\t700"]


def test_top_business_location_output(spark, write_text, tmp_path):
    out = apps.top_business_location(spark, write_text(TXNS), write_text(USERS), str(tmp_path / "o"))
    assert lines_of(out) == ["GB\t600"]


def test_frequent_words_output(spark, write_text, tmp_path):
    text = "the cat the\nthe dog the  \nthe end\n"
    out = apps.frequent_words(spark, write_text(text), str(tmp_path / "o"), threshold=4)
    assert lines_of(out) == ["the\t5"]


def test_people_outputs(spark, write_text, tmp_path):
    out = apps.people_in_age_range(
        spark, write_text(PEOPLE), str(tmp_path / "rows"), json_out=str(tmp_path / "json")
    )
    assert lines_of(out) == sorted(["[Amitav]", "[Sagar]", "[Gurpreet]", "[Rimi]"])
    got = sorted(json.loads(x)["name"] for x in lines_of(str(tmp_path / "json")))
    assert got == sorted(["Amitav", "Sagar", "Gurpreet", "Rimi"])


def test_text_file_to_json(spark, write_text, tmp_path):
    out = apps.text_file_to_json(spark, write_text(PEOPLE), str(tmp_path / "o"))
    assert sorted(json.loads(x)["value"] for x in lines_of(out)) == sorted(PEOPLE.split("\n"))


def test_dynamic_people_names(spark, write_text, tmp_path):
    header = write_text("name,age\n", "header.txt")
    out = apps.dynamic_people_names(spark, write_text(PEOPLE), header, str(tmp_path / "o"))
    assert lines_of(out) == sorted(f"[{n}]" for n in ["Rahul", "Amitav", "Sagar", "Gurpreet", "Rimi"])


def test_log_analysis_with_crlf(spark, write_text, tmp_path):
    good = '10.0.0.1 - - [11/Nov/2020:10:05:49 -0800] "GET /a HTTP/1.1" 200 {}'
    text = "\r\n".join([good.format(i) for i in range(1, 13)] + ["bad line"]) + "\r\n"
    paths = apps.log_analysis(spark, write_text(text), str(tmp_path / "rep"))
    stats = spark.read.parquet(paths["log_stats"]).first()
    assert (stats.requests, stats.size_sum, stats.size_max) == (12, 78, 12)


def test_existing_output_is_refused_unless_overwrite(spark, write_text, tmp_path):
    out = str(tmp_path / "o")
    apps.top_business_location(spark, write_text(TXNS), write_text(USERS), out)
    with pytest.raises(Exception):
        apps.top_business_location(spark, write_text(TXNS), write_text(USERS), out)
    apps.top_business_location(spark, write_text(TXNS), write_text(USERS), out, mode="overwrite")
    assert lines_of(out) == ["GB\t600"]


def test_malformed_rows_fail_the_apps(spark, write_text, tmp_path):
    for n, row in enumerate(("6\t1\t1\tabc\tx", "6\t1\t1", "6\t1\t1\t99999999999999999999\tx")):
        with pytest.raises(Exception, match="malformed row"):
            apps.purchase_by_gender(spark, write_text(TXNS + "\n" + row), write_text(USERS),
                                    str(tmp_path / f"bad{n}"))


def test_cli_passes_options(monkeypatch, spark, write_text, tmp_path):
    import quarry.session

    class Kept:
        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(quarry.session, "build_session", lambda **k: Kept())
    out = str(tmp_path / "o")
    apps.main(["people_in_age_range", write_text(PEOPLE), out, "--low", "30", "--high", "40"])
    assert lines_of(out) == ["[Rahul]"]
    with pytest.raises(SystemExit):
        apps.main(["text_file_to_json", "a", "b", "--threshold", "3"])


def test_cli_rejects_wrong_arity():
    with pytest.raises(SystemExit):
        apps.main(["top_business_location", "only-one-path"])
