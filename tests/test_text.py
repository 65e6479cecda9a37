from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import java_split, mentions_any, split_lines
from quarry.operators import words as W
from tests.conftest import rows

# input -> tokens of Java's "…".split(" ")
SPACE_CASES = [
    ("a b ", ["a", "b"]),
    ("  a", ["", "", "a"]),
    ("", [""]),
    ("   ", []),
    ("a  b", ["a", "", "b"]),
    ("x\t ", ["x\t"]),
]


@pytest.mark.parametrize("value,expected", SPACE_CASES)
def test_java_split_space(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(java_split("v").alias("t")).first().t == expected


@pytest.mark.parametrize(
    "value,sep,expected",
    [
        ("a,b,,", ",", ["a", "b"]),
        (",,,", ",", []),
        (",a", ",", ["", "a"]),
        ("1\t2\t3", "\t", ["1", "2", "3"]),
        ("a.b", ".", ["a", "b"]),  # separator is literal, not a regex
        ("", ",", [""]),
    ],
)
def test_java_split_other_separators(spark, value, sep, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(java_split("v", sep).alias("t")).first().t == expected


def test_java_split_null_is_null(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(java_split("v").alias("t")).first().t is None


def test_split_lines_all_terminators(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd",), ("x\n",)], "v string")
    got = [r.t for r in df.select(split_lines("v").alias("t")).collect()]
    assert got == [["a", "b", "c", "d"], ["x", ""]]


def test_document_tokens_and_word_count(spark):
    docs = spark.createDataFrame(
        [(1, "the cat\nthe  dog "), (2, "cat")], "doc_id long, text string"
    )
    toks = W.document_tokens(docs, "text", keep=["doc_id"])
    assert rows(toks) == sorted(
        [(1, "the"), (1, "cat"), (1, "the"), (1, ""), (1, "dog"), (2, "cat")]
    )
    counts = dict((r.word, r["count"]) for r in W.word_count(toks).collect())
    assert counts == {"the": 2, "cat": 2, "": 1, "dog": 1}


def test_frequent_words_is_strict(spark):
    words = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4, "word string")
    assert rows(W.frequent_words(words, 4)) == [("a", 5)]


def test_case_sensitive_counts(spark):
    words = spark.createDataFrame([("The",), ("the",), ("the",)], "word string")
    assert rows(W.word_count(words)) == [("The", 1), ("the", 2)]


def test_hashtags(spark):
    posts = spark.createDataFrame(
        [("loving #spark and #data",), ("no tags here",), ("#",), ("a#b",)], "value string"
    )
    got = rows(W.hashtags(W.tokens(posts, "value")))
    assert got == [("#",), ("#data",), ("#spark",)]


def test_mentions_any_case_insensitive(spark):
    df = spark.createDataFrame([("My PassWord",), ("licensed",), ("nothing",)], "t string")
    got = [r.t for r in df.where(mentions_any("t", ["password", "License"])).collect()]
    assert sorted(got) == ["My PassWord", "licensed"]
    with pytest.raises(ValueError):
        mentions_any("t", [])


def test_tab_is_not_a_separator(spark):
    # a tab inside a word (the reference's word-count input has one) stays
    df = spark.createDataFrame([("foo\tbar baz",)], "v string")
    assert df.select(F.explode(java_split("v")).alias("w")).count() == 2
