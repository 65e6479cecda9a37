"""Word jobs on the documents table (and on posts derived from events).

A document is treated as one record of a text file: it is split into lines
on LF / CRLF / CR, then each line into tokens with Java ``split(" ")`` rules.
Whole texts are processed; nothing is truncated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import java_split, split_lines
from quarry.operators import words as W
from quarry.operators.filters import keyword_track
from quarry.operators.sketch import frequent_keys
from quarry.sources.tables import posts, spread, table

# Terms tracked by the keyword-filter job on the documents table.
TRACKED_TERMS = ["password", "license"]


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("text"))
    return W.document_tokens(docs, "text")


def word_count_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.word_count(document_words(spark, sf_dir))


def frequent_words_tables(spark: SparkSession, sf_dir: str, threshold: int = 4) -> DataFrame:
    return W.frequent_words(document_words(spark, sf_dir), threshold)


def frequent_words_sketched_tables(
    spark: SparkSession, sf_dir: str, threshold: int = 4
) -> DataFrame:
    """``frequent_words`` with a count-min sketch in front of the exact count."""
    return frequent_keys(document_words(spark, sf_dir), "word", threshold)


def tokens_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, tokens): how many tokens the tokenizer yields per document.

    Tokens are exploded and counted per doc_id (a partial + final aggregate),
    so even the largest document is not materialised as one array.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    toks = W.document_tokens(docs, "text", keep=["doc_id"])
    return toks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("tokens"))


def token_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token with its place: (doc_id, line_no, token_no, word), 0-based.

    ``posexplode`` twice (lines, then tokens), so the tokenizer's output is
    checked word by word and in order, not only as counts.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    lines = docs.select("doc_id", F.posexplode(split_lines("text")).alias("line_no", "line"))
    return lines.select(
        "doc_id", "line_no", F.posexplode(java_split("line", " ")).alias("token_no", "word")
    )


def hashtags_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hashtag token of the posts derived from events."""
    return W.hashtags(W.tokens(posts(spark, sf_dir), "value"))


def keyword_docs_tables(spark: SparkSession, sf_dir: str, terms: list[str] | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return keyword_track(docs, "text", terms or TRACKED_TERMS).select("doc_id")
