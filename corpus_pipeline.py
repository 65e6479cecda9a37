"""Corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. :func:`run` writes each stage's
result to the shared scratch folder and reads it as the next one's input.

1. quality: the rule ensemble is fitted on the stage's labelled rows; rejected
   documents go.
2. language: texts that no learned language explains, or without a letter, go.
3. near_duplicates: of every group linked by five-word shingles at a Jaccard
   likeness of 0.8 or more, one document stays, the one of smallest id; of
   several texts under that id in the group, the one of smallest hashes. Texts
   that share an id but not a group are documents of their own, so each
   group keeps one. A row without an id stays only if no row of its group has
   one, and then one row of the group. Of texts without words, which link with
   nothing, one row an id stays, and without an id one row a text. Among rows
   of equal id and text the one of smallest other columns stays.
4. packing: the remaining texts in sequences of at most 2048 tokens, one row
   per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import jaccard, language, quality
from quarry.llm.common import crc_mod, read, saved
from quarry.llm.queries import pack_documents

SHINGLE_WORDS = 5
LIKENESS_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    model = quality.fit_sample(docs, labels, crc_mod("doc_id", 4) != 2)
    score = model.score(F.col("statistics"))
    return quality.with_statistics(docs).where(score >= quality.KEEP).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.fit(docs, crc_mod("doc_id", 4) != 2))


def _one_row(rows: DataFrame, by: list, columns: list[str]) -> DataFrame:
    """Of the rows that are equal in ``by``, which have one text, the least in
    their other columns."""
    others = F.to_json(F.struct(F.lit(0).alias("-"), *(c for c in columns if c != "text")))
    return rows.groupBy(*by).agg(F.min_by(F.struct(*columns), others).alias("row")).select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = saved(jaccard.grouped(docs, SHINGLE_WORDS, LIKENESS_PERCENT), "groups")
    keyed = docs.select("*", *(c.alias(f"keep_{n}") for n, c in zip("hg", jaccard.text_key())))
    key = ["keep_h", "keep_g"]
    # each group's first text under its smallest id; empty sets by their own
    first = found.where(F.col("doc_id") == F.col("component_id"))
    single = F.when(F.col("group").isNull(), F.col("doc_id")).alias("single")
    keep = first.groupBy("group", single).agg(
        F.min("component_id").alias("keep_id"), F.min(F.struct("h", "g")).alias("least")
    ).select("keep_id", F.col("least.h").alias("keep_h"), F.col("least.g").alias("keep_g"))
    keep = saved(keep.distinct(), "kept")
    same = (F.col("doc_id").cast("bigint") == keep["keep_id"]) & (
        keyed["keep_h"] == keep["keep_h"]) & (keyed["keep_g"] == keep["keep_g"])
    named = _one_row(keyed.join(keep, same, "left_semi"),
                     [F.col("doc_id").cast("bigint"), *key], docs.columns)
    # no row of the group has an id: one text of it, or each of the empty sets
    alone = found.where("doc_id IS NULL AND component_id IS NULL")
    of = [F.col("group"), *(F.when(F.col("group").isNull(), F.col(c)) for c in "hg")]
    texts = alone.groupBy(*of).agg(F.min(F.struct("h", "g")).alias("least")).select(
        F.col("least.h").alias("keep_h"), F.col("least.g").alias("keep_g"))
    unnamed = _one_row(keyed.where(F.col("doc_id").isNull()).join(texts, key, "left_semi"),
                       [*key, F.col("text").isNull()], docs.columns)
    return named.unionByName(unnamed)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Trees, character models and packing are not expressible in SQL; the stages
# are tested against brute force.
ORACLE_SQL = None
