from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def documents(name: str = "documents") -> list[dict]:
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "One two",
    "a b c d e f g h i j",
    "a b c d e f g h i j",  # a copy
    "x" * 5000,  # one long word
    "naïve café — dés 日本語 テキスト 한국어 emoji 🙂👩‍👩‍👧",
    "café ́e ẛ̣ Å İstanbul ΑΣ ΣΑΣ",
    "<|startoftext|>hi<|endoftext|> it's they'll 12 345",
    "tab\x0bvt\x0cff\x1cfs\x85nel nbsp ls　wide",
    "a\x00b null byte",
    "many words " * 3000,
    "## pipes | and || symbols ### $$$ %%% &&&",
]


def odd_documents(spark, extra: bool = True):
    """Odd texts with null ids, repeated rows and clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None, 7) for i, t in enumerate(ODD_TEXTS)]
    rows.append((None, "null id", "en", "s", 1))
    rows.append((3, "one", None, None, 7))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    df = spark.createDataFrame(rows, schema)
    if extra:
        for c in ("score", "n_tokens", "words", "sig", "block"):
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("clash"))
    return df


def empty_documents(spark):
    return spark.createDataFrame(
        [], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
