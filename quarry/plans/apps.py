"""Batch applications: files in, files out, in the original output formats.

Each function reads its inputs from paths, runs the operators and writes the
result with a distributed writer (``key<TAB>value`` text, ``[row]`` text or
JSON lines). Run from the command line with

    spark-submit -m quarry.plans.apps <job> <args...>   (or python -m ...)

Output folders must not exist unless ``--mode overwrite`` is given.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from quarry import sinks
from quarry.operators import words as W
from quarry.operators.filters import in_range
from quarry.plans import commerce as C
from quarry.plans.weblog import log_report
from quarry.sources import delimited as D
from quarry.sources import text as TXT


def distinct_locations(
    spark: SparkSession,
    transactions: str,
    users: str,
    out: str,
    mode: str = "errorifexists",
    on_unmatched: str = "error",
    debug_dir: str | None = None,
) -> str:
    """Per product, the number of distinct buyer locations: ``prod<TAB>n``."""
    t = D.read_transactions(spark, transactions, T.IntegerType())
    u = D.read_users(spark, users, T.IntegerType())
    result = C.product_distinct_locations(t, u, on_unmatched=on_unmatched, debug_dir=debug_dir)
    sinks.write_key_value_text(result, "prod_id", "locations", out, mode)
    return out


def purchase_by_gender(
    spark: SparkSession, transactions: str, users: str, out: str, mode: str = "errorifexists"
) -> str:
    """Total purchase amount per gender: ``gender<TAB>total``."""
    result = C.spend_by_group(D.read_users(spark, users), D.read_transactions(spark, transactions))
    sinks.write_key_value_text(result, "gender", "total_spend", out, mode)
    return out


def top_business_location(
    spark: SparkSession, transactions: str, users: str, out: str, mode: str = "errorifexists"
) -> str:
    """The location with the highest total purchase amount: ``location<TAB>total``."""
    result = C.top_location(D.read_users(spark, users), D.read_transactions(spark, transactions))
    sinks.write_key_value_text(result, "location", "total_spend", out, mode)
    return out


def frequent_words(
    spark: SparkSession, text: str, out: str, threshold: int = 4, mode: str = "errorifexists"
) -> str:
    """Words seen more than ``threshold`` times: ``word<TAB>count``."""
    words = W.tokens(TXT.read_lines(spark, text), "value")
    sinks.write_key_value_text(W.frequent_words(words, threshold), "word", "count", out, mode)
    return out


def people_in_age_range(
    spark: SparkSession,
    people: str,
    out: str,
    low: int = 22,
    high: int = 25,
    json_out: str | None = None,
    mode: str = "errorifexists",
) -> str:
    """Names of people aged ``low..high`` as ``[name]`` lines (and JSON lines)."""
    names = in_range(D.read_people(spark, people), "age", low, high).select("name")
    sinks.write_row_text(names, out, mode)
    if json_out:
        sinks.write_json(names, json_out, mode)
    return out


def text_file_to_json(spark: SparkSession, path: str, out: str, mode: str = "errorifexists") -> str:
    """``SELECT * FROM text.`path``` written as JSON lines (``{"value": line}``)."""
    sinks.write_json(TXT.sql_on_file(spark, path, "text"), out, mode)
    return out


def dynamic_people_names(
    spark: SparkSession, data: str, header: str, out: str, mode: str = "errorifexists"
) -> str:
    """The first header column of a CSV whose schema comes from a header file,
    as ``[value]`` lines."""
    df = D.read_with_header_file(spark, data, header)
    first = df.columns[0].replace("`", "``")
    sinks.write_row_text(spark.sql(f"SELECT `{first}` FROM {{people}}", people=df), out, mode)
    return out


def log_analysis(
    spark: SparkSession, logs: str, out_dir: str, threshold: int = 10, k: int = 10,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """All access-log reports of a log file/folder as parquet folders."""
    return log_report(TXT.read_lines(spark, logs), out_dir, threshold, k, mode)


# job -> (function, paths, options of the command line)
JOBS = {
    "distinct_locations": (distinct_locations, ["transactions", "users", "out"],
                           {"on_unmatched": str, "debug_dir": str}),
    "purchase_by_gender": (purchase_by_gender, ["transactions", "users", "out"], {}),
    "top_business_location": (top_business_location, ["transactions", "users", "out"], {}),
    "frequent_words": (frequent_words, ["text", "out"], {"threshold": int}),
    "people_in_age_range": (people_in_age_range, ["people", "out"],
                            {"low": int, "high": int, "json_out": str}),
    "text_file_to_json": (text_file_to_json, ["path", "out"], {}),
    "dynamic_people_names": (dynamic_people_names, ["data", "header", "out"], {}),
    "log_analysis": (log_analysis, ["logs", "out_dir"], {"threshold": int, "k": int}),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quarry.plans.apps")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("paths", nargs="+")
    parser.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    for option, kind in sorted({o: k for _, _, more in JOBS.values() for o, k in more.items()}.items()):
        parser.add_argument("--" + option.replace("_", "-"), type=kind, default=None)
    args = parser.parse_args(argv)
    fn, names, more = JOBS[args.job]
    if len(args.paths) != len(names):
        parser.error(f"{args.job} takes {len(names)} paths: {' '.join(names)}")
    given = {o: getattr(args, o) for o in {k for j in JOBS.values() for k in j[2]}
             if getattr(args, o) is not None}
    if set(given) - set(more):
        parser.error(f"{args.job} has no option {', '.join(sorted(set(given) - set(more)))}")
    from quarry.session import build_session

    spark = build_session(app_name=f"quarry-{args.job}")
    try:
        print(fn(spark, *args.paths, mode=args.mode, **given))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
