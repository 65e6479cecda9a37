"""File-format jobs: typed / runtime-schema CSV scans, SQL on files, sinks.

The reference read small hand-made text files. Here the inputs are written
by Spark from the given tables into the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), then read back, so every job scans files whose
size grows with the tables. All writes are distributed, one file per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry import sinks
from quarry.operators.filters import in_range
from quarry.plans import commerce as C
from quarry.session import scratch_path
from quarry.sources import delimited, text as text_src
from quarry.sources.tables import table

# Columns of the part table used as the runtime-schema CSV file.
PART_CSV_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
# Columns of the orders table used as the tab-separated transactions file.
ORDERS_TSV_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def _write_lines(df: DataFrame, line, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.select(line.alias("value")).write.text(path)
    return path


def people_file(spark: SparkSession, sf_dir: str) -> str:
    """``name, age`` lines (note the space before the age) from part."""
    part = table(spark, sf_dir, "part")
    line = F.concat(F.col("p_name"), F.lit(", "), F.col("p_size").cast("string"))
    return _write_lines(part, line, "people")


def part_csv_file(spark: SparkSession, sf_dir: str) -> str:
    """Part rows as plain CSV lines (no header)."""
    part = table(spark, sf_dir, "part")
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in PART_CSV_COLUMNS])
    return _write_lines(part, line, "part-csv")


def part_header_file(spark: SparkSession) -> str:
    """A one-line header file naming the part CSV columns."""
    header = scratch_path(spark, "part-header")
    spark.createDataFrame([(",".join(PART_CSV_COLUMNS),)], "value string").coalesce(1).write.text(
        header
    )
    return header


def orders_tsv_file(spark: SparkSession, sf_dir: str) -> str:
    orders = table(spark, sf_dir, "orders")
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ORDERS_TSV_COLUMNS])
    return _write_lines(orders, line, "orders-tsv")


def users_tsv_file(spark: SparkSession, sf_dir: str) -> str:
    """Customers as users: id, email, language, location (nation), age, gender
    (market segment). The e-mail is empty where the account is overdrawn."""
    c = table(spark, sf_dir, "customer")
    email = F.when(F.col("c_acctbal") < 0, "").otherwise(F.concat("c_name", F.lit("@example.com")))
    fields = [F.col("c_custkey").cast("string"), email, F.lit("EN"),
              F.col("c_nationkey").cast("string"), F.lit("30"), F.col("c_mktsegment")]
    return _write_lines(c, F.concat_ws("\t", *fields), "users-tsv")


def transactions_tsv_file(spark: SparkSession, sf_dir: str) -> str:
    """Orders as transactions: id, product (year and month of the order), user,
    amount in cents, description (the priority)."""
    o = table(spark, sf_dir, "orders")
    product = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    fields = [F.col("o_orderkey").cast("string"), product.cast("string"),
              F.col("o_custkey").cast("string"), cents.cast("string"), F.col("o_orderpriority")]
    return _write_lines(o, F.concat_ws("\t", *fields), "transactions-tsv")


def documents_file(spark: SparkSession, sf_dir: str) -> str:
    """Each document written as one text record (its lines become file lines)."""
    docs = table(spark, sf_dir, "documents")
    return _write_lines(docs, F.col("text"), "documents-text")


# --- jobs -------------------------------------------------------------------

def people_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as the reference's people relation (name, age)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), F.col("p_size").alias("age")
    )


def range_filter_tables(spark: SparkSession, sf_dir: str, low: int = 22, high: int = 25) -> DataFrame:
    """Names of people aged ``low..high``; the range reaches the parquet scan
    as pushed filters."""
    return in_range(people_view(spark, sf_dir), "age", low, high).select("name")


def labelled_tables(spark: SparkSession, sf_dir: str, prefix: str = "Name: ") -> DataFrame:
    """``"Name: " + name`` for every person in the age range (column ``label``)."""
    names = range_filter_tables(spark, sf_dir)
    return names.select(F.concat(F.lit(prefix), F.col("name")).alias("label"))


def sql_range_filter_tables(
    spark: SparkSession, sf_dir: str, low: int = 22, high: int = 25
) -> DataFrame:
    return spark.sql(
        f"SELECT name FROM {{people}} WHERE age BETWEEN {int(low)} AND {int(high)}",
        people=people_view(spark, sf_dir),
    )


def csv_typed_people_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.read_people(spark, people_file(spark, sf_dir))


def dynamic_schema_scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = delimited.read_with_header_file(
        spark, part_csv_file(spark, sf_dir), part_header_file(spark)
    )
    return spark.sql("SELECT * FROM {people}", people=df)


def positional_project_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line.split("\\t")[i]`` on raw TSV lines: (user_id, trans_id)."""
    lines = text_src.read_lines(spark, orders_tsv_file(spark, sf_dir))
    cols = delimited.positional_fields("value", "\t", {"user_id": 1, "trans_id": 0})
    return lines.select(*cols).select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("trans_id").cast("bigint").alias("trans_id"),
    )


def tsv_typed_scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    df = delimited.read_tsv(spark, orders_tsv_file(spark, sf_dir), schema)
    return df.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("trans_id"))


def _users_and_transactions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (delimited.read_users(spark, users_tsv_file(spark, sf_dir)),
            delimited.read_transactions(spark, transactions_tsv_file(spark, sf_dir)))


def tsv_distinct_locations_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct buyer locations per product, from the two TSV files."""
    users, txns = _users_and_transactions(spark, sf_dir)
    return C.product_distinct_locations(txns, users)


def tsv_spend_by_group_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total amount per gender, from the two TSV files."""
    users, txns = _users_and_transactions(spark, sf_dir)
    return C.spend_by_group(users, txns)


def tsv_top_location_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location of the highest total amount, from the two TSV files."""
    users, txns = _users_and_transactions(spark, sf_dir)
    return C.top_location(users, txns)


def stage_snapshots_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct-locations job with its stages written: the (product,
    location) pairs, read from the fourth of them."""
    users, txns = _users_and_transactions(spark, sf_dir)
    folder = scratch_path(spark, "stages")
    C.product_distinct_locations(txns, users, debug_dir=folder)
    return sinks.read_parquet(spark, f"{folder}/{C.STAGES[3]}")


def overwrite_sink_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is replaced by a second write: only the second is left."""
    out = scratch_path(spark, "overwrite-sink")
    sinks.write_parquet(people_view(spark, sf_dir).select("name"), out)
    sinks.write_parquet(range_filter_tables(spark, sf_dir), out, mode="overwrite")
    return sinks.read_parquet(spark, out)


def tsv_users_scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of the users file, empty ones kept."""
    return delimited.read_users(spark, users_tsv_file(spark, sf_dir))


def text_line_scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_src.read_lines(spark, documents_file(spark, sf_dir))


def sql_on_file_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_src.sql_on_file(spark, part_csv_file(spark, sf_dir), "text")


def json_sink_roundtrip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL on a text file, written as JSON lines, read back."""
    out = scratch_path(spark, "json-sink")
    sinks.write_json(sql_on_file_tables(spark, sf_dir), out)
    return sinks.read_json(spark, out, "value string")


def parquet_sink_roundtrip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "parquet-sink")
    sinks.write_parquet(range_filter_tables(spark, sf_dir), out)
    return sinks.read_parquet(spark, out)


def row_text_sink_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "row-text-sink")
    sinks.write_row_text(range_filter_tables(spark, sf_dir), out)
    return text_src.read_lines(spark, out)


def tsv_sink_roundtrip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts written as ``word<TAB>count`` lines and read back."""
    from quarry.plans.words import word_count_tables

    out = scratch_path(spark, "tsv-sink")
    sinks.write_key_value_text(word_count_tables(spark, sf_dir), "word", "count", out)
    return sinks.read_key_value_text(spark, out, "word", "count", "bigint")
