"""Users x transactions analytics: distinct locations per product, spend per
group, top location.

The generic jobs take any users/transactions DataFrames (the reference's TSV
files, see ``quarry.sources.delimited``); the ``*_tables`` functions wire
them onto the TPC-H-like tables: product = ``l_partkey``, user =
``o_custkey``, location = nation, group = ``c_mktsegment``, amount =
``o_totalprice``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.money import exact_sum, finished
from quarry.operators.aggregates import distinct_count_by
from quarry.operators.joins import MATCH_FLAG, flag_right, left_join_checked, require_match
from quarry.operators.topk import arg_max
from quarry.sinks import write_stage_snapshot
from quarry.sources.bucketed import BucketedPair, bucket_together
from quarry.sources.tables import table

# --- fixed values: folder names of the stage snapshots, in order
STAGES = (
    "01_transactionPairs", "02_customerInputFile", "03_leftJoinOutput", "04_modifyData", "05_result",
)
# ---------------------------------------------------------------------------


# --- generic jobs -----------------------------------------------------------

def product_distinct_locations(
    txns: DataFrame,
    users: DataFrame,
    user_key: str = "user_id",
    product: str = "prod_id",
    users_key: str = "id",
    location: str = "location",
    on_unmatched: str = "error",
    debug_dir: str | None = None,
) -> DataFrame:
    """Per product, the number of distinct locations of the users who bought it.

    transactions LEFT JOIN users -> distinct (product, location) -> count per
    product. With the default policy an unmatched user fails the job, as in
    the reference; 'drop' ignores such rows, 'keep' counts NULL as a location.
    """
    # only distinct (user, product) pairs matter, so repeats stay out of the join
    t = txns.select(F.col(user_key).alias("_uk"), F.col(product).alias(product))
    u = users.select(F.col(users_key).alias("_ik"), F.col(location).alias(location))
    on = F.col("_uk") == F.col("_ik")
    if not debug_dir:
        joined = left_join_checked(t.distinct(), u, on, [location], on_unmatched, "user")
        return distinct_count_by(joined.select(product, location), product, location, "locations")
    # every stage is written once and the next one reads it back
    t = write_stage_snapshot(t, debug_dir, STAGES[0])
    write_stage_snapshot(users, debug_dir, STAGES[1])
    raw = t.distinct().join(flag_right(u), on, "left").select(product, location, MATCH_FLAG)
    raw = write_stage_snapshot(raw.distinct(), debug_dir, STAGES[2])
    pairs = require_match(raw, [location], on_unmatched, "user")
    pairs = write_stage_snapshot(pairs.select(product, location).distinct(), debug_dir, STAGES[3])
    return write_stage_snapshot(
        distinct_count_by(pairs, product, location, "locations"), debug_dir, STAGES[4]
    )


def spend_by_group(
    users: DataFrame,
    txns: DataFrame,
    group: str = "gender",
    users_key: str = "id",
    user_key: str = "user_id",
    amount: str = "purchase_amt",
    name: str = "total_spend",
) -> DataFrame:
    """Total amount spent per user attribute (users INNER JOIN transactions).

    Transactions are summed per user *before* the join (exact for sums over an
    inner join): the join then moves one row per user, and that side is already
    partitioned on the join key, so only the users side is shuffled.
    """
    per_user = txns.groupBy(F.col(user_key).alias("_uk")).agg(exact_sum(txns, amount).alias("_amt"))
    u = users.select(F.col(users_key).alias("_ik"), F.col(group).alias(group))
    joined = u.join(per_user, F.col("_ik") == F.col("_uk"), "inner")
    return joined.groupBy(group).agg(finished(txns, amount, F.sum("_amt")).alias(name))


def top_location(
    users: DataFrame,
    txns: DataFrame,
    location: str = "location",
    users_key: str = "id",
    user_key: str = "user_id",
    amount: str = "purchase_amt",
) -> DataFrame:
    """The location with the highest total spend (ties: smallest name)."""
    totals = spend_by_group(users, txns, location, users_key, user_key, amount, "total_spend")
    return arg_max(totals, "total_spend", location)


# --- the same jobs on the driver tables ------------------------------------


def left_join_tables(
    spark: SparkSession, sf_dir: str, on_unmatched: str = "error", users: DataFrame | None = None
) -> DataFrame:
    """Every line item with its buyer's location (nation key): (l_partkey, c_nationkey).
    ``users``: the customers to join, by default all.

    Join order is chosen for volume: orders (~1/4 of line items) meet the
    customers first, then the line items join that on the order key. Line
    items are shuffled once; joining them to orders first and then to
    customers would shuffle the line-item-sized result a second time. The
    unmatched check is applied after the line-item join, so only orders that
    are real transactions can fail it.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    users = table(spark, sf_dir, "customer") if users is None else users
    c = users.select("c_custkey", "c_nationkey")
    oc = o.join(flag_right(c), F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "o_orderkey", "c_nationkey", MATCH_FLAG
    )
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    joined = li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"), "inner").select(
        "l_partkey", "c_nationkey", MATCH_FLAG
    )
    return require_match(joined, ["c_nationkey"], on_unmatched, "customer")


def product_distinct_locations_tables(
    spark: SparkSession, sf_dir: str, on_unmatched: str = "error"
) -> DataFrame:
    """Distinct buyer nations per product, whatever the nation keys are."""
    pairs = left_join_tables(spark, sf_dir, on_unmatched)
    return distinct_count_by(pairs, "l_partkey", "c_nationkey", "locations")


def _buyers_in_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)


def left_join_keep_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the location of buyers in credit; NULL for other buyers."""
    return left_join_tables(spark, sf_dir, "keep", _buyers_in_credit(spark, sf_dir))


def left_join_drop_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of buyers in credit, with their location."""
    return left_join_tables(spark, sf_dir, "drop", _buyers_in_credit(spark, sf_dir))


def distinct_pairs_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (product, location) pairs."""
    return left_join_tables(spark, sf_dir).distinct()


def inner_join_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer INNER JOIN orders: (c_custkey, c_mktsegment, o_orderkey, o_totalprice)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "inner").select(
        "c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice"
    )


def spend_by_group_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_by_group(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "orders"),
        group="c_mktsegment",
        users_key="c_custkey",
        user_key="o_custkey",
        amount="o_totalprice",
    )


def spend_by_location_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total spend per nation name.

    Orders are summed per customer, then per nation key, and only the 25
    per-nation totals meet the nation table.
    """
    per_nation = spend_by_group(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "orders"),
        group="c_nationkey",
        users_key="c_custkey",
        user_key="o_custkey",
        amount="o_totalprice",
    )
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return per_nation.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("location"), "total_spend"
    )


def top_location_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arg_max(spend_by_location_tables(spark, sf_dir), "total_spend", "location")


# --- the same joins on tables bucketed by the user --------------------------


def bucketed_customers_and_orders(spark: SparkSession, sf_dir: str) -> BucketedPair:
    """Customers and orders, written once for any number of joins on the customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return bucket_together(c, o, "c_custkey", "o_custkey")


def bucketed_join_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``inner_join`` over bucketed tables: no exchange under the join."""
    pair = bucketed_customers_and_orders(spark, sf_dir)
    return pair.join().select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice")


def bucketed_reports_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three reports from joins of one bucketed pair: (report, item, value),
    the spend of each segment and each nation key in cents, and the distinct
    nations of the buyers of each month."""
    joined = bucketed_customers_and_orders(spark, sf_dir).join()
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")

    def spend(name: str, by: str) -> DataFrame:
        return joined.groupBy(F.col(by).cast("string").alias("item")).agg(
            F.sum(cents).alias("value")).select(F.lit(name).alias("report"), "item", "value")

    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("string")
    nations = distinct_count_by(joined.withColumn("item", month), "item", "c_nationkey", "value")
    return spend("segment", "c_mktsegment").unionByName(spend("nation", "c_nationkey")).unionByName(
        nations.select(F.lit("nations").alias("report"), "item", "value"))
