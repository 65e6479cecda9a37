"""The reference's join jobs on its own fixture rows (FIXTURES.md)."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from quarry.plans import commerce as C
from quarry.sources import delimited as D
from tests.conftest import rows

# fixed values: the golden rows
# (id, email, language, location, age, gender)
USERS = "1\ta@x\tEN\tUS\t25\tM\n2\tb@x\tEN\tGB\t27\tF\n3\tc@x\tFR\tFR\t39\tM"
# (trans_id, prod_id, user_id, purchase_amt, item_description)
TXNS = (
    "1\t1\t1\t300\ta jumper\n2\t1\t2\t300\ta jumper\n3\t1\t2\t300\ta jumper\n"
    "4\t2\t3\t100\ta rubber chicken\n5\t1\t3\t300\ta jumper"
)
# test fixture variant: users with only four columns
USERS_SHORT = "1\ta@x\tEN\tUS\n2\tb@x\tEN\tGB\n3\tc@x\tFR\tFR"


@pytest.fixture
def users(spark, write_text):
    return D.read_users(spark, write_text(USERS))


@pytest.fixture
def txns(spark, write_text):
    return D.read_transactions(spark, write_text(TXNS))


def test_product_distinct_locations_golden(spark, write_text):
    t = D.read_transactions(spark, write_text(TXNS), T.IntegerType())
    u = D.read_users(spark, write_text(USERS), T.IntegerType())
    assert rows(C.product_distinct_locations(t, u)) == [(1, 3), (2, 1)]


def test_product_distinct_locations_short_users(spark, write_text, txns):
    u = D.read_users(spark, write_text(USERS_SHORT))
    assert rows(C.product_distinct_locations(txns, u)) == [(1, 3), (2, 1)]


def test_debug_snapshot(spark, write_text, txns, users, tmp_path):
    out = C.product_distinct_locations(txns, users, debug_dir=str(tmp_path / "debug"))
    assert rows(out) == [(1, 3), (2, 1)]
    d = tmp_path / "debug"
    # with a flag that tells a missing partner from a missing location
    snap = spark.read.parquet(str(d / "03_leftJoinOutput")).select("prod_id", "location")
    assert rows(snap) == [(1, "FR"), (1, "GB"), (1, "US"), (2, "FR")]
    assert spark.read.parquet(str(d / "01_transactionPairs")).count() == 5
    assert spark.read.parquet(str(d / "02_customerInputFile")).count() == 3
    assert rows(spark.read.parquet(str(d / "04_modifyData"))) == rows(snap)
    assert rows(spark.read.parquet(str(d / "05_result"))) == [(1, 3), (2, 1)]


def test_unmatched_user_policies(spark, write_text, users):
    t = D.read_transactions(spark, write_text(TXNS + "\n6\t3\t9\t50\tghost"))
    with pytest.raises(Exception, match="unmatched row"):
        C.product_distinct_locations(t, users).collect()
    assert rows(C.product_distinct_locations(t, users, on_unmatched="drop")) == [(1, 3), (2, 1)]
    kept = C.product_distinct_locations(t, users, on_unmatched="keep")
    assert rows(kept) == [(1, 3), (2, 1), (3, 1)]
    with pytest.raises(ValueError):
        C.product_distinct_locations(t, users, on_unmatched="ignore")


def test_spend_by_gender_golden(users, txns):
    assert rows(C.spend_by_group(users, txns, "gender")) == [("F", 600), ("M", 700)]


def test_string_ids_do_not_match_padded(spark, write_text, users):
    t = D.read_transactions(spark, write_text("1\t1\t01\t300\tx"))
    assert C.spend_by_group(users, t, "gender").count() == 0


def test_top_location_golden(users, txns):
    assert rows(C.top_location(users, txns)) == [("GB", 600)]


def test_top_location_tie_and_empty(spark):
    u = spark.createDataFrame([("1", "B"), ("2", "A")], "id string, location string")
    t = spark.createDataFrame([("1", 5), ("2", 5)], "user_id string, purchase_amt int")
    assert rows(C.top_location(u, t)) == [("A", 5)]
    assert C.top_location(u, t.limit(0)).count() == 0


def test_small_and_large_amounts_are_kept(spark):
    u = spark.createDataFrame([("1", "g"), ("2", "h")], "id string, gender string")
    t = spark.createDataFrame([("1", 0.004)] * 3 + [("2", 1e17), ("2", 0.5)],
                              "user_id string, purchase_amt double")
    assert rows(C.spend_by_group(u, t, "gender")) == [("g", 0.012), ("h", 1e17 + 0.5)]
    d = t.selectExpr("user_id", "CAST(purchase_amt AS DECIMAL(24,6)) AS purchase_amt")
    assert rows(C.spend_by_group(u, d, "gender")) == [("g", 0.012), ("h", 1e17 + 0.5)]


def test_customer_outside_the_nation_table(spark, tmp_path):
    # nation holds keys 0..24, one buyer has key 90: it counts as a location
    import os
    import shutil

    src, d = "/root/testdata/sf0.001", str(tmp_path)
    for name in ("lineitem", "orders", "nation"):
        shutil.copy(f"{src}/{name}.parquet", f"{d}/{name}.parquet")
    c = spark.read.parquet(f"{src}/customer.parquet")
    odd = c.selectExpr("c_custkey", "c_name", "IF(c_custkey % 2 = 0, 90, c_nationkey) AS c_nationkey",
                       "c_acctbal", "c_mktsegment")
    odd.write.parquet(f"{d}/customer.parquet")
    assert os.path.isdir(f"{d}/customer.parquet")
    got = {r.l_partkey: r.locations for r in C.product_distinct_locations_tables(spark, d).collect()}
    want = C.left_join_tables(spark, d).distinct().groupBy("l_partkey").count()
    assert got == {r.l_partkey: r["count"] for r in want.collect()} and got


def test_money_sum_is_exact(spark):
    u = spark.createDataFrame([("1", "g")], "id string, gender string")
    t = spark.createDataFrame([("1", 0.1)] * 10, "user_id string, purchase_amt double")
    assert C.spend_by_group(u, t, "gender").first().total_spend == 1.0
