from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as E
from quarry.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.helpers import SF
from tests.test_entry import _bag

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = [int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES]
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    got = _bag([tuple(r) for r in df.collect()], df.columns)
    assert got == _bag(cur.fetchall(), columns) and got
