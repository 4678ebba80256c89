"""Every registered catalogue query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__  # noqa: F401  (registers every plan)
from claimloom.plans import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, oracle, name):
    df = catalogue.QUERIES[name](spark, DIR)
    want = oracle.execute(catalogue.ORACLE_SQL[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in want.description], want.fetchall())
