import duckdb
import pytest

import __spark_entry__ as driver
from tidewater import catalogue, stored

SF = "/root/testdata/sf0.001"
TABLES = "customer orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    try:
        return f"{float(v):.5f}"
    except (TypeError, ValueError):
        return str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_oracle(spark, oracle, name):
    df = catalogue.QUERIES[name](spark, SF)
    found = oracle.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, found.fetchall())


def test_stored_queries_are_in_the_catalogue():
    assert catalogue.QUERIES["table_versions"] is stored.table_versions


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
