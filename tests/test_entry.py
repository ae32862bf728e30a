import duckdb
import pytest

import __spark_entry__ as entry_module
from tracelake.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def text(value):
    if value is None or value != value:
        return "NULL"
    return repr(round(float(value), 9)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_flagship(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_states_its_result():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = entry_module.queries()[name](spark, SF)
    want = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    found = got.collect()
    if not found:  # a query that gives nothing proves nothing: the next larger tables must hold something for it
        assert not entry_module.queries()[name](spark, SF.replace("0.001", "0.01")).isEmpty()
    assert normal([tuple(r) for r in found], got.columns) == normal(want.fetchall(), columns)
