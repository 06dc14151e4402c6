"""Every registered query against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

from registry import ORACLE, QUERIES

SF_DIR = os.environ.get("TABLELOAD_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.sql(f"create view {file.split('.')[0]} as select * from '{SF_DIR}/{file}'")
    return con


def normal(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def ordered(rows):
    return sorted((tuple(normal(v) for v in row) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    actual = df.select(*[f"`{c}`" for c in columns]).collect()
    assert actual, "no rows"
    wanted = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert ordered(actual) == ordered(wanted)


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert sorted((r["table"], r["difference"]) for r in rows) == [("nation", 0), ("orders", 0)]
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
