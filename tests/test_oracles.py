"""Every registered query against its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from adpulse.registry.oracles import ORACLES
from adpulse.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("events", "customer")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


SQL_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
}


def _sorted_rows(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, db, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    actual = _sorted_rows(tuple(row) for row in frame.select(*columns).collect())
    relation = db.sql(ORACLES[name])
    assert dict(zip(relation.columns, map(str, relation.types))) == {
        name: SQL_TYPE[kind] for name, kind in frame.dtypes
    }
    listed = ", ".join(f'"{column}"' for column in columns)
    expected = _sorted_rows(db.sql(f"SELECT {listed} FROM ({relation.sql_query()})").fetchall())
    assert actual, "no rows"
    assert not any(isinstance(v, float) and math.isnan(v) for row in actual for v in row)
    assert actual == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.count() > 0
    assert rows.columns[-1] == "impressions_per_click"
