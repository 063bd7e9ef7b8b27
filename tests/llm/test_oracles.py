"""Queries that SQL can express, against that SQL over the same tables."""

import duckdb
import pytest

from adpulse.llm import registry

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", registry.ORACLES)
def test_matches_sql(spark, name):
    frame = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted(map(repr, (tuple(row) for row in frame.select(*columns).collect())))
    with duckdb.connect() as connection:
        for table in ("documents", "pages", "labels", "benchmark", "conversations"):
            connection.execute(
                f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')"
            )
        query = f"select {', '.join(columns)} from ({registry.ORACLES[name]})"
        expected = sorted(map(repr, connection.execute(query).fetchall()))
    assert got == expected
