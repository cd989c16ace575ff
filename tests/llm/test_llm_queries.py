"""Queries of the subpackage against their SQL."""

from pathlib import Path

import duckdb
import pytest
from check import compare

from tessera.llm.queries import CHECKS, QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, sf_dir, tables, name):
    assert compare(tables, QUERIES[name](spark, sf_dir), CHECKS[name]) is None
