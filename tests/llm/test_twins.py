"""Registered text queries against their DuckDB twins."""

import pytest
from check_oracle import compare, connect

from admesh.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_matches_duckdb(spark, name):
    ours, theirs = compare(spark, connect(FOLDER), FOLDER, name)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert ours[1]
