"""Every SQL-checked key equals its DuckDB oracle at sf0.01 (exact values)."""

import os

import pytest

os.environ.setdefault("STRICT", "1")

import __spark_entry__ as E  # noqa: E402
from scripts.check_oracle import compare  # noqa: E402
from tests.conftest import SF01  # noqa: E402

SQL_KEYS = sorted(E.oracle_sql())


def test_every_sql_key_is_a_query():
    assert set(SQL_KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", SQL_KEYS)
def test_key_matches_oracle(spark, duck01, key):
    info = compare(spark, duck01, key, E.queries()[key], E.oracle_sql()[key], SF01)
    assert info["ok"], info
