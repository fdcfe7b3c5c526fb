"""Registered queries against their SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402
from compare import check, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(registry.queries())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert check(spark, con, registry.queries()[name], SQL[name], FOLDER) is None


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert rows and [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
