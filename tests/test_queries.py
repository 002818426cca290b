"""Every registered query against its SQL on the smallest driver tables."""

import os
import subprocess
import sys

import oracle
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    for module in contract.MODULES:
        if module.__name__.startswith("quire.plans"):
            assert module.QUERIES.keys() == module.SQL.keys()
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", SQL)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert oracle.compare(df, con, SQL[name]) is None
    assert con.execute(f"SELECT count(*) FROM ({SQL[name]})").fetchone()[0] > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_names_are_known_without_a_session():
    root = os.path.dirname(contract.__file__)
    told = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"],
        cwd=root, capture_output=True, text=True, timeout=120,
    )
    assert told.returncode == 0, told.stderr
    assert int(told.stdout) == len(QUERIES)
