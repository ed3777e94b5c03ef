"""Every named query against its check statement; SF_DIR chooses the data."""

import os
import subprocess
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402
from stakeline.plans import registry  # noqa: E402

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, STATEMENTS = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, name, SF_DIR, QUERIES[name], STATEMENTS.get(name))
    assert problem is None, problem


def test_every_inventory_id_is_registered():
    found = {name.split("_")[0] for name in QUERIES}
    sizes = {"S": 18, "K": 13, "P": 24, "J": 25, "A": 59, "W": 9, "T": 11, "U": 7, "X": 24, "V": 26, "Q": 17}
    assert {f"{letter}{i}" for letter, n in sizes.items() for i in range(1, n + 1)} - found == set()


def test_queries_and_statements_are_made_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]


def test_every_query_of_the_engine_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
