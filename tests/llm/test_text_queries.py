"""The text queries over the test tables, against their statements where they have one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from compare import compare, connect  # noqa: E402

from stakeline.llm import catalog  # noqa: E402

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, name):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    problem, _ = compare(spark, connect(SF_DIR), name, SF_DIR, catalog.queries()[name], catalog.oracle_sql()[name])
    assert problem is None, problem
