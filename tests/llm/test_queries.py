"""The registered queries against their SQL on the smallest driver tables."""

import os

import pytest

from ledgerlake.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    rep = compare(spark, SF, names=[name], verbose=False)
    assert rep[name].startswith("OK"), rep


def test_one_query_an_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
