"""Every named query against its DuckDB oracle on the smallest driver tables."""
import os

import pytest

from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark):
    rep = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in rep.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    assert not bad, bad


def test_entry_smoke(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    df = entry(spark)
    assert df.columns == ["good_name", "sum_sale"] and df.count() > 0
    assert set(oracle_sql()) <= set(queries())
