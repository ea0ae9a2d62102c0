"""Every registered query against its DuckDB text on sf0.001 (the driver
runs the same check at sf0.01)."""

import pytest

from __spark_entry__ import oracle_sql
from ledgerline.suite import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import sys
    sys.path.insert(0, "tools")
    from tools.parity import duck
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    from tools.parity import compare
    r = compare(spark, key, SF, con)
    assert r["status"] in ("ok", "rows-only"), r
    if key not in oracle_sql():
        assert r["spark_rows"] >= 0


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
