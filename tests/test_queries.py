"""Every core query with SQL gives what the SQL gives; the others give rows."""

import pytest

from sievework.plans.catalogue import ORACLES, QUERIES
from tests.compare import rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        names, want = sql_rows(SF, ORACLES[name])
        assert sorted(df.columns) == names
        assert rows(df) == want
    else:
        assert df.count() >= 0 and df.columns
