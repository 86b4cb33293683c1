"""Every query of the subpackage with SQL gives what the SQL gives."""

import pytest

from sievework.llm.registry import ORACLES, QUERIES
from tests.compare import rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    names, want = sql_rows(SF, ORACLES[name])
    assert sorted(df.columns) == names
    assert rows(df) == want


def test_all_ten_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
