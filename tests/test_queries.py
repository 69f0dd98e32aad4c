import pytest

import __spark_entry__ as entry
from compare import differences
from freshet.plans.catalog import QUERIES
from freshet.plans.oracles import ORACLES


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7 and sum(r.rows for r in rows) == 1500


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, name):
    assert differences(spark, name, "0.001") == []
