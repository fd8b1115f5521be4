from __future__ import annotations

import pytest

from compare import SMALL, both
from lorebed.plans.oracle import ORACLE
from lorebed.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    ours, theirs = both(QUERIES[name](spark, SMALL), ORACLE[name])
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
