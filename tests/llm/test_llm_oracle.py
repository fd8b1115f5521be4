from __future__ import annotations

import pytest

from compare import SMALL, both
from lorebed.llm.oracle import ORACLE
from lorebed.llm.queries import queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    ours, theirs = both(queries()[name](spark, SMALL), ORACLE[name])
    assert ours == theirs


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
