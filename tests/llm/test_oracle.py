"""Registered queries against their SQL on the smallest test tables."""

import pytest
from check_oracle import connect, difference
from llm.helpers import SF_DIR

from tidemark.llm.registry import ORACLE, QUERIES


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_rows(spark, key):
    assert difference(QUERIES[key](spark, SF_DIR), connect(SF_DIR), ORACLE[key]) is None
