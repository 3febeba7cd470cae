"""The operators that SQL can express, against it."""

import pytest

from pageflow.llm import registry
from tests.compare import TABLES, assert_same, connection

SF = str(TABLES / "sf0.001")


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(llm, name):
    assert_same(registry.QUERIES[name](llm, SF), connection(SF), registry.SQL[name])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op")) == list(range(1, 14))
