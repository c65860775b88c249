"""Operators that SQL can express equal their DuckDB twins; the rest say so by having none."""
import pytest
from compare import compare, duck
from conftest import SF_ORACLE

from tidemark.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_oracle(spark, name):
    res = compare(catalog.QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), catalog.SQL[name])
    assert res["ok"], res


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and set(catalog.SQL) <= set(catalog.QUERIES)
