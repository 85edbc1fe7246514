"""Queries of this package that SQL can express give the rows of their SQL."""

import pytest

from arenalake.llm.queries import llm_oracles, llm_queries
from tests.compare import assert_same, duck
from tests.conftest import SMALL


@pytest.mark.parametrize("name", list(llm_oracles()))
@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_matches_sql(spark, name, folder):
    assert_same(llm_queries()[name](spark, folder), duck(folder), llm_oracles()[name])


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in llm_queries()] == list(range(1, 14))
