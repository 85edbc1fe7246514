"""Every registered query gives the rows of its SQL."""

import re

import pytest

import __spark_entry__ as entry_module
from tests.compare import assert_same, duck
from tests.conftest import SMALL

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


# The optional training-text operators have tests of their own.
OWN = [n for n in QUERIES if not re.match(r"op\d+_|pipeline$", n)]


def test_same_names():
    assert set(ORACLES) <= set(QUERIES)
    assert [n for n in OWN if n not in ORACLES] == []


@pytest.mark.parametrize("name", [n for n in OWN if n in ORACLES])
def test_matches_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SMALL), con, ORACLES[name])


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_landing_follows_the_input(spark, tmp_path):
    """Changed input at the same path is landed again."""
    for rows in (500, 300):
        for name in ("orders", "lineitem"):
            table = spark.read.parquet(f"{SMALL}/{name}.parquet")
            key = "o_orderkey" if name == "orders" else "l_orderkey"
            table.where(f"{key} < {rows}").write.mode("overwrite").parquet(
                str(tmp_path / f"{name}.parquet")
            )
        lines = spark.read.parquet(str(tmp_path / "lineitem.parquet")).groupBy("l_orderkey").count()
        more = sum(-(-r["count"] // 10) - 1 for r in lines.collect())  # documents besides the first
        assert QUERIES["selected_payloads"](spark, str(tmp_path)).count() == rows + more
