"""Ranks over a whole table equal those of a window, for ties, nulls and any number of ranges."""

import random

import pytest
from pyspark.sql import Window, functions as F

from arenalake.operators.ranking import global_rank

SCHEMA = "a int, b string, rank_of string"


def expected(rows, *order):
    window = Window.orderBy(*order)
    return rows.withColumns({"rank": F.rank().over(window).cast("long"), "dense_rank": F.dense_rank().over(window).cast("long")})


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_equals_a_window(spark, ranges):
    r = random.Random(ranges)
    rows = [(r.choice([None, *range(12)]), r.choice(["x", "y", None]), "extra") for _ in range(400)] + [(3, "x", "hot")] * 300
    frame = spark.createDataFrame(rows, SCHEMA)
    for order in ({"a": F.col("a").desc_nulls_last()}, {"a": F.col("a").asc_nulls_first(), "b": F.col("b").desc()}):
        found = global_rank(frame, order, ranges)
        want = expected(frame, *order.values())
        assert found.columns == want.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def test_no_window_over_the_whole_table(spark):
    frame = spark.createDataFrame([(1, "x", "")], SCHEMA)
    found = global_rank(frame, {"a": F.col("a").asc()})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and all("__range" in x for x in plan.splitlines() if "Window [" in x)
    assert global_rank(frame.where("false"), {"a": F.col("a").asc()}).count() == 0
