"""Distinct keys by words and by sketches, against plain sets."""

import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import initial_plan

from arenalake.operators import distinct
from arenalake.plans import marts

GROUP = ("w",)
NAMES = {"a": "as", "b": "bs"}
EDGES = [0, 1, -1, 63, 64, -63, -64, -65, 127, 128, 2**31, -(2**31), 2**63 - 1, -(2**63), None]


def counted(rows):
    groups = {}
    for w, a, b in rows:
        groups.setdefault(w, []).append((a, b))
    return sorted(
        (w, len(r), len({a for a, _ in r if a is not None}), len({b for _, b in r if b is not None})) for w, r in groups.items()
    )


def result(frame):
    return sorted((r.w, r.n, r["as"], r.bs) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(7)
    some = [(f"w{pick.randrange(3)}", pick.choice([None, pick.randrange(-300, 300)]), pick.randrange(-(2**63), 2**63)) for _ in range(2000)]
    return some + [("edges", k, k) for k in EDGES] * 2 + [("none", None, None)]


def test_counts_equal_sets(spark, rows):
    frame = spark.createDataFrame(rows, "w string, a bigint, b bigint")
    assert result(distinct.count_different(frame, GROUP, NAMES, "n")) == counted(rows)


def test_empty_table_has_no_groups(spark):
    frame = spark.createDataFrame([], "w string, a bigint, b bigint")
    assert distinct.count_different(frame, GROUP, NAMES, "n").count() == 0


def test_stored_words_merge_to_the_whole(spark, rows):
    parts = [spark.createDataFrame(rows[i::3], "w string, a bigint, b bigint") for i in range(3)]
    words = [distinct.key_words(p, GROUP, list(NAMES)) for p in parts]
    merged = distinct.merge_words(words[0].unionByName(words[1]).unionByName(words[2]), GROUP)
    assert result(distinct.counts_of_words(merged, GROUP, NAMES, "n")) == counted(rows)


def test_dense_keys_share_words(spark):
    frame = spark.range(6400).select(F.lit("w").alias("w"), F.col("id").alias("a"), F.lit(1).alias("b"))
    words = distinct.key_words(frame, GROUP, ["a", "b"])
    assert words.where("key_name = 'a'").count() == 100 and words.where("key_name = 'b'").count() == 1


def test_plan_expands_nothing(spark):
    schema = "recency_window string, account_id bigint, hero_id bigint"
    plan = initial_plan(marts.distinct_counts(spark.createDataFrame([("w", 1, 1)], schema)))
    assert "Expand" not in plan and "SortAggregate" not in plan


def test_sketches_merge_within_their_error(spark):
    frame = spark.range(60000).select(
        (F.col("id") % 7).cast("string").alias("w"), (F.col("id") % 20011).alias("a"), F.lit(None).cast("bigint").alias("b")
    )
    stored = distinct.key_sketches(frame, GROUP, ["a", "b"], 12)
    total = distinct.merge_sketches(stored.withColumn("all", F.lit(1)), ("all",), ["a", "b"])
    row = total.select(distinct.estimate("a").alias("a"), distinct.estimate("b").alias("b"), F.octet_length("a").alias("size")).first()
    assert abs(row.a - 20011) <= 20011 * distinct.sketch_error(12) and row.b == 0 and row.size <= 2**12 + 64
    again = distinct.merge_sketches(stored.unionByName(stored).withColumn("all", F.lit(1)), ("all",), ["a", "b"])
    assert again.select(distinct.estimate("a")).first()[0] == row.a
