"""A third of all rows on one order, hero, customer: same rows as SQL, and plans that hold up."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.compare import assert_same, duck
from tests.conftest import SMALL, initial_plan, ranks_before_the_shuffle

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
HOT = 14
SKEWED = (
    "selected_payloads", "fct_match", "fct_player_match", "hero_meta_shift", "liveops_summary",
    "returning_players", "account_window_status", "manifest_union", "backfill_select",
    "envelope_build", "missing_payloads", "page_bounds", "player_snapshot", "dq_unique",
    "dq_relationships",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")

    def table(name):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")

    lines, orders = table("lineitem"), table("orders")
    hot_lines = lines.where("l_orderkey % 2 = 0").withColumn("l_orderkey", F.lit(HOT).cast("bigint"))
    hot_lines = hot_lines.withColumn("l_suppkey", F.lit(7).cast("bigint"))
    copies = F.sequence(F.lit(1), F.lit(750))
    hot_orders = orders.where(F.col("o_orderkey") == HOT).withColumn("n", F.explode(copies)).drop("n")
    tables = {
        "lineitem": lines.unionByName(hot_lines),
        "orders": orders.unionByName(hot_orders),
        "supplier": table("supplier"),
    }
    for name, rows in tables.items():
        rows.write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_hot_keys_match_sql(spark, skewed, name):
    assert_same(QUERIES[name](spark, skewed), duck(skewed), ORACLES[name])


def test_a_hot_order_is_a_bounded_document(spark, skewed):
    rows = QUERIES["selected_payloads"](spark, skewed)
    assert rows.agg(F.max("player_count")).first()[0] <= 10


RANKED = {"fct_match": "match_id", "selected_payloads": "match_id", "dim_heroes": "hero_id"}


@pytest.mark.parametrize("name,key", RANKED.items())
def test_hot_keys_shrink_before_the_shuffle(spark, name, key):
    from arenalake.registry.queries import _QUERIES

    assert ranks_before_the_shuffle(_QUERIES[name](spark, SMALL), key)


# Queries that write files while they are built have no plan of interest.
LAZY = [
    name for name in QUERIES
    if not name.startswith(
        ("validat", "export_", "backfill_", "stream_", "scan_manifest", "manifest_union")
    )
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, name):
    plan = initial_plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_segment_topk_keeps_k_rows_per_task(spark):
    assert "WindowGroupLimit" in initial_plan(QUERIES["segment_topk"](spark, SMALL))


def test_payload_reads_reach_the_scan(spark):
    """Only the payload keys that a query needs are read from the raw table."""
    plan = initial_plan(QUERIES["target_window_filter"](spark, SMALL))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    schema = scan.split("ReadSchema: ")[1]
    assert "array" not in schema


def test_marts_read_few_player_keys(spark):
    """The hero mart reads slot, hero and win of a player, and no match payload column but the id."""
    plan = initial_plan(QUERIES["hero_win_rate"](spark, SMALL))
    assert "win" in plan and "total_gold" not in plan and "leaver_status" not in plan
