"""The feed keeps every line of every order."""

import pytest
from pyspark.sql import functions as F

from arenalake.registry import queries
from arenalake.sources import feed
from tests.conftest import SMALL, initial_plan


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_every_line_is_a_player(spark, folder):
    players = feed.seats(spark, folder).select("l_orderkey", "document", F.explode("seats").alias("s"))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert players.count() == lines.count()
    of_players = players.groupBy("l_orderkey", F.col("s.hero").alias("hero"), F.col("s.part").alias("part")).count()
    of_lines = lines.groupBy("l_orderkey", F.col("l_suppkey").alias("hero"), F.col("l_partkey").alias("part")).count()
    assert of_players.exceptAll(of_lines).isEmpty() and of_lines.exceptAll(of_players).isEmpty()
    assert players.groupBy("l_orderkey", "document", "s.seat").count().where("count > 1").isEmpty()


def test_one_order_with_most_lines(spark, tmp_path):
    """Equal lines, an order of thousands of lines, orders without lines, and lines without an order."""
    line = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(1).drop("l_orderkey", "l_partkey")
    many = spark.range(3000).select(F.lit(1).cast("long").alias("l_orderkey"), (F.col("id") % 700).alias("l_partkey"))
    few = spark.createDataFrame([(2, 5), (2, 5), (9, 1)], "l_orderkey long, l_partkey long")
    rows = many.unionByName(few).crossJoin(F.broadcast(line))
    rows.select("l_orderkey", "l_partkey", *line.columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    order = spark.read.parquet(f"{SMALL}/orders.parquet").limit(1).drop("o_orderkey")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "o_orderkey long")
    keys.crossJoin(order).write.parquet(str(tmp_path / "orders.parquet"))

    found = feed.match_documents(spark, str(tmp_path)).where("loaded_at is not null").select("match_id", F.size("payload.players").alias("n"))
    sizes = {r["match_id"]: r["n"] for r in found.distinct().collect()}
    step = feed.DOCUMENT_STEP
    assert {k: n for k, n in sizes.items() if k % step == 1} == {1 + k * step: 10 for k in range(300)}
    assert sizes[2] == 2 and sizes[3] in (None, -1) and 9 not in sizes and len(sizes) == 302
    numbers = feed.numbered_lines(spark, str(tmp_path)).where("l_orderkey = 1").agg(F.countDistinct("number"), F.max("number")).first()
    assert tuple(numbers) == (3000, 2999)
    plan = feed.numbered_lines(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert all("part" in w for w in windows)  # each over the parts of an order, or within one


def odd_tables(spark, folder):
    """Orders of 1, 25 and no lines, one that comes twice, equal lines, lines without a part or an order."""
    line = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(1).drop("l_orderkey", "l_partkey")
    places = [(1, p % 9) for p in range(25)] + [(1, None)] * 12 + [(2, 7), (4, 3), (4, 3), (None, 1), (9, 1)] + [(5, None)] * 11
    rows = spark.createDataFrame(places, "l_orderkey long, l_partkey long").crossJoin(F.broadcast(line))
    rows.select("l_orderkey", "l_partkey", *line.columns).write.parquet(f"{folder}/lineitem.parquet")
    order = spark.read.parquet(f"{SMALL}/orders.parquet").limit(1).drop("o_orderkey")
    keys = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 4, 5, None)], "o_orderkey long")
    keys.crossJoin(order).select("o_orderkey", *order.columns).write.parquet(f"{folder}/orders.parquet")


def test_large_orders_give_the_same_documents(spark, tmp_path, monkeypatch):
    odd_tables(spark, tmp_path)

    def documents(largest):
        monkeypatch.setattr(feed, "LARGE_ORDER", largest)
        rows = feed.match_documents(spark, str(tmp_path)).select("match_id", F.to_json("payload").alias("p"))
        return sorted(map(tuple, rows.collect()))

    at_once = documents(1000)
    assert at_once == documents(10) == documents(0)
    players = {}
    for match, payload in at_once:
        players.setdefault(match, []).append(payload.count('"kills"'))
    step, copies = feed.DOCUMENT_STEP, len(players[2])
    # Lines without a part come first and hold places, but are no players; document 0 is always there.
    expected = {1: [0], 1 + step: [8], 1 + 2 * step: [10], 1 + 3 * step: [7], 2: [1], 3: [0], 4: [2, 2], 5: [0]}
    assert players == {k: v * copies for k, v in expected.items()}


def test_lines_are_shuffled_once(spark):
    plan = initial_plan(feed._seats(feed._numbered(spark, SMALL, "left_anti")))
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    # Lines by order, and the counts that tell large orders; documents of an order are built where its lines are.
    assert len(shuffles) == 2 and all("hashpartitioning(l_orderkey, " in x for x in shuffles)


def test_envelopes_land_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "LINES_PER_FILE", 100)
    odd = tmp_path / "odd"
    odd_tables(spark, odd)
    path = queries._envelope_files(spark, str(odd))
    names = spark.read.text(path).select(F.input_file_name()).distinct().collect()
    assert names and all(r[0].endswith(".gz") for r in names)
    assert spark.read.text(path).count() == feed.match_documents(spark, str(odd)).count()


def test_many_lines_get_more_tasks_than_shuffle_partitions(spark, tmp_path, monkeypatch):
    odd_tables(spark, tmp_path)

    def documents(lines):
        monkeypatch.setattr(feed, "TASK_LINES", lines)
        return feed.match_documents(spark, str(tmp_path)).select("match_id", F.to_json("payload").alias("p"))

    few = sorted(map(tuple, documents(10**9).collect()))
    assert sorted(map(tuple, documents(1).collect())) == few
    tasks = spark.read.parquet(f"{tmp_path}/lineitem.parquet").count()
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = initial_plan(feed._orders_with_seats(spark, str(tmp_path), "left_anti"))
    # Lines by order, once, and the orders that join them.
    assert plan.count(f"hashpartitioning(l_orderkey, {tasks})") + plan.count(f"hashpartitioning(o_orderkey, {tasks})") >= 1, plan
    assert len([x for x in plan.splitlines() if f", {tasks})" in x and "Exchange" in x]) == 2, plan
