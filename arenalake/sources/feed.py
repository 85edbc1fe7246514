"""A telemetry feed derived from the order tables, in the shapes that the API and the loader use.

Each line of an order is a player. Ten lines make a match, so an order of many lines becomes several
documents, which differ in their id and their players; an order without lines is a match without players. Dates move
forward by 9,497 days so that all windows occur. Some keys are absent, some labels null and some matches come twice: the
pipeline has to cope with such records.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from arenalake.functions.windows import epoch_to_ntz, recency_window
from arenalake.sources.tables import read_table

SHIFT_SECONDS = 9497 * 86400
SEATS = 10
#: Ids of an order's second, third, ... document are this far apart.
DOCUMENT_STEP = 1 << 40
#: Lines of an order are numbered in so many parts, so that no task has all lines of a large order.
LINE_PARTS = 4096
#: An order of more lines is large.
LARGE_ORDER = 10_000
#: Lines that a task numbers and seats, some 100 MB in memory.
TASK_LINES = 500_000
#: What a player takes from a line.
CARRIED = ("l_suppkey", "l_partkey", "l_quantity", "l_linenumber", "l_tax", "l_linestatus", "l_returnflag", "l_extendedprice")
PAGE_SIZE = 100
INGESTED_AT = "2026-01-01T00:00:00+00:00"
URGENT = "1-URGENT"


def _epoch(column: Column) -> Column:
    days = F.unix_date(F.to_date(column)).cast("bigint")
    return days * 86400 + SHIFT_SECONDS


def _absent_if(condition: Column, value: Column) -> Column:
    """Null, which ``to_json`` leaves out of the document."""
    return F.when(~F.coalesce(condition, F.lit(False)), value)


def _once_or_twice(twice: Column) -> Column:
    """Explodes a row to copy 0 and, where the condition holds, copy 1."""
    return F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order: the columns up to the last that a player carries, and the part.

    Later columns order only lines that give equal players, so they are not read. A line without a
    part gets -1: it has a number, but is no player.
    """
    table = read_table(spark, sf_dir, "lineitem")
    named = [c for c in table.columns if c != "l_orderkey"]
    last = max(named.index(c) for c in CARRIED)
    mixed = F.col("l_partkey") * 31 + F.col("l_suppkey") * 7 + F.col("l_linenumber")
    lines = table.where(F.col("l_orderkey").isNotNull()).select("l_orderkey", *named[: last + 1])
    return lines.withColumn("part", F.coalesce(F.pmod(mixed, F.lit(LINE_PARTS)), F.lit(-1)))


def _large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders with more lines than one task should number; few, as each has that many lines."""
    counts = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return counts.where(F.col("l_orderkey").isNotNull() & (F.col("lines") > LARGE_ORDER)).select(F.col("l_orderkey").alias("large"))


def _of_orders(rows: DataFrame, key: str, large: DataFrame, kind: str) -> DataFrame:
    """Rows of large orders (``left_semi``) or of all others (``left_anti``)."""
    return rows.join(F.broadcast(large), F.col(key) == F.col("large"), kind)


def _numbered_at_once(lines: DataFrame) -> DataFrame:
    """Numbers within each order. One shuffle by order, which later steps by order use as well."""
    order = [c for c in lines.columns if c not in ("l_orderkey", "part")]
    within = Window.partitionBy("l_orderkey").orderBy("part", *order)
    return lines.withColumn("number", F.row_number().over(within).cast("bigint") - 1)


def _numbered_by_parts(lines: DataFrame) -> DataFrame:
    """The same numbers for orders of any size.

    Equal lines are counted first. A line's number is its place within its part of the order plus the
    sizes of the parts before, so neither a window nor a join has all lines of an order in one task.
    """
    order = [c for c in lines.columns if c not in ("l_orderkey", "part")]
    lines = lines.groupBy(*lines.columns).agg(F.count("*").alias("copies"))
    sizes = lines.groupBy("l_orderkey", "part").agg(F.sum("copies").alias("size"))
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select(
        "l_orderkey",
        "part",
        F.coalesce(F.sum("size").over(so_far.partitionBy("l_orderkey").orderBy("part")), F.lit(0)).alias("offset"),
    )
    inside = F.coalesce(F.sum("copies").over(so_far.partitionBy("l_orderkey", "part").orderBy(*order)), F.lit(0))
    first = F.col("inside") + F.col("offset")
    return (
        lines.withColumn("inside", inside)
        .join(parts, ["l_orderkey", "part"])
        .withColumn("number", F.explode(F.sequence(first, first + F.col("copies") - 1)))
        .drop("offset", "inside", "copies")
    )


def _spread(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines by order in more tasks than shuffle partitions where these would be too large; the count reads file footers."""
    tasks = math.ceil(read_table(spark, sf_dir, "lineitem").count() / TASK_LINES)
    planned = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "1")
    planned = max(int(planned), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return lines.repartition(tasks, "l_orderkey") if tasks > planned else lines


def _numbered(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    lines = _of_orders(_lines(spark, sf_dir), "l_orderkey", _large_orders(spark, sf_dir), kind)
    return _numbered_by_parts(lines) if kind == "left_semi" else _numbered_at_once(_spread(spark, sf_dir, lines))


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their number within the order, from 0, by part and then by the other columns.

    Orders of up to ``LARGE_ORDER`` lines are numbered at once, larger ones part by part.
    """
    numbered = _numbered(spark, sf_dir, "left_anti").unionByName(_numbered(spark, sf_dir, "left_semi"))
    return numbered.where("part >= 0").drop("part")


def _seats(lines: DataFrame) -> DataFrame:
    number = F.col("number")
    seat = F.struct(
        (number % SEATS).cast("int").alias("seat"),
        F.col("l_suppkey").alias("hero"),
        F.col("l_partkey").alias("part"),
        (F.col("l_quantity").cast("bigint") % 30).alias("kills"),
        F.col("l_linenumber").cast("bigint").alias("deaths"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("assists"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("won"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("left"),
        F.floor("l_extendedprice").alias("gold"),
        (F.col("l_quantity").cast("bigint") * 100).alias("xp"),
    )
    document = F.floor(number / SEATS).alias("document")
    placed = lines.select("l_orderkey", document, F.when(F.col("part") >= 0, seat).alias("seat"))
    documents = placed.groupBy("l_orderkey", "document").agg(F.sort_array(F.collect_list("seat")).alias("seats"))
    some = F.size("seats") > 0
    return documents.where(some | (F.col("document") == 0)).withColumn("seats", F.when(some, F.col("seats")))


def seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, document, seats``: the players of each document, in arrays of at most ten."""
    return _seats(_numbered(spark, sf_dir, "left_anti")).unionByName(_seats(_numbered(spark, sf_dir, "left_semi")))


def _orders_with_seats(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Orders with the seats of each of their documents; document 0 of each order, also without lines."""
    orders = read_table(spark, sf_dir, "orders").where(F.col("o_orderkey").isNotNull())
    orders = _of_orders(orders, "o_orderkey", _large_orders(spark, sf_dir), kind)
    seated = _seats(_numbered(spark, sf_dir, kind))
    # A shuffle join: the documents are built by as many tasks as there are shuffle partitions.
    joined = orders.join(seated.hint("merge"), orders["o_orderkey"] == seated["l_orderkey"], "left")
    return joined.withColumn("document", F.coalesce("document", F.lit(0).cast("bigint")))


def _player(seat: Column, customer: Column) -> Column:
    part = seat["part"]
    slot = F.floor(seat["seat"] / 2) + 128 * (seat["seat"] % 2)
    return F.struct(
        _absent_if(part % 10 == 0, customer * 10 + seat["seat"]).alias("account_id"),
        _absent_if(part % 41 == 0, slot).alias("player_slot"),
        _absent_if(part % 37 == 0, seat["hero"]).alias("hero_id"),
        seat["kills"].alias("kills"),
        seat["deaths"].alias("deaths"),
        seat["assists"].alias("assists"),
        _absent_if(part % 29 == 0, seat["won"]).alias("win"),
        _absent_if(seat["seat"] == 6, seat["seat"] % 4 + 1).alias("lane_role"),
        _absent_if(part % 3 == 0, part % 80).alias("rank_tier"),
        seat["left"].alias("leaver_status"),
        seat["gold"].alias("total_gold"),
        seat["xp"].alias("total_xp"),
    )


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope columns, ``loaded_at`` and the payload as a struct; urgent orders come twice."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    match_id = key + F.col("document") * DOCUMENT_STEP
    sides = [_orders_with_seats(spark, sf_dir, kind) for kind in ("left_anti", "left_semi")]
    joined = sides[0].unionByName(sides[1])
    rows = joined.withColumn("copy", _once_or_twice(F.col("o_orderpriority") == URGENT))
    start = _epoch(F.col("o_orderdate"))
    stream = (
        F.when((F.col("copy") == 1) | (F.col("o_orderstatus") == "O"), "public_matches")
        .when(F.col("o_orderstatus") == "F", "pro_matches")
        .otherwise("unknown")
    )
    league = _absent_if(stream == "public_matches", customer % 50)
    payload = F.struct(
        _absent_if(key % 97 == 5, match_id).alias("match_id"),
        start.alias("start_time"),
        (900 + F.floor("o_totalprice") % 3600).alias("duration"),
        ((key % 2 == 0) != (F.col("copy") == 1)).alias("radiant_win"),
        (key % 8).alias("lobby_type"),
        (key % 23).alias("game_mode"),
        (F.year("o_orderdate") - 1945).alias("patch"),
        (customer % 10).alias("region"),
        (key % 61).alias("radiant_score"),
        (key % 53).alias("dire_score"),
        league.alias("leagueid"),
        F.concat(F.lit("League "), league.cast("string")).alias("league_name"),
        F.transform("seats", lambda seat: _player(seat, customer)).alias("players"),
    )
    return rows.select(
        match_id.alias("match_id"),
        start.alias("start_time"),
        stream.alias("source_stream"),
        _absent_if(key % 101 == 7, recency_window(start)).alias("recency_window"),
        epoch_to_ntz(start + F.col("copy") * 86400).alias("loaded_at"),
        payload.alias("payload"),
    )


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``raw_matches`` table: payload text parsed to VARIANT, as the loader stores it."""
    return match_documents(spark, sf_dir).select(
        "match_id",
        "start_time",
        "source_stream",
        "recency_window",
        F.parse_json(F.to_json("payload")).alias("raw_payload"),
        "loaded_at",
    )


def envelope_lines(spark: SparkSession, sf_dir: str, *, with_legacy: bool) -> DataFrame:
    """Text lines as the detail step writes them.

    With legacy records, some lines are bare payloads and some envelopes lack the label.
    Without, every line has all the keys that the loader requires.
    """
    documents = match_documents(spark, sf_dir)
    if not with_legacy:
        documents = documents.withColumn("recency_window", recency_window(F.col("start_time")))
    envelope = F.to_json(
        F.struct(
            "match_id",
            "start_time",
            "source_stream",
            "recency_window",
            F.lit(INGESTED_AT).alias("ingested_at"),
            "payload",
        )
    )
    if with_legacy:
        envelope = F.when(F.col("match_id") % 13 == 3, F.to_json("payload")).otherwise(envelope)
    return documents.select(envelope.alias("value"))


def hero_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the heroes; some have no id, some no name, some only the first snapshot."""
    key = F.col("s_suppkey")
    rows = read_table(spark, sf_dir, "supplier").withColumn(
        "snapshot", _once_or_twice(F.col("s_acctbal") > 3000)
    )
    roles = (
        F.when(key % 3 == 0, F.array(F.lit("Carry")))
        .when(key % 3 == 1, F.array(F.lit("Support"), F.lit("Nuker")))
        .otherwise(F.array(F.lit("Durable"), F.lit("Initiator"), F.lit("Carry")))
    )
    attributes = F.array(F.lit("str"), F.lit("agi"), F.lit("int"), F.lit("all"))
    payload = F.struct(
        _absent_if(key % 25 == 24, key).alias("id"),
        _absent_if(key % 50 == 3, F.col("s_name")).alias("localized_name"),
        F.get(attributes, F.col("s_nationkey") % 4).alias("primary_attr"),
        F.when(key % 2 == 0, "Melee").otherwise("Ranged").alias("attack_type"),
        roles.alias("roles"),
        (key * 3 + F.col("snapshot")).alias("pro_pick"),
        (key + F.col("snapshot")).alias("pro_win"),
        (key % 11).alias("pro_ban"),
        (key * 100).alias("turbo_picks"),
        _absent_if(key % 5 == 0, key * 50).alias("turbo_wins"),
    )
    day = F.lit("2025-06-01 00:00:00").cast("timestamp_ntz")
    loaded = day + F.make_dt_interval(days=F.col("snapshot") * 30)
    return rows.select(
        key.alias("hero_key"), "snapshot", loaded.alias("loaded_at"), payload.alias("payload")
    )


def raw_hero_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``raw_hero_stats`` table; the loader drops heroes without an id."""
    rows = hero_documents(spark, sf_dir).where(F.col("payload.id").isNotNull())
    return rows.select(
        F.col("payload.id").alias("hero_id"),
        F.parse_json(F.to_json("payload")).alias("raw_payload"),
        "loaded_at",
    )


def hero_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hero snapshot as text, one bounded JSON array per line."""
    heroes = hero_documents(spark, sf_dir).where(F.col("snapshot") == 0)
    distinct = heroes.groupBy("hero_key").agg(F.min("payload").alias("payload"))
    pages = distinct.groupBy(F.floor(F.col("hero_key") / PAGE_SIZE).alias("page")).agg(
        F.collect_list("payload").alias("heroes")
    )
    return pages.select(F.to_json("heroes").alias("value"))


def pro_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages of pro matches, newest id first; some matches come again on the next page.

    A page covers a fixed range of ids and ids are made distinct first, so pages are bounded.
    """
    orders = read_table(spark, sf_dir, "orders")
    newest = orders.agg(F.max("o_orderkey")).scalar()
    key = F.col("o_orderkey")
    matches = (
        orders.groupBy("o_orderkey")
        .agg(
            F.min("o_orderstatus").alias("status"),
            F.min("o_orderdate").alias("day"),
            F.min("o_orderpriority").alias("priority"),
        )
        .where(F.col("status") == "F")
    )
    sightings = matches.withColumn("again", _once_or_twice(F.col("priority") == URGENT))
    entry = F.struct(
        _absent_if(key % 19 == 7, key).alias("match_id"),
        _absent_if(key % 11 == 4, _epoch(F.col("day")) + F.col("again") * 60).alias("start_time"),
    )
    page = F.floor((newest - key) / PAGE_SIZE) + 1 + F.col("again")
    placed = sightings.select(page.alias("page_no"), key.alias("k"), entry.alias("entry"))
    grouped = placed.groupBy("page_no").agg(
        F.sort_array(F.collect_list(F.struct("k", "entry")), asc=False).alias("sorted")
    )
    return grouped.select(
        "page_no", F.transform("sorted", lambda item: item["entry"]).alias("entries")
    )


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pro_pages(spark, sf_dir).select(F.to_json(F.struct("page_no", "entries")).alias("value"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with entries parsed to VARIANT, as ``read_pages`` returns them."""
    return pro_pages(spark, sf_dir).select(
        "page_no", F.parse_json(F.to_json("entries")).alias("entries")
    )


def manifest(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    """Manifest rows of one stream. Public sightings of a pro match start an hour later."""
    orders = read_table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    start = _epoch(F.col("o_orderdate"))
    if stream == "pro_matches":
        rows = orders.where(status == "F")
    else:
        rows = orders.where((status == "O") | (F.col("o_orderpriority") == URGENT))
        start = start + 3600
    return rows.select(
        key.alias("match_id"),
        start.alias("start_time"),
        F.lit(stream).alias("source_stream"),
        recency_window(start).alias("recency_window"),
    )
