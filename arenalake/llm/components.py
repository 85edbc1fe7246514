"""Connected components of an edge table, by alternating large and small stars.

Each round hangs every node's larger neighbours, then its smaller ones, on its least neighbour.
Rounds are written to the shared folder, so a lost executor costs one round at most. Only minima
are grouped; a node with very many neighbours is a long side of a join, which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.storage import fresh_path

EDGE = "a long, b long"


def written(rows: DataFrame, label: str, schema: str) -> DataFrame:
    """The rows as a table in the shared folder."""
    path = fresh_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    hung = edges.join(least, "b").where("a <> m").select(F.col("m").alias("x"), F.col("a").alias("y"))
    return hung.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).unionByName(
        least.select(F.col("m").alias("a"), "b")
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, label: str = "stars") -> DataFrame:
    """``node, root`` for each node of the edges ``a, b``; the root is the least node of the component."""
    ordered = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = written(ordered.distinct(), label, EDGE)
    state = _state(now)
    while True:
        now = written(_small_star(_large_star(now)).distinct(), label, EDGE)
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
