"""JSON array files of any size, read by as many tasks as the files have splits.

Spark's text source cuts a file at every ``}`` and splits it like any other file. A piece alone does not
know whether it begins inside a string, or how deep it is nested. But it can say what it does to either
start: whether its quotes change from outside to inside a string, and by how much the depth changes if it begins outside or
inside of one. Such summaries add up: the pieces of a split to one summary, and a running sum over the splits of a
file gives each split its start. A second pass then knows the state of every piece. An element ends with the piece
after which the depth is one, the depth of the array's elements.

Most elements are one piece, and stay where they are; only the pieces of elements with inner objects meet by a shuffle.
A file may hold one array, or one array a line. Files of numbers or strings alone have no ``}`` to be cut at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from arenalake.sources.splits import SPLIT, in_file, in_split, joined_text, last_before, placed_text, sum_before

#: What stands between an element and the one before it: a comma, or the edges of arrays.
BEFORE = r"^﻿?\s*(?:\]\s*(?:\[\s*\]\s*)*\[|\[\s*(?:\]\s*\[\s*)*|,)"
AFTER = r"\](?:\s*\[\s*\])*\s*$"


def _depth_change(plain: Column) -> Column:
    """Opening less closing brackets of text outside of strings."""
    return F.regexp_count(plain, F.lit(r"[{\[]")) - F.regexp_count(plain, F.lit(r"[}\]]"))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text between closing braces, with its place and what it does to the state and the depth."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    outside = F.regexp_replace(bare, '"[^"]*+(?:"|$)', "")
    behind = F.regexp_replace(F.regexp_replace(bare, '^[^"]*+(?:"|$)', ""), '"[^"]*+(?:"|$)', "")
    turns = F.regexp_count(bare, F.lit('"')) % 2
    return placed_text(spark, path, "}").select(
        *SPLIT,
        "line",
        "value",
        turns.alias("turns"),
        # The closing brace behind the piece counts where the piece ends outside of a string.
        (_depth_change(outside) - F.when(turns == 0, 1).otherwise(0)).alias("from_outside"),
        (_depth_change(behind) - F.when(turns == 1, 1).otherwise(0)).alias("from_inside"),
    )


def _states(pieces: DataFrame) -> DataFrame:
    """For both states that a split may begin in: the state and the relative depth at the begin of each piece."""
    turned = pieces.withColumn("turned", sum_before(F.col("turns"), in_split()) % 2)
    for start, name in ((0, "outside"), (1, "inside")):
        change = F.when(F.col("turned") == start, F.col("from_outside")).otherwise(F.col("from_inside"))
        turned = turned.withColumn(f"change_{name}", change).withColumn(
            f"depth_{name}", sum_before(F.col(f"change_{name}"), in_split())
        )
    return turned.withColumn("number", F.row_number().over(in_split()))


def _starts(pieces: DataFrame) -> DataFrame:
    """One row a split: the state and depth it begins with, and where the element that it begins in was opened."""
    states = _states(pieces.drop("value"))

    def last_lowest(name: str, state: int) -> Column:
        """The least relative depth of pieces that begin outside of strings, and the last of these."""
        place = F.struct((-F.col(f"depth_{name}")).alias("depth"), "number")
        return F.max(F.when(F.col("turned") == state, place)).alias(f"lowest_{name}")

    splits = states.groupBy(*SPLIT).agg(
        (F.sum("turns") % 2).alias("turns"),
        *(F.sum(f"change_{n}").alias(f"change_{n}") for n in ("outside", "inside")),
        *(last_lowest(n, state) for state, n in enumerate(("outside", "inside"))),
    )

    def of_state(prefix: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{prefix}_outside")).otherwise(F.col(f"{prefix}_inside"))

    known = splits.withColumn("state", sum_before(F.col("turns"), in_file()) % 2).withColumn("change", of_state("change"))
    known = known.withColumn("depth", sum_before(F.col("change"), in_file()))
    lowest = of_state("lowest")
    opens = F.when(F.col("depth") - lowest["depth"] <= 1, F.struct("block", lowest["number"].alias("number")))
    whole = Window.partitionBy("file")
    # The brace that is missing behind the last piece makes a sound file end one below the ground.
    sound = (F.sum("change").over(whole) == -1) & (F.sum("turns").over(whole) % 2 == 0)
    return known.select(
        *SPLIT, "state", "depth", last_before(opens, in_file()).alias("opener"), sound.alias("sound")
    )


def read_split_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One VARIANT column ``record`` per element of the arrays; a file that is no array fails the query."""
    pieces = _pieces(spark, path)
    starts = _starts(pieces).withColumnsRenamed({"state": "split_state", "depth": "split_depth"})
    outside = F.col("split_state") == 0
    depth = F.col("split_depth") + F.when(outside, F.col("depth_outside")).otherwise(F.col("depth_inside"))
    change = F.when(outside, F.col("change_outside")).otherwise(F.col("change_inside"))
    state = (F.col("split_state") + F.col("turned")) % 2
    placed = (
        _states(pieces)
        .join(starts, list(SPLIT))
        .select(
            *SPLIT,
            "number",
            "opener",
            # No element begins or ends in a string.
            ((depth <= 1) & (state == 0)).alias("begins"),
            ((depth + change <= 1) & ((state + F.col("turns")) % 2 == 0)).alias("ends"),
            F.when(depth + change < 0, F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("text"),
            F.when(F.col("sound") & ((depth > 0) | F.col("value").rlike(r"^﻿?\s*\[")), True)
            .otherwise(F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("file"))).cast("boolean"))
            .alias("sound"),
        )
        .where("sound")
    )
    alone = placed.where("begins AND ends").select("text")
    own = F.when(F.col("begins"), F.struct("block", "number"))
    opened = F.last(own, ignorenulls=True).over(Window.partitionBy(*SPLIT).orderBy("number"))
    parts = placed.withColumn("element", F.coalesce(opened, F.col("opener"))).where("NOT (begins AND ends)")
    joined = joined_text(parts, "element", "")
    body = F.regexp_replace("text", BEFORE, "")
    inner = F.when(F.col("text").rlike(r"\}$"), body).otherwise(F.regexp_replace(body, AFTER, ""))
    apart = F.col("text").rlike(BEFORE) | F.col("text").rlike(r"^\s*\]")
    checked = F.when(apart, inner).otherwise(F.raise_error(F.lit("not a JSON array: elements without a comma between")))
    elements = F.parse_json(F.concat(F.lit("["), checked, F.lit("]")))
    texts = alone.unionByName(joined.select("text")).select(elements.alias("doc"))
    return texts.select(F.explode(F.variant_get("doc", "$", "array<variant>")).alias("record"))
