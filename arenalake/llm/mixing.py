"""Mixing sources by temperature.

A source's weight is its share of tokens to the power of an exponent, normalised. The exponent is
found by bisection: the largest for which the mix's entropy reaches a target, or the smallest for
which no source is repeated more than a limit. A token budget then gives each source its number of
whole passes over its documents and the tokens of a last, partial pass.

Documents are dealt into blocks of about ``block_rows`` by a hash. In the partial pass a source's
blocks come in the order of a seeded permutation until its budget is used up; the last block is
cut between documents. A source of any size is thus handled block by block: windows run over
blocks, or over one block's documents.

The number of sources is checked against ``most_sources`` before their totals come to the driver.

Defined results: a null source is a source of its own; a null or empty text has no tokens; a
source without tokens has weight 0 and one pass; repeated rows share one fate; an empty table gives
an empty result. All columns stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.quality_rules import WORD_BREAK
from arenalake.storage import fresh_path


def n_tokens(text: Column) -> Column:
    """Words: runs of anything but white space."""
    trimmed = F.coalesce(text, F.lit(""))
    return F.regexp_count(trimmed, F.lit(WORD_BREAK.replace("[", "[^", 1))).cast("long")


def tempered(shares: list[float], exponent: float) -> list[float]:
    powers = [s**exponent if s > 0 else 0.0 for s in shares]
    total = sum(powers)
    return [p / total if total else 0.0 for p in powers]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def repetitions(shares: list[float], weights: list[float]) -> float:
    """Passes over the most repeated source while the least repeated one is read once."""
    passes = [w / s for s, w in zip(shares, weights) if s > 0]
    return max(passes) / min(passes) if passes else 1.0


def bisected(holds, low: float, high: float, steps: int = 60) -> float:
    """The end of the values from ``low`` on for which a condition holds; ``low`` if it holds nowhere."""
    if holds(high):
        return high
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def exponent_for(
    shares: list[float], target_entropy: float | None = None, repetition_limit: float | None = None
) -> float:
    """Entropy (as a part of the most that the sources allow) falls with the exponent; repetition, too."""
    if (target_entropy is None) == (repetition_limit is None):
        raise ValueError("give a target entropy or a repetition limit")
    positive = [s for s in shares if s > 0]
    if len(positive) < 2:
        return 1.0
    if target_entropy is not None:
        most = math.log(len(positive))
        return bisected(lambda a: entropy(tempered(positive, a)) >= target_entropy * most, 0.0, 8.0)
    return 1.0 - bisected(
        lambda flat: repetitions(positive, tempered(positive, 1.0 - flat)) <= repetition_limit, 0.0, 1.0
    )


@dataclass(frozen=True)
class Share:
    source: str | None
    n_rows: int
    n_tokens: int
    weight: float
    passes: int
    rest: int  # tokens of the partial pass
    blocks: int


def plan(
    totals: list[tuple[str | None, int, int]],
    target_entropy: float | None,
    repetition_limit: float | None,
    budget: int | None,
    block_rows: int,
) -> list[Share]:
    """``totals``: (source, rows, tokens). Without a budget every source is read at least once."""
    corpus = sum(t[2] for t in totals)
    shares = [t[2] / corpus if corpus else 0.0 for t in totals]
    weights = tempered(shares, exponent_for(shares, target_entropy, repetition_limit))
    if budget is None:
        budget = max((math.ceil(t[2] / w) for t, w in zip(totals, weights) if w > 0), default=0)
    out = []
    for (source, rows, tokens), w in zip(totals, weights):
        # A pass that lacks a part in 10**9 is whole: such a part comes from rounding.
        passes = math.floor(w * budget / tokens + 1e-9) if tokens else 1
        rest = max(0, round(w * budget - passes * tokens))
        out.append(Share(source, rows, tokens, w, passes, rest, max(1, math.ceil(rows / block_rows))))
    return out


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def mix_sources(
    docs: DataFrame,
    target_entropy: float | None = None,
    repetition_limit: float | None = None,
    budget: int | None = None,
    block_rows: int = 1_000,
    seed: int = 42,
    most_sources: int = 100_000,
    prefix: str = "__mix_",
) -> DataFrame:
    """``docs`` in as many copies as the mix asks for, with prefixed columns ``pass`` (from 0), ``block``
    and ``order`` (sorting by pass and order gives the permutation)."""
    spark = docs.sparkSession
    row_hash = F.xxhash64("doc_id", "text")
    path = fresh_path(spark, "mix_sizes")
    docs.select(
        source_key(F.col("source")).alias("source"), row_hash.alias("row"), n_tokens(F.col("text")).alias("n")
    ).write.parquet(path)
    sizes = spark.read.schema("source string, row long, n long").parquet(path)
    found = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).limit(most_sources + 1).collect()
    if len(found) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    shares = plan(
        sorted((r["source"], r["rows"], r["n"]) for r in found), target_entropy, repetition_limit, budget, block_rows
    )
    # One row for each source, whose number has just been checked.
    known = F.broadcast(
        spark.createDataFrame(
            [(s.source, s.passes, s.rest, s.blocks) for s in shares],
            "source string, passes int, rest long, blocks int",
        )
    )
    def block_of(row: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), row), F.col("blocks")).cast("int")

    def rank(k: Column) -> Column:
        """The place of a block in a pass's permutation."""
        return F.xxhash64(F.lit(seed + 1), "source", k, "block")

    dealt = sizes.join(known, "source").withColumn("block", block_of(F.col("row")))
    blocks = dealt.groupBy("source", "block", "passes", "rest").agg(F.sum("n").alias("n"))
    in_turn = Window.partitionBy("source").orderBy(rank(F.col("passes")), "block")
    filled = blocks.withColumn("before", F.sum("n").over(in_turn) - F.col("n")).where(F.col("before") < F.col("rest"))
    cut = filled.select(
        "source", "block", (F.col("rest") - F.col("before")).alias("room"), (F.col("n") <= F.col("rest") - F.col("before")).alias("whole")
    )
    # Of a cut block, documents in hash order while they fit: at most one such block for each source.
    in_block = Window.partitionBy("source", "block").orderBy("row").rangeBetween(Window.unboundedPreceding, 0)
    last_row = (
        dealt.join(cut.where("NOT whole"), ["source", "block"])
        .withColumn("upto", F.sum("n").over(in_block))
        .where("upto <= room")
        .groupBy("source", "block")
        .agg(F.max("row").alias("last_row"))
    )
    partial = cut.join(last_row, ["source", "block"], "left").select(
        F.col("source").alias("__source"), F.col("block").alias("__block"), "whole", "last_row"
    )
    names = docs.columns
    held = docs.select(F.struct(*names).alias("__doc"), source_key(F.col("source")).alias("source"), row_hash.alias("row"))
    placed = held.join(known, "source").withColumn("block", block_of(F.col("row")))
    both = placed.join(partial, (F.col("source") == F.col("__source")) & (F.col("block") == F.col("__block")), "left")
    extra = F.when(F.col("whole") | (F.col("row") <= F.col("last_row")), 1).otherwise(0)
    copies = both.withColumn("copies", F.col("passes") + extra).where("copies > 0")
    return copies.select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("pass")).select(
        *(F.col("__doc")[n].alias(n) for n in names),
        F.col("pass").alias(prefix + "pass"),
        F.col("block").alias(prefix + "block"),
        rank(F.col("pass")).alias(prefix + "order"),
    )
