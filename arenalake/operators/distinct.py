"""Numbers of different keys per group: exact, from 64-bit words, and estimated, from sketches. Both can be stored and merged.

Exact: a key is a bit of a word, 64 neighbouring keys share the word. Words are or-ed map-side and again after the shuffle,
in hash aggregates over longs, and their bits are counted. Dense keys shuffle a row for 64 keys and sparse keys a row
for each, so never more than the distinct keys do. (The bitmaps of ``bitmap_construct_agg`` have 4 KB also for a
single key and sort their input.)

Estimated: one sketch of bounded size for each stored group and column, whatever the number of keys. Sketches of any
set of groups merge into one; the merged estimate has the error of a single sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Columns of stored words, beside those of the group.
WORDS = ("key_name", "word", "bits", "row_count")


def key_words(rows: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per group, key column and word, with the bits of its keys and the number of rows.

    Keys are integers, negative ones too. A null key is a word without bits, so that rows without keys are counted.
    """
    values = [F.struct(F.lit(name).alias("key_name"), F.col(name).cast("bigint").alias("__key")) for name in keys]
    each = rows.select(*group, F.inline(F.array(*values)))
    bit = F.expr("CASE WHEN __key IS NULL THEN 0L ELSE shiftleft(1L, CAST(__key & 63 AS INT)) END")
    words = each.select(
        *group, "key_name", F.shiftright("__key", 6).alias("word"), bit.alias("bits"), F.lit(1).cast("bigint").alias("row_count")
    )
    return merge_words(words, group)


def merge_words(words: DataFrame, group: Sequence[str]) -> DataFrame:
    """Words of several loads, or of finer groups, as one; rows are added up, so each load must come once."""
    return words.groupBy(*group, "key_name", "word").agg(F.bit_or("bits").alias("bits"), F.sum("row_count").alias("row_count"))


def counts_of_words(words: DataFrame, group: Sequence[str], names: Mapping[str, str], rows: str) -> DataFrame:
    """Rows and different keys per group, from merged words. ``names`` says how the count of each key column is called."""
    first = next(iter(names))
    counts = [
        F.sum(F.when(F.col("key_name") == key, F.bit_count("bits")).otherwise(0)).cast("bigint").alias(name)
        for key, name in names.items()
    ]
    total = F.sum(F.when(F.col("key_name") == first, F.col("row_count")).otherwise(0)).alias(rows)
    return words.groupBy(*group).agg(total, *counts)


def count_different(rows: DataFrame, group: Sequence[str], names: Mapping[str, str], row_count: str) -> DataFrame:
    """Rows and different keys per group; exact."""
    return counts_of_words(key_words(rows, group, list(names)), group, names, row_count)


# Sketches


def sketch_error(lg_size: int, deviations: float = 3.0) -> float:
    """The relative error that a merged estimate stays below, as a number of standard errors."""
    return deviations * 1.04 / 2 ** (lg_size / 2)


def key_sketches(rows: DataFrame, group: Sequence[str], keys: Sequence[str], lg_size: int = 12) -> DataFrame:
    """One row per group with a sketch of each key column; nulls do not count, a group without keys has an empty one.

    ``lg_size`` from 4 to 21; a sketch has at most 2^lg_size bytes and some 40 more.
    """
    return rows.groupBy(*group).agg(*(F.hll_sketch_agg(name, lg_size).alias(name) for name in keys))


def merge_sketches(sketches: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Sketches of several loads, or of finer groups, as one. A repeated load changes nothing."""
    return sketches.groupBy(*group).agg(*(F.hll_union_agg(name).alias(name) for name in keys))


def estimate(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)
