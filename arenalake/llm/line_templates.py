"""Line dedup by a log-template tree.

A line's path in the tree has fixed depth: its number of tokens, then its leading tokens. In a leaf, a
template fixes all other tokens but for its variable fields. A token with a digit is a field, if there are at most
``most_fields`` of them and at least half of the tokens that the template fixes are constant; if there are more, they must
agree as they are. A line of ``least_open`` tokens or more has three more templates, each with one open field of
``field`` tokens: behind the leading tokens, in the middle, or at the end. Lines of fewer than ``least_tokens`` tokens must
agree in every token, digits included. Two lines share a template if they agree in all that it fixes.

A template recurs when lines of at least two different documents have it, whatever its length; its lines stay in
the document of the lowest id and are dropped from all others. Lines without a token always stay.

Lines leave their document before anything else happens, so a row never holds a text beside its lines. Keys are
counted before they are shuffled, and a line is shuffled as a few numbers. A frequent
template is one row on one side of a join, so the other side can be split.

Defined results: a null text stays null and has no lines; null ids count as the highest id; rows
with one id are one document, told apart by their text; documents whose lines all go stay with an
empty text; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.quality_rules import WORD_BREAK, let
from arenalake.storage import fresh_path

FIELD = "<*>"
NO_BREAK = "[^\\x20\\x09-\\x0D]"
WITH_DIGIT = "[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+"
HIGHEST = 2**63 - 1


def words_of(line: Column) -> Column:
    return F.filter(F.split(line, WORD_BREAK), lambda t: t != "")


def tokens_of(line: Column) -> Column:
    return words_of(F.when(line.rlike("[0-9]"), F.regexp_replace(line, WITH_DIGIT, FIELD)).otherwise(line))


def line_key(line: Column) -> Column:
    """Hash of all tokens as they are."""
    return F.xxhash64(F.lit("line"), F.array_join(words_of(line), " "))


def fields(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: t == FIELD))


def template_keys(
    line: Column, tokens: Column, depth: int, field: int, most_fields: int, least_tokens: int, least_open: int
) -> Column:
    """Hashes of the templates a line has: without an open field, then with each."""
    def steady(count: Column, of: Column) -> Column:
        return (count <= most_fields) & (2 * count <= of)

    def keys(ts: Column) -> Column:
        n = F.size(ts)
        has_field = F.array_contains(ts, FIELD)
        middle = F.lit(depth) + F.floor((n - depth - field) / 2).cast("int")
        opened = (F.lit(depth), middle, n - field)  # where open fields begin

        def part(begin: Column, end: Column) -> Column:
            return F.xxhash64(F.array_join(F.slice(ts, begin + 1, end - begin), " "))

        edges = [F.lit(0), opened[0], opened[0] + field, opened[1], opened[1] + field, opened[2], n]
        parts = F.array(*(part(b, e) for b, e in zip(edges, edges[1:])))

        def without(k: int) -> Column:
            own = F.slice(ts, opened[k] + 1, field)
            sound = ~has_field | steady(fields(ts) - fields(own), n - field)
            key = let(parts, lambda ps: F.xxhash64(n, F.lit(k), *(ps[i] for i in range(6) if i != 2 * k + 1)))
            return F.when(sound, key)

        by_line = (n < least_tokens) | (has_field & ~steady(fields(ts), n))
        whole = F.when(by_line, line_key(line)).otherwise(F.xxhash64(n, F.array_join(ts, " ")))
        return F.when(n < least_open, F.array(whole)).otherwise(
            F.array_compact(F.array(whole, *(without(k) for k in range(3))))
        )

    return let(tokens, keys)


def dropped_lines(
    docs: DataFrame,
    depth: int = 3,
    field: int = 3,
    most_fields: int = 3,
    least_tokens: int = 4,
    least_open: int = 12,
) -> DataFrame:
    """``doc_id, text_hash, dropped``: the numbers (from 0) of the lines to drop, for rows that have some."""
    if least_open < depth + 3 * field:
        raise ValueError("open fields must not overlap")
    # The hash and the lines are made one step before the lines are exploded: the text does not go with each line.
    cut = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(HIGHEST)).alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.split("text", "\n", -1).alias("lines"),
    )
    lines = cut.select("doc_id", "text_hash", F.posexplode("lines").alias("line", "content"))
    path = fresh_path(docs.sparkSession, "line_keys")
    content = F.col("content")
    lines.where(content.rlike(NO_BREAK)).select(  # lines with a token
        "doc_id",
        "text_hash",
        "line",
        F.explode(
            template_keys(content, tokens_of(content), depth, field, most_fields, least_tokens, least_open)
        ).alias("key"),
    ).write.parquet(path)
    keys = docs.sparkSession.read.parquet(path)
    recurring = (
        keys.groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last"))
        .select("key", "first")
    )
    return (
        keys.join(recurring, "key")
        .where(F.col("doc_id") > F.col("first"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("line").alias("dropped"))
    )


def drop_recurring_lines(docs: DataFrame, prefix: str = "__", **options) -> DataFrame:
    """``docs`` with ``text`` without the dropped lines, and the columns n_lines and n_dropped, prefixed."""
    gone = dropped_lines(docs, **options).select(
        F.col("doc_id").alias("__line_doc"), F.col("text_hash").alias("__line_hash"), F.col("dropped").alias("__dropped")
    )
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(HIGHEST))
    both = docs.join(gone, (key == F.col("__line_doc")) & (F.xxhash64("text") == F.col("__line_hash")), "left")

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__dropped")  # by a hash set, in order
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    left = let(F.split("text", "\n", -1), rest)
    return both.select(
        *(F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(left).alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias(f"{prefix}n_lines"),
        F.when(F.col("__dropped").isNull(), 0).otherwise(F.size("__dropped")).cast("long").alias(f"{prefix}n_dropped"),
    )
