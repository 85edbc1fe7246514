"""Documents in the order of their ids, cut into blocks that tasks can handle alone.

Blocks are ranges of ``doc_id`` between approximate quantiles, so a block is found from an id by
binary search, without a sample of the texts. Null ids come before all others; rows with one id
stay in one block and are ordered by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOWEST = -(2**63)


def order_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LOWEST))


def block_bounds(docs: DataFrame, blocks: int) -> list[int]:
    """Lower bounds of all blocks but the first: at most ``blocks - 1`` numbers reach the driver."""
    shares = [k / blocks for k in range(1, blocks)]
    if not shares:
        return []
    found = docs.select(F.percentile_approx(order_key(F.col("doc_id")), shares, 100 * blocks).alias("q")).first()["q"]
    return sorted(set(found or []))


def block_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the key, by binary search."""
    if not bounds:
        return F.lit(0)
    array = F.array(*(F.lit(b).cast("long") for b in bounds))
    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    last = F.array(*(F.lit(s) for s in steps))
    found = F.transform(
        F.array(array),
        lambda known: F.aggregate(
            last,
            F.lit(0),
            lambda at, step: F.when(F.coalesce(F.get(known, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at),
        ),
    )
    return found[0]


def default_blocks(docs: DataFrame) -> int:
    """As many as shuffles have partitions, which a cluster sets to suit its input."""
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
