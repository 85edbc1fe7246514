"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    ``rank = 1`` lets Spark keep one row per key and task before the shuffle
    (WindowGroupLimit), so a key that holds a third of all rows shuffles a few rows only.
    Pass an order without ties: lost executors may replay a task.
    """
    ranked = rows.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")
