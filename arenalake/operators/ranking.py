"""Ranks over a whole table, without a window that has all of it in one task.

Equal rows are counted first, so a rank is given to each different value once. Values are dealt to ranges in their order and
stored with the number of their range; the rows in all ranges before, one number for each range, are added to
the rank within the range. Ties have one value, so they never fall into two ranges.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from arenalake.storage import fresh_path


def global_rank(rows: DataFrame, order: dict[str, Column], ranges: int | None = None, rank: str = "rank", dense: str = "dense_rank") -> DataFrame:
    """``rows`` with ``rank`` and ``dense_rank`` by some of its columns.

    ``order`` gives each column's sort order, such as ``{"score": F.col("score").desc_nulls_last()}``; rows equal in
    these columns are ties. ``ranges`` is the number of tasks, by default that of a shuffle.
    """
    spark = rows.sparkSession
    names = list(order)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = rows.groupBy(*names).agg(F.count("*").alias("__n"))
    path = fresh_path(spark, "ranges")
    dealt = values.repartitionByRange(ranges, *order.values()).withColumn("__range", F.spark_partition_id())
    dealt.write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("__range").agg(F.sum("__n").alias("rows"), F.count("*").alias("values"))
    found = sorted(sizes.collect(), key=lambda r: r["__range"])  # one row a range
    before = zip(accumulate((r["rows"] for r in found), initial=0), accumulate((r["values"] for r in found), initial=0))
    offsets = spark.createDataFrame(
        [(r["__range"], n, k) for r, (n, k) in zip(found, before)], "__range int, __rows long, __values long"
    )
    local = Window.partitionBy("__range").orderBy(*order.values())
    so_far = F.coalesce(F.sum("__n").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = stored.join(F.broadcast(offsets), "__range").select(
        *(F.col(n).alias(f"__{n}") for n in names),
        (F.col("__rows") + so_far + 1).alias(rank),
        (F.col("__values") + F.row_number().over(local)).alias(dense),
    )
    same = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names))
    return rows.join(ranked, same).drop(*(f"__{n}" for n in names))
