"""Helpers for vector columns: which rows take part, and matrices of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for a vector without null and non-finite components."""
    def sound(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    return vector.isNotNull() & F.forall(vector, sound)


def scaled_floor(vector: Column, scale: int, plus: int = 0) -> Column:
    """Each component c as the long floor(scale * c) + plus."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))).cast("long") + F.lit(plus))


def common_length(rows: DataFrame, column: str) -> int:
    """The most frequent length of the vectors (of several, the greatest); 0 without vectors."""
    lengths = rows.select(F.size(column).alias("d")).where("d > 0").groupBy("d").count()
    first = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    """The vectors of a batch as rows of a matrix."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
