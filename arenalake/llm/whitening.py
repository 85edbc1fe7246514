"""Embedding whitening: blockwise QR on the executors, a bidiagonal qd solver for the small factor.

Exact sums of all components give the mean. Tasks centre their rows and reduce them, block by block,
to one triangular R each; a tree of such reductions leaves one R with R'R = the scatter matrix. The
driver takes R, which is as wide as a vector and no larger however many rows there are, makes it
bidiagonal, finds eigenvalues by dqds and directions by twisted factorisations (``bidiagonal``). All rows are then
projected, and the covariance of what comes out is measured over all of them.

Vectors are arrays of longs (fixed-point numbers), so sums and deviations are exact.

Defined results: vectors with a null entry and null vectors take no part, nor do vectors of another length than the
most frequent one (of several, the greatest); repeated rows all count, and ties are none of this operator's
business, as no order among rows matters; directions without variance, by the rounding of the greatest, have no row,
so equal vectors and empty tables give an empty result; a null id stays null. Sums and deviations beyond a long
raise an error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.bidiagonal import directions
from arenalake.llm.vectors import common_length, matrix

BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: np.ndarray  # exact, of each dimension
    values: np.ndarray  # eigenvalues of the covariance, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sums)^2 of each row, exact."""
        wide = self.n * max(abs(float(x.max())), abs(float(x.min()))) + np.abs(self.sums.astype(float)).max()
        if wide * wide * x.shape[1] >= 2.0**62:
            exact = x.astype(object) * self.n - self.sums.astype(object)
            found = [int(v) for v in (exact * exact).sum(1)]
            if max(found) >= 2**63:
                raise OverflowError("a deviation is beyond a long; use a smaller scale")
            return found
        off = self.n * x - self.sums
        return (off * off).sum(1).tolist()


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, where only the last step rounds."""
    return (x - sums // n).astype(float) - (sums % n) / n


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(parts), mode="r")


def triangular_factor(rows: DataFrame, column: str, width: int, n: int, sums: np.ndarray, fan_in: int = 64) -> np.ndarray:
    """One R of all centred rows. A task holds one block and one R; a merge holds ``fan_in`` R."""
    schema = "part long, r binary"

    def unpack(r: bytes) -> np.ndarray:
        return np.frombuffer(r).reshape(-1, width)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            x = matrix(batch, column, width)
            for at in range(0, len(x), BLOCK):
                r = stacked([r, centred(x[at : at + BLOCK], n, sums)])
        if len(r):
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "r": [r.tobytes()]})

    def merge(key, frame):
        r = stacked([unpack(x) for x in frame.sort_values("part")["r"]])
        frame = frame.iloc[:1].copy()
        frame["part"], frame["r"] = int(key[0]), [r.tobytes()]
        return frame

    found = rows.select(column).mapInArrow(reduce_rows, schema)
    for _ in range(2):
        found = found.groupBy(F.floor(F.col("part") / fan_in).alias("of")).applyInPandas(merge, schema)
    parts = sorted((x["part"], x["r"]) for x in found.toLocalIterator())  # one for each fan_in^2 partitions
    r = np.zeros((0, width))
    for _, part in parts:
        r = stacked([r, unpack(part)])
    return r


def usable(rows: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows whose vector has the common length and no null, and that length."""
    whole = rows.where(F.col(column).isNotNull() & F.forall(column, lambda c: c.isNotNull()))
    width = common_length(whole, column)
    return whole.where(F.size(column) == width), width


def fit(rows: DataFrame, column: str, width: int, components: int) -> Whitening:
    """The whitening of all rows, whose vectors have ``width`` components."""
    sums = np.zeros(width, np.int64)
    n = 0
    totals = rows.select(F.posexplode(column).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    for x in totals.collect():  # one row a dimension
        sums[x["at"]], n = x["s"], x["n"]
    r = triangular_factor(rows, column, width, n, sums) if n else np.zeros((0, width))
    values, vectors, trace = directions(r, components)
    return Whitening(n, sums, values / max(n, 1), vectors, trace / max(n, 1))


def identity_error(rows: DataFrame, column: str, width: int, model: Whitening) -> float:
    """Largest entry of the covariance of all whitened rows minus the identity."""
    k = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k + k)
        for batch in batches:
            y = model.project(matrix(batch, column, width))
            total += np.concatenate([(y.T @ y).ravel(), y.sum(0)])
        yield pa.RecordBatch.from_pydict({"m": [total.tolist()]}, pa.schema([("m", pa.list_(pa.float64()))]))

    parts = rows.select(column).mapInArrow(moments, "m array<double>").select(F.posexplode("m").alias("at", "v"))
    found = np.zeros(k * k + k)
    for x in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():  # k^2 + k numbers
        found[x["at"]] = x["v"]
    mean = found[k * k :] / model.n
    return float(np.abs(found[: k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, column: str, id_column: str, components: int = 8) -> DataFrame:
    """``id_column, component, n, deviation, whitened, explained, identity_error`` for each row and component."""
    schema = f"{id_column} long, n long, deviation long, y array<double>"
    kept, width = usable(rows.select(F.col(id_column).cast("long").alias(id_column), F.col(column).cast("array<bigint>").alias(column)), column)
    model = fit(kept, column, width, components) if width else None
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], f"{id_column} long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(kept, column, width, model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, column, width)
            y = model.project(x)
            k = y.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column),
                    pa.array(np.full(len(x), model.n)),
                    pa.array(model.deviations(x), pa.int64()),
                    pa.ListArray.from_arrays(np.arange(0, len(x) * k + 1, k, dtype=np.int32), y.ravel()),
                ],
                names=[id_column, "n", "deviation", "y"],
            )

    done = kept.select(id_column, column).mapInArrow(project, schema)
    shares = F.array(*(F.lit(float(v)) for v in model.values / model.trace))
    return done.select(id_column, "n", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        id_column,
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
