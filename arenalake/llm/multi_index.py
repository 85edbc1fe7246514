"""Hard-negative mining over an inverted multi-index, exact.

Vectors are cut into two halves, and each half has a codebook. A row's pair of codewords is its cell.
For a query, the inner product of a half with any row of a codeword is at most its product with the
codeword plus its length times the codeword's radius; the sum of two such bounds holds for the whole cell. A
heap walks over both sorted lists at once (multi-sequence) and visits cells by falling bound. It
stops when every window that is asked for is certified: it has its rows above the bound of all cells left, or
that bound is below the window.

The index is a written table, ordered by cell and cut into shards of ``shard_rows`` rows, so a cell of very many
rows spans shards. Anchors go to the shards that can still hold a result of theirs: exact scores against a bounded
sample give a floor under the last score that counts. A task holds one shard, and anchors pass it by one after the other.
Codebooks are fitted on the sample; every row is indexed, and nothing is left out of a window.

Vectors are arrays of longs, so scores are exact integers (in doubles, below 2^53, which is checked).

Defined results: rows with a null label, a null vector or a null component take no part, nor do vectors of another
length than the most frequent one; rows without an id are no anchors and come last among equal scores; repeated rows
are separate candidates, but a row never stands beside an anchor of its own id, and equal anchors are one; several
rows of one anchor id are anchors of their own, and their results stand side by side; anchors without positives or
without negatives in the window have no row, nor has an empty table. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.vectors import common_length, matrix
from arenalake.storage import fresh_path

HIGHEST = 2**63 - 1
CHUNK = 2048


@dataclass(frozen=True)
class Mining:
    """What to mine: percents of the positive's score between which a negative's score must be."""

    positives: int = 5
    negatives: int = 10
    least_percent: int = 30
    most_percent: int = 90
    codewords: int = 32
    sample_rows: int = 20_000
    shard_rows: int = 65_536

    def window(self, score: int) -> tuple[int, int]:
        """Least and greatest integer score of a negative; the least is above the greatest if there is none."""
        return -(-self.least_percent * score // 100), self.most_percent * score // 100


def codebook(points: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """Centres of the sample: spread by farthest points, then moved by rounds of means."""
    centres = [points.mean(0)]
    far = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < min(size, len(points)):
        centres.append(points[int(far.argmax())])
        far = np.minimum(far, ((points - centres[-1]) ** 2).sum(1))
    found = np.array(centres, float)
    for _ in range(rounds):
        near = nearest(points, found)
        counts = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        found = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], found)
    return found


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)


@dataclass(frozen=True)
class Index:
    """Codebooks of both halves, and the sample they come from."""

    width: int
    books: tuple[np.ndarray, np.ndarray]
    sample: np.ndarray
    sample_labels: np.ndarray
    sample_ids: np.ndarray

    @property
    def light(self) -> Index:
        """Without the sample."""
        none = np.empty(0, np.int64)
        return Index(self.width, self.books, np.empty((0, self.width)), none, none)

    @property
    def half(self) -> int:
        return (self.width + 1) // 2

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., : self.half], x[..., self.half :]

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = self.halves(x)
        return nearest(first, self.books[0]), nearest(second, self.books[1])

    def spread(self, x: np.ndarray, codes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each row's halves to their codewords."""
        return tuple(np.sqrt(((h - b[c]) ** 2).sum(1)) for h, b, c in zip(self.halves(x), self.books, codes))

    def bounds(self, q: np.ndarray, radii: list[np.ndarray]) -> list[np.ndarray]:
        """Greatest possible product of each half of ``q`` with a row of each codeword, a little above."""
        found = []
        for part, book, radius in zip(self.halves(q), self.books, radii):
            top = book @ part + np.linalg.norm(part) * radius
            found.append(top + 1e-9 * (np.abs(top) + 1))
        return found


def by_falling_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """The multi-sequence walk: pairs of positions in two lists by falling sum."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    one, two = one.tolist(), two.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, one[i], two[j]
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):  # each pair is pushed once
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` by falling score, ties by id."""
    return np.lexsort((ids, -scores))[:count]


class Shard:
    """The rows of a shard, by cell and label within a cell."""

    def __init__(self, index: Index, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        c1, c2 = index.codes(x)
        order = np.lexsort((labels, c2, c1))
        self.index, self.ids, self.labels, self.x = index, ids[order], labels[order], x[order]
        c1, c2 = c1[order], c2[order]
        far = index.spread(self.x, (c1, c2))
        self.codes = [np.unique(c) for c in (c1, c2)]
        radii = [np.zeros(len(b)) for b in index.books]
        for radius, c, r in zip(radii, (c1, c2), far):
            np.maximum.at(radius, c, r)
        self.radii = radii
        cell = c1 * len(index.books[1]) + c2
        found, begin = np.unique(cell, return_index=True)
        ends = [*begin[1:].tolist(), len(cell)]
        self.cells = {c: (b, e) for c, b, e in zip(found.tolist(), begin.tolist(), ends)}

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Cells that have rows, by falling bound, as (bound, first row, row behind the last)."""
        first, second = self.index.bounds(q, self.radii)
        ones, twos = self.codes
        width = len(self.index.books[1])
        for bound, i, j in by_falling_bound(first[ones], second[twos]):
            rows = self.cells.get(int(ones[i]) * width + int(twos[j]))
            if rows:
                yield bound, *rows

    def labelled(self, begin: int, end: int, label: int) -> tuple[int, int]:
        """The rows of a cell with this label."""
        part = self.labels[begin:end]
        return begin + int(np.searchsorted(part, label, "left")), begin + int(np.searchsorted(part, label, "right"))

    def scored(self, pending: list[tuple[int, int]], q: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.concatenate([np.arange(b, e) for b, e in pending])
        rows = rows[self.ids[rows] != own]
        return (self.x[rows] @ q).astype(np.int64), self.ids[rows]

    def positives(self, q: np.ndarray, own: int, label: int, least: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``count`` rows of the label with a score of ``least`` or more."""
        scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        pending, size = [], 0

        def flush() -> None:
            nonlocal scores, ids, pending, size, least
            new, of = self.scored(pending, q, own)
            scores, ids = np.concatenate([scores, new]), np.concatenate([ids, of])
            first = best(scores, ids, count)
            scores, ids, pending, size = scores[first], ids[first], [], 0
            if len(scores) == count:
                least = max(least, int(scores[-1]))

        for bound, begin, end in self.visit(q):
            if bound < least:
                break
            begin, end = self.labelled(begin, end, label)
            if begin < end:
                pending.append((begin, end))
                size += end - begin
            if size >= CHUNK:
                flush()
        if pending:
            flush()
        sound = scores >= least
        return scores[sound], ids[sound]

    def negatives(
        self, q: np.ndarray, own: int, label: int, windows: list[tuple[int, int]], least: list[int], count: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window of scores, the first ``count`` rows of other labels, not below ``least``."""
        scores, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        floors, most = list(least), max(high for _, high in windows)
        pending, size = [], 0

        def of_window(w: int) -> np.ndarray:
            inside = np.flatnonzero((scores >= floors[w]) & (scores <= windows[w][1]))
            return inside[best(scores[inside], ids[inside], count)]

        def flush() -> None:
            nonlocal scores, ids, pending, size
            new, of = self.scored(pending, q, own)
            near = (new <= most) & (new >= min(floors))
            scores, ids = np.concatenate([scores, new[near]]), np.concatenate([ids, of[near]])
            taken = [of_window(w) for w in range(len(windows))]
            for w, rows in enumerate(taken):
                if len(rows) == count:
                    floors[w] = max(floors[w], int(scores[rows[-1]]))
            rows = np.unique(np.concatenate(taken))
            scores, ids, pending, size = scores[rows], ids[rows], [], 0

        for bound, begin, end in self.visit(q):
            if bound < min(floors):  # all windows are certified
                break
            first, last = self.labelled(begin, end, label)
            pending += [(b, e) for b, e in ((begin, first), (last, end)) if b < e]
            size += end - begin - (last - first)
            if size >= CHUNK:
                flush()
        if pending:
            flush()
        return [(scores[rows], ids[rows]) for rows in map(of_window, range(len(windows)))]


def long_list(vectors: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(vectors, dtype=np.int64).ravel()
    return pa.ListArray.from_arrays(np.arange(0, flat.size + 1, vectors.shape[1], dtype=np.int32), flat)


def fit_index(rows: DataFrame, width: int, mining: Mining) -> Index:
    """Codebooks from at most ``sample_rows`` rows, chosen by a hash of id and content."""
    order = F.xxhash64("id", "label", "x")
    some = rows.select("id", "label", "x").orderBy(order, "id").limit(mining.sample_rows).toArrow()
    x = np.vstack([matrix(b, "x", width) for b in some.to_batches() if b.num_rows]).astype(float)
    labels, ids = some.column("label").to_numpy(), some.column("id").to_numpy()
    half = (width + 1) // 2
    books = tuple(codebook(part, mining.codewords) for part in (x[:, :half], x[:, half:]))
    return Index(width, books, x, labels, ids)


def with_cells(rows: DataFrame, index: Index) -> DataFrame:
    """Each row with its cell and how far its halves are from their codewords."""
    index = index.light

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, "x", index.width).astype(float)
                codes = index.codes(x)
                columns = [*batch.columns, *(pa.array(c.astype(np.int32)) for c in codes), *map(pa.array, index.spread(x, codes))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "c1", "c2", "r1", "r2"])

    return rows.select("id", "label", "x").mapInArrow(coded, "id long, label long, x array<long>, c1 int, c2 int, r1 double, r2 double")


@dataclass(frozen=True)
class Shards:
    """The stored index, and for each shard the codewords and radii it has of both halves."""

    rows: DataFrame
    summary: list[tuple[int, list[np.ndarray], list[np.ndarray]]]


def store_index(rows: DataFrame, index: Index, count: int, mining: Mining) -> Shards:
    """Write the index in the order of its cells, one shard a partition."""
    spark = rows.sparkSession
    shards = max(-(-count // mining.shard_rows), min(16, -(-count // 1024)))
    path = fresh_path(spark, "multi_index")
    ordered = with_cells(rows, index).repartitionByRange(shards, "c1", "c2", "id")
    ordered.withColumn("shard", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    both = []
    for c, r in (("c1", "r1"), ("c2", "r2")):  # at most shards + cells rows
        both.append(stored.groupBy("shard", c).agg(F.max(r).alias("r")).orderBy("shard", c).collect())
    summary = []
    for shard in sorted({x["shard"] for x in both[0]}):
        codes = [np.array([x[0 + 1] for x in part if x["shard"] == shard]) for part in both]
        radii = [np.array([x["r"] for x in part if x["shard"] == shard]) for part in both]
        summary.append((shard, codes, radii))
    return Shards(stored, summary)


def possible_shards(index: Index, summary: list, q: np.ndarray, least: float) -> list[int]:
    """Shards whose greatest bound reaches ``least``."""
    halves = index.halves(q)
    lengths = [np.linalg.norm(h) for h in halves]
    products = [b @ h for b, h in zip(index.books, halves)]
    found = []
    for shard, codes, radii in summary:
        top = sum(float((p[c] + s * r).max()) for p, c, r, s in zip(products, codes, radii, lengths))
        if top + 1e-9 * (abs(top) + 1) >= least:
            found.append(shard)
    return found


QUERY = "id long, label long, x array<long>, anchor long, windows array<array<long>>, least array<long>, shard int"


def routed(anchors: DataFrame, index: Index, shards: Shards, mining: Mining, negatives: bool) -> DataFrame:
    """A row for each anchor and shard that can hold a result, with the floors that the sample gives."""
    summary = shards.summary

    def positive_floor(scores: np.ndarray, label: int, own: int) -> list[int]:
        same = scores[(index.sample_labels == label) & (index.sample_ids != own)]
        if len(same) < mining.positives:
            return [-(2**62)]
        return [int(-np.partition(-same, mining.positives - 1)[mining.positives - 1])]

    def negative_floors(scores: np.ndarray, label: int, own: int, windows: list) -> list[int]:
        other = scores[(index.sample_labels != label) & (index.sample_ids != own)]
        floors = []
        for low, high in windows:
            inside = other[(other >= low) & (other <= high)]
            full = len(inside) >= mining.negatives
            floors.append(int(-np.partition(-inside, mining.negatives - 1)[mining.negatives - 1]) if full else low)
        return floors

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "x", index.width)
            windows = batch.column("windows").to_pylist()
            labels, ids = batch.column("label").to_pylist(), batch.column("id").to_pylist()
            for at in range(0, len(x), 256):
                scores = x[at : at + 256].astype(float) @ index.sample.T
                take, where, least = [], [], []
                for k in range(len(scores)):
                    row = at + k
                    if negatives:
                        floors = negative_floors(scores[k], labels[row], ids[row], windows[row])
                    else:
                        floors = positive_floor(scores[k], labels[row], ids[row])
                    for shard in possible_shards(index, summary, x[row].astype(float), min(floors)):
                        take.append(row)
                        where.append(shard)
                        least.append(floors)
                part = batch.take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(least, pa.list_(pa.int64())), pa.array(where, pa.int32())],
                    names=[*part.schema.names, "least", "shard"],
                )

    return anchors.select("id", "label", "x", "anchor", "windows").mapInArrow(route, QUERY)


def searched(queries: DataFrame, index: Index, shards: Shards, mining: Mining, negatives: bool) -> DataFrame:
    """``anchor_id, anchor, slot, score, id``: what each shard has for the anchors sent to it."""
    index = index.light
    stored = shards.rows.select(
        "id",
        "label",
        "x",
        F.lit(None).cast("long").alias("anchor"),
        F.lit(None).cast("array<array<long>>").alias("windows"),
        F.lit(None).cast("array<long>").alias("least"),
        F.col("shard").cast("int").alias("shard"),
    )
    names = ("anchor_id", "anchor", "slot", "score", "id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, gathered = None, None, []
        for batch in batches:  # by shard, its rows first, then the anchors sent to it
            is_row = batch.column("anchor").is_null().to_numpy(zero_copy_only=False)
            number = batch.column("shard").to_numpy()
            if not len(number):
                continue
            edges = np.flatnonzero((np.diff(number) != 0) | np.diff(is_row.astype(int)) != 0) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(number)]):
                part = batch.slice(begin, end - begin)
                if number[begin] != at:
                    shard, at, gathered = None, number[begin], []
                if is_row[begin]:
                    gathered.append(part)
                    continue
                if shard is None:
                    parts = [(p.column("id").to_numpy(), p.column("label").to_numpy(), matrix(p, "x", index.width)) for p in gathered]
                    ids, labels, x = (np.concatenate(c) for c in zip(*parts))
                    shard, gathered = Shard(index, ids, labels, x.astype(float)), []
                yield found_for(shard, part)

    def found_for(shard: Shard, part: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        x = matrix(part, "x", index.width).astype(float)
        rest = (part.column(c).to_pylist() for c in ("id", "label", "anchor", "windows", "least"))
        for q, own, label, anchor, windows, least in zip(x, *rest):
            if negatives:
                results = shard.negatives(q, own, label, windows, least, mining.negatives)
            else:
                results = [shard.positives(q, own, label, least[0], mining.positives)]
            for slot, (scores, ids) in enumerate(results):
                for column, values in zip(out, ([own] * len(ids), [anchor] * len(ids), [slot] * len(ids), scores.tolist(), ids.tolist())):
                    column += values
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=list(names))

    both = stored.unionByName(queries)
    return (
        both.repartition(max(len(shards.summary), 1), "shard")
        .sortWithinPartitions("shard", F.col("anchor").isNotNull())
        .mapInArrow(search, ", ".join(f"{n} long" for n in names))
    )


def first_of(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(rows: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """Negatives for each anchor and positive.

    ``rows`` has vec_id, label and x, an array of longs; ``is_anchor`` is a condition on vec_id.
    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    sound = rows.where(
        F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull())
    ).select("vec_id", F.col("label").cast("long").alias("label"), F.col("x").cast("array<long>").alias("x"))
    width = common_length(sound, "x")
    if not width:
        return spark.createDataFrame([], schema)
    sound = sound.where(F.size("x") == width)
    most = F.max(F.array_max(F.transform("x", F.abs)))
    size = sound.agg(F.count("*").alias("n"), most.alias("most")).first()
    if size["most"] ** 2 * width >= 2**53:
        raise ValueError("components are too large for exact scores; use a smaller scale")
    named = sound.withColumn("id", F.coalesce(F.col("vec_id").cast("long"), F.lit(HIGHEST)))
    index = fit_index(named, width, mining)
    shards = store_index(named, index, size["n"], mining)
    anchors = (
        named.where(F.coalesce(is_anchor, F.lit(False)))
        .select("id", "label", "x", F.xxhash64("label", "x").alias("anchor"))
        .dropDuplicates(["id", "anchor"])
    )
    asked = anchors.withColumn("windows", F.lit(None).cast("array<array<long>>"))
    near = searched(routed(asked, index, shards, mining, False), index, shards, mining, False)
    positives = first_of(near, ["anchor_id", "anchor"], mining.positives).select(
        "anchor_id", "anchor", F.struct("rank", "id", "score").alias("p")
    )
    # Integer windows: the least score rounds up, the greatest down; empty ones are left out.
    score = F.col("p.score")
    low = -F.floor(-mining.least_percent * score / F.lit(100).cast("decimal(3,0)"))
    high = F.floor(mining.most_percent * score / F.lit(100).cast("decimal(3,0)"))
    positives = positives.withColumn("window", F.array(low.cast("long"), high.cast("long"))).where(low <= high)
    grouped = positives.groupBy("anchor_id", "anchor").agg(  # at most ``positives`` structs
        F.sort_array(F.collect_list(F.struct("p", "window"))).alias("ps")
    )
    path = fresh_path(spark, "positives")
    grouped.join(anchors.withColumnRenamed("id", "anchor_id"), ["anchor_id", "anchor"]).select(
        F.col("anchor_id").alias("id"), "label", "x", "anchor", F.col("ps.window").alias("windows"), F.col("ps.p").alias("positives")
    ).write.parquet(path)
    asked = spark.read.parquet(path)
    far = searched(routed(asked, index, shards, mining, True), index, shards, mining, True)
    ranked = first_of(far, ["anchor_id", "anchor", "slot"], mining.negatives)
    of = asked.select(F.col("id").alias("anchor_id"), "anchor", "positives")
    positive = F.element_at("positives", F.col("slot").cast("int") + 1)

    def named_id(c: Column) -> Column:
        return F.nullif(c, F.lit(HIGHEST))

    return ranked.join(of, ["anchor_id", "anchor"]).select(
        "anchor_id",
        named_id(positive["id"]).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        named_id(F.col("id")).alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
