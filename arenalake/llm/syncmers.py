"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor when its least s-mer hash stands at its first or last place.
That depends on the k-mer alone, so an edit moves or changes only the anchors that touch it. A
fingerprint is the sequence of all anchors of the whole text, five base-64 letters each, of one k and
s at every length, so any two fingerprints are comparable. Where a text has no anchor the hash of the
whole text is its only one. Two fingerprints are compared by position: the longest sequence of equal
anchors that keeps the order in both.

Defined results: a null text is the empty text, which has a fingerprint like any other; equal texts
have equal fingerprints and likeness 1; null ids sort below all others; rows with one id are
neighbours, ordered by a hash of the text and the text; one document alone is its own neighbour;
an empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.numeric_text import code_points, prefix_sums, span_hashes
from arenalake.llm.ordered import block_bounds, block_of, default_blocks, order_key

LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)
WIDTH = 5  # letters of six bits


def sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each run of ``window`` values, by doubling."""
    have, least = 1, values
    while have < window:
        step = min(have, window - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


#: (k, s) of each scale; all texts have all scales.
SCALES = ((12, 4),)
Anchors = list[np.ndarray]


def anchors(text: str) -> Anchors:
    """For each scale: hashes of the closed syncmers in text order, 30 bits each."""
    points = code_points(text)
    sums = prefix_sums(points)
    n = len(points)
    return [syncmers(sums, n, k, s) for k, s in SCALES]


def syncmers(sums: np.ndarray, n: int, k: int, s: int) -> np.ndarray:
    keep = np.empty(0, np.int64)
    if n >= k:
        at = np.arange(n - s + 1)
        small = span_hashes(sums, at, at + s)
        least = sliding_least(small, k - s + 1)
        keep = np.flatnonzero((small[: len(least)] == least) | (small[k - s :] == least))
    whole = (np.array([0]), np.array([n]))
    starts, ends = (keep, keep + k) if len(keep) else whole
    return (span_hashes(sums, starts, ends) >> np.uint64(34)).astype(np.uint32)


def to_text(found: Anchors) -> str:
    """The scales, coarse before fine, with a full stop between."""
    shifts = np.arange(6 * (WIDTH - 1), -1, -6, dtype=np.uint32)
    return ".".join(LETTERS[(a[:, None] >> shifts) & np.uint32(63)].tobytes().decode() for a in found)


def longest_rise(values: list[int]) -> int:
    ends: list[int] = []
    for v in values:
        k = bisect_left(ends, v)
        ends[k : k + 1] = [v]
    return len(ends)


def occurrences(found: np.ndarray) -> dict[tuple[int, int], int]:
    """Place of each (anchor, how many of it came before)."""
    seen: dict[int, int] = {}
    places = {}
    for place, a in enumerate(found.tolist()):
        n = seen.get(a, 0)
        seen[a] = n + 1
        places[a, n] = place
    return places


def likeness(a: Anchors, b: Anchors) -> float:
    """At the finest scale."""
    return matched_share(a[-1], b[-1])


def matched_share(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the anchors matched in order, over all anchors of both: 0 to 1."""
    total = len(a) + len(b)
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    matched = head + tail
    if len(a) and len(b) and len(np.intersect1d(a, b)):
        there = occurrences(b)
        matched += longest_rise([there[x] for x in occurrences(a) if x in there])
    return 2.0 * matched / total


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_edits(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike they are.

    The edited text has its last third replaced by the beginning of the next document, in
    descending order of ids, the first following the last. Blocks of ids are shuffled once; each
    also gets the first document of the next block, so that no text is read by one task alone.
    """
    blocks = blocks or default_blocks(docs)
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        order_key(F.col("doc_id")).alias("key"),
    )
    bounds = block_bounds(rows, blocks)
    placed = rows.withColumn("block", block_of(F.col("key"), bounds))
    # One id for each block that has rows: bounded by the number of blocks.
    tops = {r["block"]: r["key"] for r in placed.groupBy("block").agg(F.max("key").alias("key")).collect()}
    order = sorted(tops, reverse=True)
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the block whose last text needs b's first
    copies = [(tops[b], before[b]) for b in order]
    receives = F.lit(None).cast("int")
    if copies:
        known = F.create_map(*(F.lit(x) for pair in copies for x in pair))
        receives = F.try_element_at(known, F.col("key")).cast("int")
    sent = (
        placed.withColumn("to", F.when(receives.isNull(), F.array(F.col("block"))).otherwise(F.array("block", receives)))
        .select("*", F.posexplode("to").alias("ahead", "at"))
        .select("doc_id", "text", "key", "at", "ahead")
    )

    def neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # (block, doc_id, text, anchors) of the row that waits for its next one
        for frame in frames:
            out = []
            for doc_id, text, block, ahead in zip(frame["doc_id"], frame["text"], frame["at"], frame["ahead"]):
                if last is not None and last[0] == block:
                    mine = anchors(text)
                    out.append(compared(last, text, mine))
                    last = (block, doc_id, text, mine) if not ahead else None
                elif not ahead:
                    last = (block, doc_id, text, anchors(text))
            yield pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "Int64"})

    def compared(row: tuple, next_text: str, next_anchors: Anchors) -> tuple:
        _, doc_id, text, own = row
        cut = len(text) // 3
        edited = text[: len(text) - cut] + next_text[:cut]
        changed = anchors(edited)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        doc_id = None if pd.isna(doc_id) else int(doc_id)
        return (
            doc_id, len(text), digest, to_text(own), to_text(changed), likeness(own, changed), likeness(own, next_anchors),
        )

    return (
        sent.repartition(blocks, "at")
        .sortWithinPartitions("at", "ahead", F.desc("key"), F.xxhash64("text"), "text")
        .mapInPandas(neighbours, FIELDS)
    )


COLUMNS = [f.split()[0] for f in FIELDS.split(", ")]
