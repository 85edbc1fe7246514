"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams and itself, hashed into buckets; its vector is the mean
of their embeddings, a document's the mean of its words' and of a few zero vectors, and a linear layer
with a softmax follows.
Embeddings and layer are trained together in numpy on at most ``sample_rows`` labelled documents,
half of them of each class where there are as many. Unseen spellings share n-grams with known ones.

With few labels, thousands of words that a document has by chance would explain its label. So a second table of
embeddings learns from words alone whose share of documents differs between the classes beyond chance, while the
scores of single other words are held at zero, so that shared n-grams mean nothing. The evidence of both adds up.

The fitted model is linear in the buckets, so a score needs one number per bucket: that table goes
to the tasks (its size is a parameter), which score whole texts.

Defined results: a null or empty text has no words and gets the score of the bias alone; without
labels of both classes every score is the share of toxic labels, 0 without labels; of several
labels of a document the highest counts; null ids are never learned from. Scores depend on the text
alone, so repeated rows get equal scores. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.numeric_text import prefix_sums, span_hashes

#: Words of no meaning that every document has besides its own: few words are weak evidence.
NEUTRAL = 5

# Lower-case ASCII, and white space in place of ASCII punctuation; other bytes stay.
_FOLD = bytes(
    32 if c < 128 and not chr(c).isalnum() else ord(chr(c).lower()) if c < 128 else c for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()


def subwords(words: list[bytes], buckets: int, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of ``<word>`` and of the word itself, and where each word's begin."""
    framed = [b"<" + w + b">" for w in words]
    sums = prefix_sums(np.frombuffer(b"".join(framed), np.uint8))
    sizes = np.array([len(w) for w in framed], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    counts = 1 + sum(np.maximum(sizes - n + 1, 0) for n in range(shortest, longest + 1))
    begin = np.concatenate([[0], np.cumsum(counts)])
    at = begin[:-1].copy()
    out = np.empty(begin[-1], np.int64)
    out[at] = span_hashes(sums, starts, ends) % np.uint64(buckets)
    at += 1
    for n in range(shortest, longest + 1):
        many = np.maximum(sizes - n + 1, 0)
        total = int(many.sum())
        place = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        first = np.repeat(starts, many) + place
        hashes = span_hashes(sums, first, first + n)
        out[np.repeat(at, many) + place] = (hashes * np.uint64(2 * n + 1)) % np.uint64(buckets)
        at += many
    return out, begin


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of each bucket, embeddings times the difference of the layer's two rows
    bias: float
    shortest: int
    longest: int

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        found, begin = subwords(words, len(self.weights), self.shortest, self.longest)
        return np.add.reduceat(self.weights[found], begin[:-1]) / np.diff(begin)


@dataclass(frozen=True)
class Counts:
    """The words of a labelled document, how often it has each, and its label."""

    words: list[bytes]
    counts: list[int]
    toxic: bool

    def shares(self, numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that have one, and each one's share of all words."""
        own = [(numbers[w], c) for w, c in zip(self.words, self.counts) if w in numbers] or [(0, 0)]
        found, counts = zip(*own)
        return np.array(found, np.int32), (np.array(counts) / (sum(self.counts) + NEUTRAL)).astype(np.float32)


def telling_words(docs: list[Counts], least: float, rows: int = 3) -> set[bytes]:
    """Words of at least ``rows`` documents whose share differs between the classes by ``least`` standard errors."""
    size = [sum(d.toxic == c for d in docs) for c in (False, True)]
    have = [Counter(w for d in docs if d.toxic == c for w in d.words) for c in (False, True)]
    found = set()
    for w in have[0].keys() | have[1].keys():
        both = have[0][w] + have[1][w]
        if rows <= both < len(docs):
            p = both / len(docs)
            error = np.sqrt(p * (1 - p) * (1 / size[0] + 1 / size[1]))
            if abs(have[1][w] / size[1] - have[0][w] / size[0]) >= least * error:
                found.add(w)
    return found


def bucket_shares(
    vocabulary: list[bytes], bags: list[tuple[np.ndarray, np.ndarray]], buckets: int, shortest: int, longest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many buckets each document has, these buckets, and their weights in its vector."""
    subs, begin = subwords(vocabulary, buckets, shortest, longest)
    subs, many = subs.astype(np.int32), np.diff(begin)
    columns, parts = [], []
    for words, shares in bags:
        found, where = np.unique(subs[_ranges(begin[words], many[words])], return_inverse=True)
        columns.append(found)
        parts.append(np.bincount(where, np.repeat(shares / many[words], many[words])).astype(np.float32))
    return np.array([len(c) for c in columns], np.int64), np.concatenate(columns), np.concatenate(parts)


def train(
    docs: list[Counts],
    share: float,
    telling: float | None = None,
    buckets: int = 1 << 17,
    size: int = 4,
    shortest: int = 3,
    longest: int = 5,
    epochs: int = 12,
    least_steps: int = 600,
    batch: int = 64,
    rate: float = 0.05,
    decay: float = 3e-4,
    held: float = 0.01,
    held_words: int = 512,
    seed: int = 7,
) -> Model | None:
    """Adam over minibatches, at least ``least_steps`` of them. ``share`` is that of toxic documents outside the sample.

    With ``telling``, only such words tell documents apart, and ``held_words`` others a step are held at zero.
    """
    random = np.random.default_rng(seed)
    every = sorted({w for d in docs for w in d.words})
    kept = every if telling is None else sorted(telling_words(docs, telling))
    if not kept:
        return None
    numbers = {w: k for k, w in enumerate(kept)}
    others = [] if telling is None else [w for w in every if w not in numbers]
    sizes, columns, parts = bucket_shares(kept, [d.shares(numbers) for d in docs], buckets, shortest, longest)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    other_subs, other_begin = subwords(others, buckets, shortest, longest) if others else (None, None)
    toxic = np.array([d.toxic for d in docs])
    params = {
        "e": random.normal(0, 0.1, (buckets, size)).astype(np.float32),
        "w": random.normal(0, 0.5, (size, 2)).astype(np.float32),
        "b": np.zeros(2, np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    target = np.eye(2, dtype=np.float32)[toxic.astype(int)]
    in_epoch = -(-len(docs) // batch)
    epochs = max(epochs, -(-least_steps // in_epoch)) if telling is not None else epochs
    steps = 0
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        order = random.permutation(len(docs))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            many = sizes[rows]
            inner = _ranges(begin[rows], many)
            hit, part = columns[inner], parts[inner]
            vectors = np.add.reduceat(params["e"][hit] * part[:, None], np.cumsum(many) - many)
            logits = vectors @ params["w"] + params["b"]
            p = np.exp(logits - logits.max(1, keepdims=True))
            off = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = np.repeat(off @ params["w"].T, many, axis=0) * part[:, None]
            layer_grad = vectors.T @ off
            if others:
                words = random.integers(0, len(others), held_words)
                subs = np.diff(other_begin)[words]
                hit_too = other_subs[_ranges(other_begin[words], subs)]
                inverse = np.repeat(1 / subs, subs).astype(np.float32)[:, None]
                found = np.add.reduceat(params["e"][hit_too] * inverse, np.cumsum(subs) - subs)
                layer = params["w"][:, 1] - params["w"][:, 0]
                pull = (2 * held / held_words) * (found @ layer)
                back = np.concatenate([back, np.repeat(pull[:, None] * layer, subs, axis=0) * inverse])
                hit = np.concatenate([hit, hit_too])
                layer_grad = layer_grad + np.outer(pull @ found, [-1, 1])
            of_each = [np.bincount(hit, back[:, d], buckets) for d in range(size)]
            grads = {
                "e": np.stack(of_each, 1).astype(np.float32) + np.float32(decay / len(rows)) * params["e"],
                "w": layer_grad,
                "b": off.sum(0),
            }
            steps += 1
            for name, g in grads.items():
                m, v = moments[name]
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                root = np.sqrt(v / np.float32(1 - 0.99**steps)) + np.float32(1e-8)
                params[name] -= np.float32(pace / (1 - 0.9**steps)) * m / root
    layer = params["w"][:, 1] - params["w"][:, 0]
    seen = float(toxic.mean())
    shift = np.log(share / (1 - share)) - np.log(seen / (1 - seen))
    return Model(params["e"] @ layer, float(params["b"][1] - params["b"][0] + shift), shortest, longest)


def train_both(docs: list[Counts], share: float, telling: float, **options) -> Model:
    """Two tables of embeddings under one softmax: the evidence of all words and that of telling ones add up."""
    every, some = train(docs, share, **options), train(docs, share, telling, **options)
    if some is None:
        return every
    prior = float(np.log(share / (1 - share)))
    return Model(every.weights + some.weights, every.bias + some.bias - prior, every.shortest, every.longest)


def sample_labels(labels: DataFrame, sample_rows: int) -> tuple[DataFrame, float]:
    """At most ``sample_rows`` labelled ids, half of each class, by a hash of the id; and the toxic share."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = known.agg(F.avg("toxic").alias("s")).first()["s"]
    halves = [
        known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2)
        for c in (0, 1)
    ]
    return halves[0].unionByName(halves[1]), float(share or 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 6_000, telling: float = 4.0, **options) -> Model:
    """Train on a bounded sample, of which the driver gets word counts."""
    sample, share = sample_labels(labels, sample_rows)
    # At most sample_rows pairs of numbers: a bounded broadcast.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("of_text")).join(F.broadcast(sample), "doc_id")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counted = [Counter(words_of(t)) for t in frame["text"]]
            columns = {"words": [list(c) for c in counted], "counts": [list(c.values()) for c in counted]}
            yield pd.DataFrame({"doc_id": frame["doc_id"], "of_text": frame["of_text"], "toxic": frame["toxic"], **columns})

    counts = rows.mapInPandas(count, "doc_id long, of_text long, toxic int, words array<binary>, counts array<long>")
    read = sorted(counts.toLocalIterator(), key=lambda r: (r["doc_id"], r["of_text"]))
    found = [Counts([bytes(w) for w in r["words"]], r["counts"], r["toxic"] == 1) for r in read if r["words"]]
    if len({d.toxic for d in found}) < 2:
        odds = np.log(share / (1 - share)) if 0 < share < 1 else 50.0 if share else -800.0
        return Model(np.zeros(1), float(odds), 3, 3)
    return train_both(found, share, telling, **options)


def score(docs: DataFrame, model: Model, kept: int = 200_000, column: str = "score") -> DataFrame:
    """``doc_id`` and the score of each whole text."""

    def scores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, float] = {}
        for frame in frames:
            logits = []
            for at in range(0, len(frame), 256):
                bags = [words_of(t) for t in frame["text"].iloc[at : at + 256]]
                new = list(set().union(*bags) - known.keys())
                if len(known) + len(new) > kept:
                    known, new = {}, list(set().union(*bags))
                known.update(zip(new, model.word_scores(new).tolist()))
                logits += [model.bias + sum(map(known.__getitem__, b)) / (len(b) + NEUTRAL) for b in bags]
            p = 1 / (1 + np.exp(-np.clip(np.array(logits), -700, 700)))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), column: p})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        scores, f"doc_id long, {column} double"
    )
