"""N-gram Jaccard join with signature trees.

Documents are sets of hashed word shingles; equal sets are one node. The join has three steps:

1. Routing. A set is cut into segments by ranges of the hash. Two sets of similarity T percent
   differ in so few shingles that with one segment more than that some segment must be equal, so
   two linked sets share the key of a segment's content. The number of segments depends on a class of
   sizes; a set also takes part in the class below if it can have partners there. Empty segments
   don't route: there are some more segments than needed, and a set with too many empty ones is
   routed under another seed as well. A set's size and empty segments tell how many keys it shares
   at least with any partner. Nodes, and pairs counted by key, that share fewer are left out, so
   that what documents share by chance does not grow into one family; the others form families,
   and every link lies within a family.
2. Trees. The nodes of a family, in blocks of bounded size, form a signature tree: inner nodes hold
   the OR of their token bitmaps and their range of sizes. A dual traversal prunes pairs of tree
   nodes whose greatest possible overlap is too small, or whose documents are all linked already,
   and checks the remaining pairs exactly. Links that keep everything connected are emitted, not
   all pairs.
3. Families of several blocks. Each block is first joined with the family's pivot; what is still
   not connected is then joined block by block.

Defined results: a null text, or one without words, has no shingles and is linked with nothing (its
component is its own id); a text with fewer words than a shingle is one shingle of them all; rows
with one id are documents of their own; null ids never become component ids unless a component has
no other; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.llm.components import EDGE, components, written
from arenalake.llm.numeric_text import mix, prefix_sums, span_hashes
from arenalake.llm.ordered import default_blocks

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
SEEDS = 8


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the least similarity in percent."""

    words: int = 5
    percent: int = 80

    def __post_init__(self) -> None:
        if not 1 <= self.percent <= 100:
            raise ValueError(f"percent must be from 1 to 100, not {self.percent}")

    def links(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)

    def most_different(self, smaller: int) -> int:
        """The most shingles in one but not both of two linked sets, given the smaller size."""
        return (100 - self.percent) * smaller // self.percent


def shingles(text: str | None, rule: Rule) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    gaps = np.concatenate([[True], _SPACE[raw], [True]])
    starts = np.flatnonzero(gaps[:-1] & ~gaps[1:])
    ends = np.flatnonzero(~gaps[:-1] & gaps[1:])
    ends = ends[ends > 0] if len(starts) == len(ends) else ends
    if not len(starts):
        return np.empty(0, np.uint64)
    words = span_hashes(prefix_sums(raw), starts, ends)
    k = min(rule.words, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total = total * np.uint64(0x9FB21C651E98DF25) + mix(words[i : len(words) - k + 1 + i])
    return np.unique(mix(total))


def identity(found: np.ndarray) -> int:
    """A 64-bit number of the set."""
    total = np.add.reduce(mix(found ^ np.uint64(0xA5A5A5A55A5A5A5A)), keepdims=True)
    return int(mix(total + np.uint64(len(found))).view(np.int64)[0])


def size_class(n: int, percent: int) -> tuple[int, int, int]:
    """Number, first size, and end of the class of a size; classes grow by 1.3 or a link's ratio, if that is more."""
    k, low = 0, 1
    while True:
        end = max(low + 1, low * 13 // 10 + 1, low * 100 // percent + 1)
        if n < end:
            return k, low, end
        k, low = k + 1, end


def _segment_keys(found: np.ndarray, rule: Rule, k: int, end: int) -> tuple[list[np.ndarray], int]:
    """Keys of the class, and how many of them a linked set that takes part in the class has at least."""
    most = rule.most_different(end - 1)
    if not most:
        return [], 0  # only equal sets are linked, and those are one node
    spare = 1 + most // 12
    segments = most + 1 + spare
    out = []
    for seed in range(SEEDS):
        h = found if not seed else np.sort(mix(found + np.uint64(seed)))
        of = (h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        content = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), first)
        tag = np.uint64((k * SEEDS + seed + 1) * 0x2545F4914F6CDD1D % (1 << 64))
        out.append(mix(content + mix(of[first] + tag)))
        empty = segments - len(first)
        if empty <= spare:
            # All sets of the class have keys of seed 0; of a later seed a linked set may have none.
            own = rule.most_different(min(len(found), end - 1))
            return out, 1 if seed else segments - own - empty
    gone = np.setdiff1d(np.arange(segments, dtype=np.uint64), of[first])
    return [*out, mix(mix(gone + tag))], 1


def routing(found: np.ndarray, rule: Rule) -> tuple[np.ndarray, int]:
    """The keys of a set, and how many of them any set linked with it has at least."""
    n = len(found)
    if not n:
        return np.empty(0, np.uint64), 0
    k, low, end = size_class(n, rule.percent)
    classes = [_segment_keys(found, rule, k, end)]
    if k and n * rule.percent <= 100 * (low - 1):
        classes.append(_segment_keys(found, rule, k - 1, low))
    classes = [c for c in classes if c[0]]
    if not classes:
        return np.empty(0, np.uint64), 0
    return np.concatenate([x for keys, _ in classes for x in keys]), min(need for _, need in classes)


def routing_keys(found: np.ndarray, rule: Rule) -> np.ndarray:
    return routing(found, rule)[0]


def document_nodes(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node`` for each document; node is null for an empty set."""

    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, rule) for t in frame["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "text_hash": frame["text_hash"],
                    "n_shingles": [len(s) for s in sets],
                    "node": pd.array([identity(s) if len(s) else None for s in sets], "Int64"),
                }
            )

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return named.mapInPandas(describe, NODE)


NODE = "doc_id long, text_hash long, n_shingles long, node long"
#: ``key`` has 48 bits of a routing key, then a bit for a node on which others hang, then the node's need of keys.
PAIR = np.dtype([("key", "<u8"), ("node", "<i8")])
KEY_SHIFT, HUB, NEED = np.uint64(16), np.uint64(0x8000), np.uint64(0x7FFF)
HUNG = np.dtype([("a", "<i8"), ("b", "<i8"), ("n", "<i8"), ("need", "<i8")])
#: A key that more nodes have is hot: all of them hang on the least one.
HOT = 64
SHARED = "bucket long, a long, b long, n long, need long"


def family_edges(docs: DataFrame, rule: Rule) -> DataFrame:
    """Edges ``a, b`` that connect all nodes that may be linked.

    Many sets share a key or two by chance, the more the larger the table; linked sets share more. A node that
    shares fewer keys than it would with a partner is left out, and so is a pair that shares fewer. Pairs are
    counted per key, as long as they are at most twice the rows. The nodes of all other keys hang on the least one.
    """
    shared = written(shared_keys(docs, rule), "shared_keys", SHARED)
    single, hung = shared.where("bucket >= 0"), shared.where("bucket < 0")
    counts = (
        single.select("a", "n", "need")
        .unionByName(hung.select(F.col("b").alias("a"), "n", "need"))
        .unionByName(hung.select("a", "n", F.lit(0).cast("long").alias("need")))
    )
    enough = counts.groupBy("a").agg(F.sum("n").alias("n"), F.max("need").alias("need")).where("n >= need")
    enough = written(enough.select("a"), "enough", "a long")
    members = F.array_sort(F.collect_list(F.struct(F.col("a").alias("node"), "need")))
    left = single.select("bucket", "a", "need").join(enough, "a", "left_semi")
    buckets = written(
        left.groupBy("bucket").agg(members.alias("m")).where(F.size("m") > 1).select("m"),
        "buckets",
        "m array<struct<node: long, need: long>>",
    )
    sizes = buckets.groupBy(F.size("m").alias("size")).agg(F.count("*").alias("n")).collect()  # HOT rows at most
    most = counted_size([(r["size"], r["n"]) for r in sizes])
    small, large = buckets.where(F.size("m") <= most), buckets.where(F.size("m") > most)
    rest = lambda k: F.explode(F.slice("m", k, HOT)).alias("y")
    pairs = small.select("m", F.posexplode("m").alias("i", "x")).select("x", rest(F.col("i") + 2))
    counted = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
        F.count("*").alias("n"), F.max(F.greatest("x.need", "y.need")).alias("need")
    )
    stars = large.select(F.col("m")[0]["node"].alias("a"), rest(2)).select("a", F.col("y.node").alias("b"))
    kept = hung.where("need > 0").join(enough.withColumnRenamed("a", "b"), "b", "left_semi")
    hubs = hung.where("need = 0")
    edges = [counted.where("n >= need"), stars, kept, hubs]
    return reduce(DataFrame.unionByName, [e.select("a", "b") for e in edges]).distinct()


def counted_size(sizes: list[tuple[int, int]]) -> int:
    """The size up to which the pairs of all buckets are at most twice the rows of the table; of (size, buckets)."""
    room, most = 2 * sum(size * n for size, n in sizes), 1
    for size, n in sorted(sizes):
        room -= size * (size - 1) // 2 * n
        if room < 0:
            break
        most = size
    return most


def shared_keys(docs: DataFrame, rule: Rule) -> DataFrame:
    """The keys of several nodes: ``bucket, a, need`` for each node of a key, and for those of hot keys, with
    bucket -1, the node ``a`` on which ``b`` hangs, by ``n`` keys; ``need`` is 0 where others hang on ``b``.

    Each batch of a task hangs the nodes of its own hot keys and sends on one node of these, so a key that very
    many nodes have costs little. Keys and edges travel packed: one array of each for each partition.
    """
    parts = default_blocks(docs)

    def dealt(rows: np.ndarray, by: np.ndarray) -> list[bytes]:
        part = (by.astype(np.uint64) % np.uint64(parts)).astype(np.int64)
        ends = np.cumsum(np.bincount(part, minlength=parts))
        return [x.tobytes() for x in np.split(rows[np.argsort(part, kind="stable")], ends[:-1])]

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, nodes = [], []
            for text in frame["text"]:
                found = shingles(text, rule)
                own, need = routing(found, rule)
                if len(own):
                    keys.append((own >> KEY_SHIFT << KEY_SHIFT) | np.uint64(min(need, int(NEED))))
                    nodes.append(np.full(len(own), identity(found), np.int64))
            if not keys:
                continue
            rows = np.empty(sum(map(len, keys)), PAIR)
            rows["key"], rows["node"] = np.concatenate(keys), np.concatenate(nodes)
            left, hung = stars(rows)
            pairs = dealt(left, left["key"] >> KEY_SHIFT)
            yield pd.DataFrame({"part": range(parts), "pairs": pairs, "edges": dealt(hung, hung["b"])})

    def share(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, edges = [], []
        for frame in frames:
            pairs.extend(frame["pairs"])
            edges.extend(frame["edges"])
        left, own = stars(np.frombuffer(b"".join(pairs), PAIR))
        hung = counted_edges(np.concatenate([own, np.frombuffer(b"".join(edges), HUNG)]))
        key = left["key"] >> KEY_SHIFT
        same = np.concatenate([[False], key[1:] == key[:-1], [False]])
        left = left[same[1:] | same[:-1]] if len(left) else left
        if len(left):
            key, need = left["key"] >> KEY_SHIFT, left["key"] & NEED
            yield pd.DataFrame({"bucket": key.astype("i8"), "a": left["node"], "b": 0, "n": 1, "need": need.astype("i8")})
        if len(hung):
            yield pd.DataFrame({"bucket": -1, **{c: hung[c] for c in HUNG.names}})

    packed = docs.select("text").mapInPandas(pack, "part int, pairs binary, edges binary")
    return packed.repartition(parts, "part").mapInPandas(share, SHARED)


def stars(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (key, node) rows: distinct ones sorted by key, hot keys with the least node only; and what hangs on these."""
    rows = rows[np.lexsort((rows["key"] & HUB, rows["node"], rows["key"] >> KEY_SHIFT))]
    key = rows["key"] >> KEY_SHIFT
    rows = rows[np.append((key[1:] != key[:-1]) | (rows["node"][1:] != rows["node"][:-1]), len(rows) > 0)[: len(rows)]]
    if not len(rows):
        return rows, np.empty(0, HUNG)
    key, hub = rows["key"] >> KEY_SHIFT, (rows["key"] & HUB) > 0
    first = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, len(rows)))
    hot = np.repeat((size > HOT) | np.logical_or.reduceat(hub, start), size)
    others = hot & ~first
    hung = np.empty(int(others.sum()), HUNG)
    hung["a"], hung["b"], hung["n"] = np.repeat(rows["node"][start], size)[others], rows["node"][others], 1
    hung["need"] = np.where(hub[others], 0, rows["key"][others] & NEED)
    rows["key"][hot & first] |= HUB
    return rows[~others], counted_edges(hung)


def counted_edges(hung: np.ndarray) -> np.ndarray:
    """One row for each edge: the sum of its keys, the least need."""
    if not len(hung):
        return hung
    hung = hung[np.lexsort((hung["b"], hung["a"]))]
    first = np.concatenate([[True], (hung["a"][1:] != hung["a"][:-1]) | (hung["b"][1:] != hung["b"][:-1])])
    out = hung[first]
    out["n"] = np.add.reduceat(hung["n"], np.flatnonzero(first))
    out["need"] = np.minimum.reduceat(hung["need"], np.flatnonzero(first))
    return out


class Members:
    """Sets of one block, or of two, with the labels of the components known so far."""

    def __init__(self, rule: Rule, nodes: list[int], sets: list[np.ndarray], labels: list[int]) -> None:
        order = sorted(range(len(nodes)), key=lambda i: (len(sets[i]), sets[i][:2].tolist(), nodes[i]))
        self.rule = rule
        self.nodes = [nodes[i] for i in order]
        self.sets = [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.root = np.array([labels[i] for i in order], np.int64)
        self.bits = self._bitmaps()
        self.surplus = self.sizes - np.bitwise_count(self.bits).sum(1)

    def _bitmaps(self) -> np.ndarray:
        width = 64
        while width < 4 * int(self.sizes.max()) and width < 8192:
            width *= 2
        out = np.zeros((len(self.sets), width), bool)
        for row, found in zip(out, self.sets):
            row[(found & np.uint64(width - 1)).astype(np.int64)] = True
        return np.packbits(out, axis=1).view(np.uint64)

    def linked(self, i: int, j: int) -> bool:
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        if 100 * len(a) < self.rule.percent * len(b):
            return False
        place = np.minimum(np.searchsorted(b, a), len(b) - 1)
        return self.rule.links(int((b[place] == a).sum()), len(a), len(b))

    def join(self, i: int, j: int) -> None:
        self.root[self.root == self.root[j]] = self.root[i]


class Tree:
    """Levels of a signature tree: OR of bitmaps, range of sizes, most tokens that share a bit."""

    FAN = 8

    def __init__(self, m: Members) -> None:
        self.levels = [(m.bits, m.sizes, m.sizes, m.surplus)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, surplus = self.levels[-1]
            cut = np.arange(0, len(bits), self.FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(surplus, cut),
                )
            )

    def span(self, level: int, k: int, total: int) -> slice:
        width = self.FAN**level
        return slice(k * width, min((k + 1) * width, total))


def tree_links(m: Members) -> Iterator[tuple[int, int]]:
    """Pairs of members that are linked, enough to connect all that are."""
    total, percent = len(m.nodes), m.rule.percent
    for i in range(1, total):  # neighbours in order, and the first: most of a group of copies
        for j in {i - 1, 0}:
            if m.root[i] != m.root[j] and m.linked(i, j):
                m.join(i, j)
                yield i, j
    if (m.root == m.root[0]).all():
        return
    tree = Tree(m)
    top = len(tree.levels) - 1
    stack = [(top, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        ra, rb = m.root[tree.span(level, a, total)], m.root[tree.span(level, b, total)]
        if (ra == ra[0]).all() and (rb == ra[0]).all():
            continue
        bits, low, high, surplus = tree.levels[level - 1]
        ca = np.arange(a * Tree.FAN, min((a + 1) * Tree.FAN, len(bits)))
        cb = np.arange(b * Tree.FAN, min((b + 1) * Tree.FAN, len(bits)))
        x, y = np.repeat(ca, len(cb)), np.tile(cb, len(ca))
        once = x <= y if level > 1 else x < y
        if a == b:
            x, y = x[once], y[once]
        both = np.bitwise_count(bits[x] & bits[y]).sum(1)
        if level > 1:
            most = both + np.minimum(surplus[x], surplus[y])
            most = np.minimum(most, np.minimum(high[x], high[y]))
        else:
            own = np.bitwise_count(bits).sum(1) if len(bits) < 64 else None
            of_x = np.bitwise_count(bits[x]).sum(1) if own is None else own[x]
            of_y = np.bitwise_count(bits[y]).sum(1) if own is None else own[y]
            most = np.minimum(low[x] - (of_x - both), low[y] - (of_y - both))
        may = most * (100 + percent) >= percent * (low[x] + low[y])
        x, y = x[may], y[may]
        if level > 1:
            stack += zip([level - 1] * len(x), x.tolist(), y.tolist())
            continue
        for i, j in zip(x.tolist(), y.tolist()):
            if m.root[i] != m.root[j] and m.linked(i, j):
                m.join(i, j)
                yield i, j


def grouped(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[list[tuple]]:
    """Rows of frames sorted by the keys and node, by group: one row for each node, one group at a time."""
    rows = (row for frame in frames for row in frame.itertuples(index=False))
    for _, group in groupby(rows, key=lambda r: tuple(getattr(r, k) for k in keys)):
        yield [next(same) for _, same in groupby(group, key=lambda r: r.node)]


def block_links(rows: DataFrame, keys: list[str], rule: Rule, parts: int) -> DataFrame:
    """Links within each group of ``node, text, label``."""

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in grouped(frames, keys):
            m = Members(rule, [r.node for r in group], [shingles(r.text, rule) for r in group], [r.label for r in group])
            found = [(m.nodes[i], m.nodes[j]) for i, j in tree_links(m)]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, "node").mapInPandas(find, EDGE)


def document_components(docs: DataFrame, rule: Rule = Rule(), **options) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each document: the least id of the documents linked with it."""
    nodes, joined = linked_nodes(docs, rule, **options)
    of_node = nodes.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = of_node.join(joined, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_each = rooted.join(ids, "root").select("node", "component_id")
    return nodes.join(of_each, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def document_groups(docs: DataFrame, rule: Rule = Rule(), **options) -> DataFrame:
    """``doc_id, text_hash, n_shingles, root`` for each document; the root names its group, null without words."""
    nodes, joined = linked_nodes(docs, rule, **options)
    return nodes.join(joined, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("root", "node").alias("root")
    )


def representatives(groups: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n``: one text of each group, of the lowest id and hash, and how many rows have it.

    Documents without words are in no group and not among these.
    """
    rows = groups.where("root IS NOT NULL").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("d")
    return rows.groupBy("root").agg(least).select("d.doc_id", "d.text_hash", "d.n")


def linked_nodes(
    docs: DataFrame, rule: Rule, block: int = 2_048, most_broadcast: int = 1_000_000
) -> tuple[DataFrame, DataFrame]:
    """The node of each document, and the roots of the nodes that are linked with others."""
    parts = default_blocks(docs)
    nodes = written(document_nodes(docs, rule), "join_nodes", NODE)
    families = written(components(family_edges(docs, rule), "families"), "families", "node long, root long")
    large = written(
        families.groupBy("root").agg(F.count("*").alias("size")).where(F.col("size") > block),
        "large",
        "root long, size long",
    )
    if large.count() <= most_broadcast:  # two numbers a row; then no family is moved for its size
        large = F.broadcast(large)
    blocks = F.coalesce(F.ceil(F.col("size") / block).cast("int"), F.lit(1))
    placed = written(
        families.join(large, "root", "left").select(
            "node",
            F.col("root").alias("family"),
            blocks.alias("blocks"),
            F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"),
        ),
        "placed",
        "node long, family long, blocks int, block int",
    )
    texts = member_texts(docs, nodes, placed, most_broadcast, rule)
    # The pivot, whose node names the family, goes to all of the family's blocks.
    everywhere = (F.col("node") == F.col("family")) & (F.col("blocks") > 1)
    at = F.when(everywhere, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = texts.withColumn("label", F.col("node")).withColumn("at", F.explode(at))
    links = written(block_links(first, ["family", "at"], rule, parts), "links", EDGE)
    if not placed.where("blocks > 1").isEmpty():
        links = links.unionByName(between_blocks(texts, placed, links, rule, parts))
    return nodes, components(links, "linked")


def member_texts(docs: DataFrame, nodes: DataFrame, placed: DataFrame, most_broadcast: int, rule: Rule) -> DataFrame:
    """One text for each node of a family, with the node's place."""
    chosen = (
        nodes.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"))).alias("d"))
        .join(placed, "node")
        .select(F.col("d.doc_id").alias("member"), "node", "family", "blocks", "block")
    )
    if placed.count() <= most_broadcast:  # five numbers a row; beyond that the texts are shuffled
        chosen = F.broadcast(chosen)
    both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        chosen, F.col("doc_id").eqNullSafe(F.col("member"))
    )

    def of_node(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of rows with one id, those whose set the node stands for; of repeated rows one a batch."""
        for frame in frames:
            frame = frame.drop_duplicates(["node", "text"])
            right = [identity(shingles(t, rule)) == n for t, n in zip(frame["text"], frame["node"])]
            yield frame[right].drop_duplicates("node")

    return both.select("node", "family", "blocks", "block", "text").mapInPandas(
        of_node, "node long, family long, blocks int, block int, text string"
    )


def between_blocks(texts: DataFrame, placed: DataFrame, links: DataFrame, rule: Rule, parts: int) -> DataFrame:
    """Links between blocks of families that the first round left in several components."""
    known = written(components(links, "round"), "round", "node long, root long")
    big = placed.where("blocks > 1").join(known, "node", "left")
    labels = big.select("node", "family", F.coalesce("root", "node").alias("label"))
    open_ones = labels.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    members = texts.where("blocks > 1").join(
        labels.join(open_ones.select("family"), "family").select("node", "label"), "node"
    )
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o != F.col("block")))
    pairs = members.withColumn("other", other).select(
        "node", "family", "text", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    return block_links(pairs, ["family", "i", "j"], rule, parts)
