import random

import numpy as np
import pytest

from arenalake.llm import signature_join as sj
from arenalake.llm.components import components

from .helpers import awkward_rows, documents, keys_of, plain_components, words


def edited(text, seed, edits):
    r = random.Random(seed)
    found = text.split(" ")
    for _ in range(edits):
        found[r.randrange(len(found))] = f"new{r.randrange(10**6)}"
    return " ".join(found)


def family_rows():
    """Copies, near copies of all degrees, shared passages and unrelated texts."""
    rows = []
    passage = words(99, 60)
    for f in range(12):
        base = words(f, [6, 7, 9, 12, 20, 35, 60, 90, 150, 240, 400, 800][f])
        rows += [base, base, base.upper()]
        rows += [edited(base, 100 * f + e, e) for e in range(1, 9)]
        rows += [base + " " + words(1000 + f, n) for n in (1, 2, 5, 20)]
    rows += [passage + " " + words(2000 + k, 30) for k in range(30)]
    rows += [words(3000 + k, 1 + k % 9) for k in range(40)]
    return [(i, t, None, None, None) for i, t in enumerate(rows)]


def joined(spark, rows, rule, **options):
    return keys_of(sj.document_components(documents(spark, rows, clashing=True), rule, **options).collect())


def test_equals_comparing_all_sets(spark):
    rows = family_rows()
    for rule in (sj.Rule(4, 85), sj.Rule(5, 80)):
        expected = plain_components([r[:2] for r in rows], rule.words, rule.percent)
        assert joined(spark, rows, rule) == keys_of(expected)


def test_large_families_are_cut_into_blocks(spark):
    base = words(5, 100)
    rows = [(i, edited(base, i, 1 + i % 6), None, None, None) for i in range(120)]
    rule = sj.Rule(4, 85)
    expected = keys_of(plain_components([r[:2] for r in rows], 4, 85))
    assert joined(spark, rows, rule, block=16) == expected
    assert joined(spark, rows, rule, block=16, most_broadcast=0) == expected


def test_awkward_rows(spark):
    rows = awkward_rows()
    expected = keys_of(plain_components([r[:2] for r in rows], 5, 80))
    assert joined(spark, rows, sj.Rule()) == expected
    assert joined(spark, [], sj.Rule()) == keys_of([])


def test_linked_sets_share_a_routing_key():
    r = np.random.default_rng(1)
    rule = sj.Rule(4, 85)
    for n in [*range(1, 60), 100, 333, 1000, 4000]:
        for _ in range(10):
            a = np.unique(r.integers(0, 2**64, n, np.uint64))
            drop = int(r.integers(0, rule.most_different(n) + 1))
            new = int(r.integers(0, rule.most_different(n) + 1))
            b = np.unique(np.concatenate([a[drop:], r.integers(0, 2**64, new, np.uint64)]))
            if len(b) and rule.links(len(np.intersect1d(a, b)), len(a), len(b)) and sj.identity(a) != sj.identity(b):
                assert len(np.intersect1d(sj.routing_keys(a, rule), sj.routing_keys(b, rule))), (n, drop, new)


def test_sets_with_many_empty_segments_share_a_key():
    rule = sj.Rule(4, 85)
    a = np.arange(1, 41, dtype=np.uint64)  # all in one segment of the first seed
    b = np.concatenate([a[1:], np.array([77], np.uint64)])
    assert rule.links(39, 40, 40)
    assert len(np.intersect1d(sj.routing_keys(a, rule), sj.routing_keys(b, rule)))


def test_tree_finds_all_links_without_neighbours_in_order():
    r = np.random.default_rng(2)
    rule = sj.Rule(4, 85)
    bases = [np.unique(r.integers(0, 2**64, n, np.uint64)) for n in (30, 80, 81, 82, 300)]
    sets = [np.unique(np.concatenate([b[k % 9 :], r.integers(0, 2**64, k % 5, np.uint64)])) for b in bases for k in range(40)]
    m = sj.Members(rule, list(range(len(sets))), sets, list(range(len(sets))))
    links = list(sj.tree_links(m))
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in links:
        i, j = m.nodes[i], m.nodes[j]
        assert rule.links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))
        label[find(i)] = find(j)
    for i in range(len(sets)):
        for j in range(i):
            if rule.links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                assert find(i) == find(j)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100}


def test_low_percents_lose_no_link(spark):
    r = np.random.default_rng(3)
    for percent in (30, 50, 60, 70, 76, 77, 85):
        rule = sj.Rule(4, percent)
        for n in [*range(1, 40), 100, 333]:
            more = 100 * n // percent  # the largest set that a part of it can be linked with
            for m in {more, (n + more) // 2}:
                b = np.unique(r.integers(0, 2**64, m, np.uint64))
                if m > n and rule.links(n, n, m):
                    assert len(np.intersect1d(sj.routing_keys(b[:n], rule), sj.routing_keys(b, rule))), (percent, n, m)
    text = words(70, 30)  # 27 shingles of 4 words, and 19 of them
    rows = [(1, text, None, None, None), (2, " ".join(text.split(" ")[:22]), None, None, None)]
    assert joined(spark, rows, sj.Rule(4, 70)) == keys_of([(1, 27, 1), (2, 19, 1)])
    more = [(k, " ".join(words(80 + k // 9, 60).split(" ")[: 60 - 5 * (k % 9)]), None, None, None) for k in range(36)]
    assert joined(spark, more, sj.Rule(4, 60)) == keys_of(plain_components([x[:2] for x in more], 4, 60))


def test_percents_without_a_meaning_are_rejected():
    for percent in (-1, 0, 101):
        with pytest.raises(ValueError):
            sj.Rule(4, percent)


def test_keys_shared_by_chance_make_no_family(spark):
    text = [words(5000 + k, 60) for k in range(60)]
    shared = [words(6000 + k, 40) for k in range(60)]
    rows = [(k, f"{shared[k - 1]} {text[k]} {shared[k]}", None, None, None) for k in range(1, 60)]
    rows += [(100 + k, edited(text[k], k, 1) + " " + words(7000 + k, 10), None, None, None) for k in range(8)]
    rows += [(200 + k, text[k] + " " + words(7000 + k, 10), None, None, None) for k in range(8)]
    rule = sj.Rule(4, 85)
    docs = documents(spark, rows)
    own = {sj.identity(sj.shingles(r[1], rule)): r[0] for r in rows}
    found = {frozenset((own[e["a"]], own[e["b"]])) for e in sj.family_edges(docs, rule).collect()}
    assert found == {frozenset((100 + k, 200 + k)) for k in range(8)}
    assert joined(spark, rows, rule) == keys_of(plain_components([r[:2] for r in rows], 4, 85))


def test_linked_sets_share_as_many_keys_as_they_need():
    r = np.random.default_rng(4)
    for percent in (50, 70, 80, 85, 95):
        rule = sj.Rule(4, percent)
        for n in [*range(1, 60), 100, 333, 1000]:
            for _ in range(5):
                a = np.unique(r.integers(0, 2**64, n, np.uint64))
                drop = int(r.integers(0, rule.most_different(n) + 1))
                b = np.unique(np.concatenate([a[drop:], r.integers(0, 2**64, rule.most_different(n - drop), np.uint64)]))
                if len(b) and rule.links(len(np.intersect1d(a, b)), len(a), len(b)) and sj.identity(a) != sj.identity(b):
                    (of_a, need_a), (of_b, need_b) = sj.routing(a, rule), sj.routing(b, rule)
                    assert len(np.intersect1d(of_a, of_b)) >= max(need_a, need_b) >= 1, (percent, n, drop)


def test_hot_keys_hang_on_one_node():
    def rows(pairs):
        out = np.empty(len(pairs), sj.PAIR)
        out["key"], out["node"] = [k << 16 | need for k, _, need in pairs], [n for _, n, _ in pairs]
        return out

    many = range(10, 10 + sj.HOT + 1)
    left, hung = sj.stars(rows([(1, n, 3) for n in many] * 2 + [(2, n, 3) for n in many] + [(3, 5, 2), (3, 4, 1), (3, 4, 1)]))
    assert [(int(k) >> 16, int(k) & 0x7FFF, int(n)) for k, n in left.tolist()] == [(1, 3, 10), (2, 3, 10), (3, 1, 4), (3, 2, 5)]
    assert hung.tolist() == [(10, n, 2, 3) for n in many[1:]]
    # What others hang on is kept whatever it shares, and makes a key hot.
    left, hung = sj.stars(np.concatenate([left, rows([(1, 2, 9), (2, 99, 9)])]))
    assert hung.tolist() == [(2, 10, 1, 0), (10, 99, 1, 9)]
    assert sj.counted_size([]) == 1 and sj.counted_size([(2, 10), (3, 5), (40, 1)]) == 3
