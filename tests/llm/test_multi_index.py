"""Hard negatives against brute force, and how the index walks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.llm import multi_index
from arenalake.llm.multi_index import Mining
from arenalake.llm.queries import OP12_SQL, op12_hard_negatives
from tests.compare import assert_same, duck

HIGHEST = 2**63 - 1


def plain(rows, is_anchor, mining):
    """All scores of all rows."""
    sound = [(HIGHEST if i is None else i, label, np.array(x)) for i, label, x in rows if label is not None and x is not None and None not in x]
    out = []
    seen = set()
    for own, label, q in sound:
        if own == HIGHEST or not is_anchor(own) or (own, label, tuple(q)) in seen:
            continue
        seen.add((own, label, tuple(q)))
        scored = sorted((-int(x @ q), i, other) for i, other, x in sound if i != own)
        for s, p, _ in [t for t in scored if t[2] == label][: mining.positives]:
            inside = [
                t for t in scored if t[2] != label and mining.least_percent * -s <= 100 * -t[0] <= mining.most_percent * -s
            ]
            out += [(own, p, k + 1, t[1], -s, -t[0]) for k, t in enumerate(inside[: mining.negatives])]
    return sorted((a, b if b != HIGHEST else -1, c, d if d != HIGHEST else -1, e, f) for a, b, c, d, e, f in out)


def mined(spark, rows, mining, step=10):
    frame = spark.createDataFrame(rows, "vec_id long, label int, x array<long>").withColumn("shard", F.lit("clash"))
    got = multi_index.mine(frame, F.col("vec_id") % step == 0, mining).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def clustered(random, n, width, labels=4, noise=0.4):
    centres = random.normal(size=(labels, width))
    own = random.integers(0, labels, n)
    x = centres[own] + noise * random.normal(size=(n, width))
    return [(k, int(c), np.floor(64 * v).astype(int).tolist()) for k, (c, v) in enumerate(zip(own, x))]


def test_query_against_sql(spark):
    for sf in ("sf0.001", "sf0.1"):
        folder = f"/root/testdata/{sf}"
        assert_same(op12_hard_negatives(spark, folder), duck(folder), OP12_SQL)


@pytest.mark.parametrize("seed,width", [(1, 12), (2, 5), (3, 1)])
def test_many_shards_and_small_samples_against_brute_force(spark, seed, width):
    rows = clustered(np.random.default_rng(seed), 2500, width)
    rows += [(5000 + k, 1, rows[7][2]) for k in range(600)]  # a large group of copies
    mining = Mining(codewords=6, sample_rows=50, shard_rows=300)
    assert mined(spark, rows, mining, 100) == plain(rows, lambda i: i % 100 == 0, mining)


def test_odd_rows(spark):
    rows = clustered(np.random.default_rng(9), 120, 6)
    rows += [(None, 1, rows[0][2]), (None, 2, rows[3][2]), (200, None, [1] * 6), (201, 1, None), (202, 1, [1, 2, None, 4, 5, 6])]
    rows += [rows[10], rows[10], (20, 3, rows[11][2])]  # a repeated anchor, and a second row of an anchor's id
    mining = Mining(codewords=4, positives=3, negatives=4)
    assert mined(spark, rows, mining) == plain(rows, lambda i: i % 10 == 0, mining)
    shorter = rows + [(300, 1, [1, 2])]  # another length takes no part
    assert mined(spark, shorter, mining) == plain(rows, lambda i: i % 10 == 0, mining)


def test_ties_zeros_and_negative_scores(spark):
    rows = [(k, k % 3, [k % 2, 0]) for k in range(60)] + [(100 + k, k % 3, [-(k % 4), 1]) for k in range(60)]
    mining = Mining(codewords=3, positives=4, negatives=5, most_percent=100, least_percent=0)
    assert mined(spark, rows, mining) == plain(rows, lambda i: i % 10 == 0, mining)


def test_nothing_to_mine(spark):
    assert mined(spark, [], Mining()) == []
    assert mined(spark, [(0, 1, [1, 2])], Mining()) == []
    assert mined(spark, [(0, None, [1, 2]), (1, 1, None)], Mining()) == []
    with pytest.raises(ValueError):
        mined(spark, [(0, 1, [2**30, 0]), (1, 2, [1, 1])], Mining())


def test_multi_sequence_visits_all_pairs_by_falling_sum():
    random = np.random.default_rng(4)
    a, b = random.normal(size=7), random.normal(size=5)
    walk = list(multi_index.by_falling_bound(a, b))
    assert len({(i, j) for _, i, j in walk}) == 35
    assert [s for s, _, _ in walk] == sorted((s for s, _, _ in walk), reverse=True)
    assert all(s == a[i] + b[j] for s, i, j in walk)


def test_cells_are_skipped_once_windows_are_certified():
    random = np.random.default_rng(6)
    centres = np.array([[1, 0, 0, 0, 0, 0], [0, 0, 0, 1, 0, 0], [-1, 0, 0, 0, 0, 1], [0, -1, 0, 0, -1, 0]]) * 200
    own = random.integers(0, 4, 4000)
    x = (centres[own] + random.integers(-5, 6, (4000, 6))).astype(float)
    labels = own.astype(np.int64)
    books = tuple(multi_index.codebook(p, 4) for p in (x[:, :3], x[:, 3:]))
    index = multi_index.Index(6, books, np.empty((0, 6)), labels[:0], labels[:0])
    shard = multi_index.Shard(index, np.arange(4000), labels, x)
    scored = []
    plain_scored = shard.scored
    shard.scored = lambda pending, q, o: (scored.extend(pending), plain_scored(pending, q, o))[1]
    k = int(np.flatnonzero(own == 0)[0])
    scores, ids = shard.positives(x[k], k, 0, -(2**62), 5)
    full = sorted(((-int(v @ x[k]), i) for i, v in enumerate(x) if i != k and labels[i] == 0))[:5]
    assert list(zip((-scores).tolist(), ids.tolist())) == full
    assert sum(e - b for b, e in scored) < 2000


def test_window_of_a_score():
    mining = Mining()
    for score in range(-50, 200):
        low, high = mining.window(score)
        inside = [v for v in range(-300, 300) if 30 * score <= 100 * v <= 90 * score]
        assert inside == list(range(low, high + 1)) if low <= high else inside == []
