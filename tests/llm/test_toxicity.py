import numpy as np
from pyspark.sql import functions as F

from arenalake.llm import toxicity
from arenalake.sources.tables import read_table

from .helpers import awkward_rows, documents, words


def plain_subwords(word, buckets, shortest, longest):
    one, begin = toxicity.subwords([word], buckets, shortest, longest)
    return sorted(one.tolist())


def test_subwords_of_a_batch_equal_those_of_each_word():
    found = [b"a", b"idiot", "größe".encode(), b"x" * 40]
    subs, begin = toxicity.subwords(found, 1000, 3, 5)
    for k, w in enumerate(found):
        framed = len(w) + 2
        assert begin[k + 1] - begin[k] == 1 + sum(max(0, framed - n + 1) for n in (3, 4, 5))
        assert sorted(subs[begin[k] : begin[k + 1]].tolist()) == plain_subwords(w, 1000, 3, 5)


def made(n, seed):
    rows = []
    for k in range(n):
        text = words(seed + k, 40).split(" ")
        bad = k % 3 == 0
        if bad:
            text[k % 40] = ("grumblefoo", "snarkleboo")[k % 2]
            text[(k * 7) % 40] = "grumblefool"
        rows.append((seed + k, " ".join(text), int(bad)))
    return rows


def test_learns_words_and_their_misspellings(spark):
    rows = made(400, 0)
    docs = documents(spark, [(i, t, None, None, None) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, sample_rows=600)
    test = made(150, 10_000)
    extra = [(k, words(500 + k, 36) + " grumblefoooo xgrumblefoo grumblefo0 grumble-foo" * (k % 2), k % 2) for k in range(60)]
    got = toxicity.score(documents(spark, [(i, t, None, None, None) for i, t, _ in test + extra]), model)
    found = {r["doc_id"]: r["score"] for r in got.collect()}
    assert np.mean([found[i] >= 0.3 for i, _, y in test if y]) > 0.9
    assert np.mean([found[i] >= 0.3 for i, _, y in test if not y]) < 0.1
    assert np.mean([found[k] for k in range(1, 60, 2)]) > np.mean([found[k] for k in range(0, 60, 2)]) + 0.2


def held_out(spark, folder):
    """Scores of held-out toxic documents and of the others."""
    docs, labels = (read_table(spark, folder, n) for n in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.fit(docs, labels.where(~fold))
    rows = toxicity.score(docs.join(labels.where(fold), "doc_id", "left_semi"), model).join(labels, "doc_id").collect()
    bad = np.array([r["toxic"] == 1 for r in rows])
    score = np.array([r["score"] for r in rows])
    ranks = score.argsort().argsort()
    area = (ranks[bad].mean() - (bad.sum() - 1) / 2) / (~bad).sum()
    return area, (score[bad] >= 0.3).mean(), (score[~bad] >= 0.3).mean()


def test_held_out_labels(spark):
    area, found, wrong = held_out(spark, "/root/testdata/sf0.1")
    assert area > 0.9 and wrong < 0.06 and found > 0.6


def test_held_out_labels_after_a_few_hundred(spark):
    area, found, wrong = held_out(spark, "/root/testdata/sf0.01")
    assert found > 0.6 and wrong < 0.03, (area, found, wrong)


def test_telling_words():
    docs = [toxicity.Counts([b"the", b"bad" if k % 4 == 0 else b"good", b"w%d" % k], [2, 1, 1], k % 4 == 0) for k in range(40)]
    assert toxicity.telling_words(docs, 4.0) == {b"bad", b"good"}
    assert docs[0].shares({b"bad": 5})[0].tolist() == [5] and docs[0].shares({})[1].tolist() == [0]


def test_awkward_rows_and_labels(spark):
    docs = documents(spark, awkward_rows(), clashing=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert max(r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()) < 1e-9
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, toxic int")
    assert min(r["score"] for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()) > 0.99
    both = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (4, 0), (3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, both, buckets=1 << 10)
    found = toxicity.score(docs, model, kept=3).collect()
    assert len(found) == len(awkward_rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (3, 4, 5)}) == 1
    assert toxicity.score(documents(spark, []), model).count() == 0
