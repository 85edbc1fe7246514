import numpy as np
from pyspark.sql import functions as F

from arenalake.llm import quality_rules as qr
from arenalake.sources.tables import read_table

from .helpers import awkward_rows, documents, plain_stats, words

SMALL = "/root/testdata/sf0.001"
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_equal_plain_counts(spark):
    part = words(1, 11)
    texts = [part + " " + part, f"{part} x {part} {part}", "a a a a a a a a a a a a", "one\none\n \none\n", "#*$%&|<> !?", words(2, 8)]
    texts += [words(3, 7), (words(4, 20) + "\n") * 3, "\x1c\x1d \x85 a　b", words(5, 9) + " " + words(5, 9)]
    rows = awkward_rows() + [(20 + k, t, None, None, None) for k, t in enumerate(texts)]
    out = qr.judge(documents(spark, rows, clashing=True), [], "__").collect()
    assert len(out) == len(rows)
    for r in out:
        stats = plain_stats(r["text"])
        assert tuple(r["__" + n] for n in NAMES) == stats, r["text"]
        assert r["__base_failed"] == (stats[0] < 20 or 100 * stats[4] > 30 * stats[0])
        assert r["__kept"] == (not r["__base_failed"]) and r["n_words"] == "own n_words"
    docs = read_table(spark, SMALL, "documents")
    for r in qr.with_stats(docs).collect():
        assert tuple(r[n] for n in NAMES) == plain_stats(r["text"])


def test_list_learns_conjunctions_and_leaves_noise():
    r = np.random.default_rng(1)
    x = r.random((900, len(qr.FEATURES)))
    bad = (x[:, 1] > 0.8) | ((x[:, 3] > 0.6) & (x[:, 4] <= 0.3))
    rules = qr.learn_rules(x, bad, least_precision=0.9)
    found = np.zeros(len(x), bool)
    for rule in rules:
        found |= qr._holds(rule, x)
    assert (found == bad).mean() > 0.95
    assert any(len(rule) > 1 for rule in rules)
    assert qr.learn_rules(x, np.zeros(len(x), bool)) == [] and qr.learn_rules(x[:0], bad[:0]) == []
    noise = r.random(len(x)) < 0.1
    assert sum(qr._holds(rule, x).sum() for rule in qr.learn_rules(x, noise)) < 30


def test_column_equals_the_learned_list(spark):
    rules = [
        (qr.Test("symbol_rate", True, 0.2),),
        (qr.Test("mean_word", False, 4.0), qr.Test("upper_rate", True, 0.5)),
    ]
    rows = [(1, "# " * 30, None, None, None), (2, "AB " * 30, None, None, None), (3, words(1, 30), None, None, None)]
    found = {r["doc_id"]: r["rejected_by"] for r in qr.judge(documents(spark, rows), rules).collect()}
    assert found == {1: "symbol_rate > 0.2", 2: "mean_word <= 4 and upper_rate > 0.5", 3: None}


def test_learned_rules_on_held_out_labels(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    rules = qr.fit_rules(docs, labels.where(~fold))
    judged = qr.judge(docs, rules).join(labels.where(fold), "doc_id").where("NOT base_failed").select("kept", "quality").collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def test_labels_that_cannot_be_used(spark):
    docs = documents(spark, awkward_rows(), clashing=True)
    labels = spark.createDataFrame([(None, 0, 0), (999, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert qr.fit_rules(docs, labels) == [] and qr.fit_rules(docs, labels.limit(0)) == []
    assert qr.judge(documents(spark, []), []).count() == 0
