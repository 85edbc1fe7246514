import math
from collections import Counter

import pytest

from arenalake.llm import mixing

from .helpers import WORD, awkward_rows, documents, words

ROWS = [(k, words(k, 5 + k % 20), None, "big" if k % 3 else f"s{k % 4}", None) for k in range(600)]


def tokens(rows):
    out = Counter()
    for _, text, _, source, _ in rows:
        out[source] += len(WORD.findall(text or ""))
    return out


def test_exponent_meets_its_target():
    shares = [0.6, 0.3, 0.08, 0.02]
    a = mixing.exponent_for(shares, target_entropy=0.9)
    assert mixing.entropy(mixing.tempered(shares, a)) == pytest.approx(0.9 * math.log(4), abs=1e-6) and 0 < a < 1
    a = mixing.exponent_for(shares, repetition_limit=3.0)
    assert mixing.repetitions(shares, mixing.tempered(shares, a)) == pytest.approx(3.0, abs=1e-6)
    assert mixing.exponent_for(shares, repetition_limit=100.0) == 0.0
    assert mixing.exponent_for(shares, target_entropy=0.1) > 1
    assert mixing.exponent_for([1.0], target_entropy=0.5) == 1.0
    with pytest.raises(ValueError):
        mixing.exponent_for(shares)


def test_mix_reaches_its_weights(spark):
    docs = documents(spark, ROWS, clashing=True)
    out = mixing.mix_sources(docs, target_entropy=0.97, block_rows=16).collect()
    size = {r[0]: len(WORD.findall(r[1])) for r in ROWS}
    copies = Counter((r["doc_id"], r["__mix_pass"]) for r in out)
    assert set(copies.values()) == {1} and {r["doc_id"] for r in out} == set(size)
    mixed = Counter()
    for r in out:
        mixed[r["source"]] += size[r["doc_id"]]
    total = sum(mixed.values())
    weights = [n / total for n in mixed.values()]
    assert mixing.entropy(weights) / math.log(len(weights)) == pytest.approx(0.97, abs=0.005)
    plan = mixing.plan([(s, 1, n) for s, n in tokens(ROWS).items()], 0.97, None, None, 1)
    for share in plan:  # a partial pass ends before the document that would exceed it
        asked = share.passes * share.n_tokens + share.rest
        assert asked - 25 <= mixed[share.source] <= asked


def test_passes_permute_blocks_differently_and_repeat(spark):
    docs = documents(spark, ROWS)
    first, again = (
        sorted(map(tuple, mixing.mix_sources(docs.repartition(n), repetition_limit=3.0, block_rows=8).select("doc_id", "__mix_pass", "__mix_block", "__mix_order").collect()))
        for n in (2, 7)
    )
    assert first == again
    orders = {}
    for doc_id, number, block, order in first:
        if ROWS[doc_id][3] == "s0":
            orders.setdefault(number, {})[block] = order
    by_pass = [sorted(o, key=o.get) for o in orders.values()]
    assert len(by_pass) == 3 and by_pass[0] != by_pass[1]


def test_budget_may_leave_documents_out(spark):
    docs = documents(spark, ROWS)
    out = mixing.mix_sources(docs, repetition_limit=1.0, budget=sum(tokens(ROWS).values()) // 2, block_rows=16)
    kept = [ROWS[r["doc_id"]] for r in out.collect()]
    for source, n in tokens(ROWS).items():
        assert n // 2 - 25 <= tokens(kept)[source] <= n // 2 + 1


def test_awkward_rows(spark):
    rows = awkward_rows()
    docs = documents(spark, rows, clashing=True)
    out = mixing.mix_sources(docs, target_entropy=0.9, block_rows=2)
    assert out.columns[: len(docs.columns)] == docs.columns
    found = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in found if r["__mix_pass"] == 0) == Counter(r[:2] for r in rows)
    assert mixing.mix_sources(documents(spark, []), target_entropy=0.9).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, target_entropy=0.9, most_sources=2)
