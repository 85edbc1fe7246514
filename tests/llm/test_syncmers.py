import hashlib

import numpy as np

from arenalake.llm import syncmers

from .helpers import awkward_rows, documents, words


def test_closed_syncmers_equal_their_definition():
    text = words(1, 60) + " 𝄞ä " + words(2, 30)
    points = [text[i : i + 1] for i in range(len(text))]
    k, s = 12, 4
    from arenalake.llm.numeric_text import code_points, prefix_sums, span_hashes

    sums = prefix_sums(code_points(text))
    at = np.arange(len(points) - s + 1)
    small = span_hashes(sums, at, at + s)
    expected = []
    for i in range(len(text) - k + 1):
        inner = small[i : i + k - s + 1]
        if inner[0] == inner.min() or inner[-1] == inner.min():
            expected.append(int(span_hashes(sums, np.array([i]), np.array([i + k]))[0] >> np.uint64(34)))
    assert syncmers.syncmers(sums, len(text), k, s).tolist() == expected


def test_anchors_do_not_depend_on_their_place():
    a, b = words(3, 400), words(4, 30)
    moved = set(syncmers.anchors(b + " " + a)[0].tolist())
    own = syncmers.anchors(a)[0]
    assert np.mean([x in moved for x in own.tolist()]) > 0.98


def test_likeness():
    a, b = words(5, 300), words(6, 300)
    like = lambda x, y: syncmers.likeness(syncmers.anchors(x), syncmers.anchors(y))
    assert like(a, a) == 1 and like("", "") == 1 and like("ab", "ab") == 1
    assert like(a, b) < 0.05 and like("ab", a) == 0
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    assert 0.4 < like(a, half) < 0.6 and 0.4 < like(b, half) < 0.6
    swapped = a[len(a) // 2 :] + a[: len(a) // 2]  # the order counts
    assert like(a, swapped) < 0.6
    for n in (60, 250, 300, 1000, 1100):
        x = a[:n] if n <= len(a) else (a + b)[:n]
        y = x[: n - n // 3] + b[: n // 3]
        assert 0.4 < like(x, y) < 0.85, n


def plain_edits(rows):
    """{(doc_id, text): (n_chars, sha256 of the edited text)} for rows without repeated ids."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        out[doc_id] = (len(text), hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest())
    return out


def test_next_documents_across_blocks(spark):
    rows = [(7 * k - 100, words(k, 1 + k % 50) if k % 11 else None, None, None, None) for k in range(200)]
    expected = plain_edits([r[:2] for r in rows])
    for blocks in (1, 3, 16, 300):
        found = syncmers.fingerprint_edits(documents(spark, rows, clashing=True), blocks=blocks).collect()
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in found} == expected and len(found) == 200


def test_awkward_rows_and_empty_table(spark):
    rows = awkward_rows()
    found = syncmers.fingerprint_edits(documents(spark, rows, clashing=True), blocks=4).collect()
    assert len(found) == len(rows)
    copies = [r for r in found if r["doc_id"] == 1]
    assert len({r["fingerprint"] for r in copies}) == 1 and copies[0]["n_chars"] == len(rows[0][1])
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert syncmers.fingerprint_edits(documents(spark, [])).count() == 0
    one = syncmers.fingerprint_edits(documents(spark, [(5, "alone", None, None, None)])).first()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"alona"[:4] + b"a").hexdigest()


def test_likeness_does_not_depend_on_the_length():
    like = lambda x, y: syncmers.likeness(syncmers.anchors(x), syncmers.anchors(y))

    def after_edits(n, share):
        found = []
        for seed in range(12):
            x = words(900 + seed, 400)[:n].split(" ")
            y = [words(5000 + 1000 * seed + i, 1) if (i * 7919 + seed) % 100 < share else w for i, w in enumerate(x)]
            found.append(like(" ".join(x), " ".join(y)))
        return np.mean(found)

    for share in (5, 10, 20):
        assert abs(after_edits(1023, share) - after_edits(1100, share)) < 0.05
    whole = words(8, 400)[:1400]
    assert like(whole[:250], whole) > 0.25  # the whole beginning; at most 500 / 1650 by this measure
    assert like(whole[:1000], whole) > 0.75
