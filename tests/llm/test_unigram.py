import math
import random
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.llm import unigram
from arenalake.llm.queries import tokenizer_file

from .helpers import awkward_rows, documents, words

TEXTS = ["", " ", "a", "  two  spaces ", "▁ marker ▁▁", "tab\tline\nend\n", "𝄞 é ß 漢字", "UPPER, lower; 12.5!", "x" * 400, words(1, 80)]


@pytest.fixture(scope="module")
def vocabulary():
    return unigram.load_vocabulary(tokenizer_file("piece_bpe_32k.model"))


def plain_best(text: bytes, v) -> float:
    """The best score of all segmentations."""
    by_text = {t: v.scores[i] for i, t in enumerate(v.texts) if t and i not in set(v.byte_ids.tolist())}

    @lru_cache(None)
    def best(i: int) -> float:
        if i == len(text):
            return 0.0
        out = -math.inf
        for j in range(i + 1, min(len(text), i + 50) + 1):
            if text[i:j] in by_text:
                out = max(out, by_text[text[i:j]] + best(j))
        char = int(unigram.CHAR_BYTES[text[i]])
        if text[i : i + char] not in by_text:
            out = max(out, v.unknown * char + best(i + char))
        return out

    return best(0)


def score(ids, v) -> float:
    of_bytes = set(v.byte_ids.tolist())
    return sum(v.unknown if i in of_bytes else v.scores[i] for i in ids)


def test_best_path_equals_all_segmentations(vocabulary):
    r = random.Random(2)
    found = {" " + w for t in TEXTS for w in t.split(" ") if len(w) < 60}
    found |= {" " + "".join(r.choice("theinaouérst") for _ in range(r.randint(1, 18))) for _ in range(150)}
    found = sorted(found)
    for w, ids in zip(found, unigram.encode_words(found, vocabulary)):
        raw = w.encode()
        ids = np.frombuffer(ids, np.int32).tolist()
        assert ids == unigram.encode_word(raw, vocabulary)
        assert score(ids, vocabulary) == pytest.approx(plain_best(raw, vocabulary))
        assert b"".join(vocabulary.texts[i] for i in ids) == raw


def test_words_alone_equal_the_whole_text(vocabulary):
    known = {}
    for t, ids in zip(TEXTS, unigram.encode_texts(TEXTS, vocabulary, known, 10_000)):
        whole = unigram.encode_word(b" " + t.encode(), vocabulary) if t else []
        assert ids.tolist() == whole
        assert unigram.decode(ids, vocabulary) == t


def test_trie_finds_its_pieces_and_nothing_else():
    r = random.Random(3)
    pieces = {bytes(r.choice(b"ab\xff\x00") for _ in range(r.randint(1, 6))): k for k in range(300)}
    trie = unigram.Trie.build(pieces)

    def find(text):
        node = 0
        for c in text:
            to = int(trie.base[node]) + c
            if trie.parent[to] != node:
                return -1
            node = to
        return int(trie.value[node])

    for p, k in pieces.items():
        assert find(p) == k
    for _ in range(500):
        p = bytes(r.choice(b"ab\xff\x00") for _ in range(r.randint(1, 7)))
        assert find(p) == pieces.get(p, -1)


def test_own_vocabulary_with_pieces_across_kinds():
    byte_ids = list(range(256))
    pieces = [f"<{b}>" for b in range(256)] + ["a", "b", "a.", "ab", "▁a", "▁"]
    v = unigram.Vocabulary.of(pieces, [0.0] * 256 + [-2.0, -2.0, -2.5, -3.0, -2.2, -1.0], [False] * 256 + [True] * 6, byte_ids)
    assert not v.letters_alone
    ids = unigram.encode_texts(["a.b ab", "é"], v, {}, 10)
    assert [unigram.decode(i, v) for i in ids] == ["a.b ab", "é"]
    assert ids[0].tolist() == unigram.encode_word(b" a.b ab", v)


def test_documents(spark, vocabulary):
    rows = awkward_rows()
    docs = documents(spark, rows, clashing=True).drop("ids")
    out = unigram.encode_documents(docs, vocabulary, ["doc_id", "source", "n_chars", "key"], kept=50, at_once=3)
    found = out.collect()
    assert sorted(r["decoded"] for r in found) == sorted(t or "" for _, t, *_ in rows)
    assert all(len(r["ids"]) == r["n_tokens"] for r in found) and {r["key"] for r in found} == {"own key"}
    assert sum(r["doc_id"] is None for r in found) == 2
    assert unigram.encode_documents(documents(spark, []), vocabulary, ["doc_id"]).count() == 0
    assert out.where(F.col("n_tokens") == 0).count() == 3
