import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import AddedToken, Tokenizer

from arenalake.llm import token_files
from arenalake.llm.queries import op7_token_files, tokenizer_file

from .helpers import awkward_rows, documents, words

PATH = tokenizer_file("byte_bpe_50k.json")
TEXTS = [
    "", " ", "a", " a", "a ", "  b  c 12,3. É, é. x,\n", "it's we'll  don't.\n\n x", "\x1c a\x85 b　 c", "𝄞\n\t é ▁x",
    "<|endoftext|> x", "q" * 500 + " r", words(1, 60), "end.\nStart, \r\n  more ..!! ?! 'tis", "don't. can't, '",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_words_alone_equal_the_library(library):
    for kept in (2, 1000):
        encoder = token_files.WordEncoder(PATH, "<u2", kept)
        for text in TEXTS:
            expected = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder.encode(text), "<u2").tolist() == expected, text
        assert len(encoder) <= max(kept, 3)


def check(spark, tmp_path, library, rows, blocks):
    folder = f"file://{tmp_path}/tokens-{blocks}"
    docs = documents(spark, rows, clashing=True)
    manifest = token_files.write_token_files(docs, folder, PATH, end_id=2, blocks=blocks)
    assert manifest == token_files.read_manifest(folder) and manifest["dtype"] == "<u2"
    found = token_files.read_token_files(spark, folder, batch=3).collect()
    order = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0])
    found = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [r[0] for r in order]
    at, crcs = 0, []
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    assert at == manifest["n_ids"]
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        crcs.append((str(doc_id), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(crcs) == sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found)


def test_files_are_read_back(spark, tmp_path, library):
    rows = [(3 * k, t, None, None, None) for k, t in enumerate(TEXTS)] + awkward_rows()
    for blocks in (1, 5):
        check(spark, tmp_path, library, rows, blocks)


def test_task_that_runs_again_leaves_the_same_files(tmp_path):
    for _ in range(2):
        writer = token_files.BlockWriter(str(tmp_path), 3, "<u4")
        writer.add(5, np.array([1, 2, 70000], "<u4").tobytes())
        writer.add(6, b"")
        assert writer.close() == (3, 2, 3)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["000003.docs", "000003.ids", "000003.offsets"]
    part = {"block": 3, "base": 10}
    found = [(d, s, ids.tolist()) for d, s, ids in token_files.documents_of(str(tmp_path), part, "<u4")]
    assert found == [(5, 10, [1, 2, 70000]), (6, 13, [])]


def test_empty_table(spark, tmp_path):
    manifest = token_files.write_token_files(documents(spark, []), str(tmp_path / "x"), PATH, end_id=2)
    assert manifest["parts"] == [] and token_files.read_token_files(spark, str(tmp_path / "x")).count() == 0


MARKED = [
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "end.<|endoftext|>\n\nNext  <|endoftext|>x",
    "<|endoftext", "<|<|endoftext|>|> é<|endoftext|> ",
]


def test_added_tokens_equal_the_unaltered_library():
    library = Tokenizer.from_file(PATH)
    encoder = token_files.WordEncoder(PATH, "<u2", encode_special_tokens=False)
    for text in TEXTS + MARKED:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == expected, text


def test_added_tokens_that_depend_on_their_surroundings(tmp_path):
    library = Tokenizer.from_file(PATH)
    library.add_tokens([AddedToken("<cut>", lstrip=True, normalized=False), AddedToken("lone", single_word=True)])
    path = str(tmp_path / "more.json")
    library.save(path)
    encoder = token_files.WordEncoder(path, "<u4", encode_special_tokens=False)
    for text in [*MARKED, "a  <cut> b", "alone lone, lone<cut><|endoftext|>"]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected, text


def test_query_matches_added_tokens(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    rows = [(k, t, None, None, None) for k, t in enumerate(TEXTS + MARKED)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in op7_token_files(spark, str(tmp_path)).collect()}
    start = 0
    for k, text, *_ in rows:
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(found[k]) == (k, start, len(ids), crc), text
        start += len(ids)


@pytest.mark.parametrize("special", [True, False])
def test_texts_together_equal_the_library(special):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = special
    texts = [*TEXTS, *MARKED, "", "a \n", "\n a", "a\u3000 b", "a\x1c b \x85", "a b\n", *TEXTS]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for kept in (2, 1000):
        encoder = token_files.WordEncoder(PATH, "<u2", kept, encode_special_tokens=special)
        for most in (1, 100, 1 << 24):
            parts = list(token_files.slices(pa.array(texts), most))
            assert [t for p in parts for t in p.to_pylist()] == texts and (len(parts) == 1) == (most == 1 << 24)
            found = [ids for p in parts for ids in encoder.encode_all(p)]
            assert [np.frombuffer(ids, "<u2").tolist() for ids in found] == expected
    assert list(token_files.slices(pa.array([], pa.string()))) == [] == list(encoder.encode_all(pa.array([], pa.string())))


def test_distinct_words_are_looked_up_once():
    class Counting(token_files.WordEncoder):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    encoder, asked = Counting(PATH, "<u2"), []
    list(encoder.encode_all(pa.array(["on and on and on", "and on", "and on\n"])))
    assert sorted(asked) == ["and", "on", "on\n"]
