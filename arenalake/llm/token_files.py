"""Token ids in flat binary files with 64-bit document offsets.

Documents are dealt into blocks of ids, and each block is written as three little-endian files:
``ids`` (unsigned integers, 16 bits if the vocabulary allows, else 32), ``offsets`` (unsigned 64
bits, one more than documents) and ``docs`` (signed 64 bits). Offsets count from the start of
their block; the manifest, a JSON file, has the blocks in order with their bases, the prefix sums
of the block sizes. Blocks are written under a name of their task attempt and renamed when whole,
so a task that runs again, or twice, leaves the same files. The folder is one that all executors
share; readers map local files into memory and open others by block.

Defined results: a null text is empty and has the end id alone; rows with one id are ordered by a
hash of the text and the text; null ids come first and are read back as null; an empty table gives
a manifest without blocks. Other columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.llm.ordered import LOWEST, block_bounds, block_of, default_blocks, order_key

# The pre-token pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of about so many bytes have their words looked up together.
TOGETHER = 1 << 24


def byte_letters() -> str:
    """The letter that stands for each byte: itself if it prints, else the next from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b if b in prints else next(spare)) for b in range(256))


class WordEncoder(dict):
    """Ids of a text as bytes, with the ids of recent words kept.

    A token never spans from a non-space to a following space, so words can be encoded alone: the
    result equals that of the whole text. Kept words are bounded by ``kept``. The file's added tokens
    are cut out of the text first; as in the library, ``encode_special_tokens`` takes the special ones
    among them as text instead.
    """

    def __init__(self, path: str, dtype: str, kept: int = 800_000, encode_special_tokens: bool = True) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = encode_special_tokens
        self.model = self.library.model
        self.kind, self.kept = np.dtype(dtype).char, kept
        self.letters = byte_letters()
        self.pieces = regex.compile(PATTERN).findall
        self.spaced = regex.compile(r"^ |\s ").search
        self.marks = {c: self.ids_of_piece(c) for c in ".,;:!?"}
        self.breaks = regex.compile(r"(?<=\S) ").split
        self.spaces = {"", *regex.findall(r"\s", "".join(map(chr, range(0xD800))))}
        added = {
            t.content: (k, t.normalized or t.single_word or t.lstrip or t.rstrip)
            for k, t in self.library.get_added_tokens_decoder().items()
            if t.content and not (t.special and encode_special_tokens)
        }
        self.added = {c: array(self.kind, [k]).tobytes() for c, (k, _) in added.items()}
        self.bare = not any(depends for _, depends in added.values())  # matched whatever is around them
        longest_first = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.at_added = regex.compile(f"({'|'.join(longest_first)})").split

    def __missing__(self, word: str) -> bytes:
        """The key stands for the word with a space before it; a mark behind letters is a token of its own."""
        if word.isascii() and word.isalpha():
            ids = self.ids_of_letters(self.letters[32] + word)
        elif word[-1:] in self.marks and word[:-1].isalpha():
            ids = self[word[:-1]] + self.marks[word[-1]]
        else:
            ids = self.ids_of(" " + word)
        if len(self) >= self.kept:
            self.clear()
        self[word] = ids
        return ids

    def ids_of(self, chunk: str) -> bytes:
        pieces = [chunk] if chunk[1:].isalpha() and chunk[0] == " " else self.pieces(chunk)
        return b"".join(map(self.ids_of_piece, pieces))

    def ids_of_piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            text = piece.replace(" ", self.letters[32])
        else:
            text = "".join(map(self.letters.__getitem__, piece.encode("utf-8", "surrogatepass")))
        return self.ids_of_letters(text)

    def ids_of_letters(self, text: str) -> bytes:
        return array(self.kind, [t.id for t in self.model.tokenize(text)]).tobytes()

    def encode(self, text: str) -> bytes:
        if not any(c in text for c in self.added):
            return self.encode_plain(text)
        if not self.bare:
            return array(self.kind, self.library.encode(text, add_special_tokens=False).ids).tobytes()
        parts = self.at_added(text)  # plain text and added tokens in turn
        return b"".join(self.added[p] if k % 2 else self.encode_plain(p) for k, p in enumerate(parts))

    def encode_plain(self, text: str) -> bytes:
        words = self.breaks(text) if self.spaced(text) else text.split(" ")
        return self.ids_of(words[0]) + b"".join(map(self.__getitem__, words[1:]))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of each text. Arrow splits the texts and joins the ids; a distinct word is looked up once.

        Texts with an added token, or with a space behind white space or at the start, are encoded alone.
        """
        words = pc.split_pattern(texts, " ")
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        places, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        ids = pa.array(map(self.__getitem__, distinct), pa.large_binary(), size=len(distinct)).take(coded.indices)
        ends, data = np.frombuffer(ids.buffers()[1], "<i8")[ids.offset :], memoryview(ids.buffers()[2] or b"")
        before_space = np.fromiter((w[-1:] in self.spaces for w in distinct), bool, len(distinct))[places]
        before_space[bounds[1:] - 1] = False
        alone = set((np.searchsorted(bounds, np.flatnonzero(before_space), "right") - 1).tolist())
        for token in self.added:
            alone.update(np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)).tolist())
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if k in alone:
                yield self.encode(texts[k].as_py())
            else:
                yield self.ids_of(distinct[places[a]]) + data[ends[a + 1] : ends[b]]


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, dtype: str, encode_special_tokens: bool) -> WordEncoder:
    """One for each Python worker, so that its kept words serve the next task."""
    key = (path, dtype, encode_special_tokens)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, dtype, encode_special_tokens=encode_special_tokens)
    return _encoders[key]


def vocabulary_dtype(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a folder; one without a scheme is local."""
    parsed = urlparse(folder)
    if parsed.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else folder
    return pyarrow.fs.FileSystem.from_uri(folder)


def slices(texts: pa.Array, most: int = TOGETHER) -> Iterator[pa.Array]:
    """The texts in turn, in arrays of about ``most`` bytes or of one longer text."""
    groups = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield texts.slice(a, b - a)


class BlockWriter:
    """The files of one block, renamed into place when it is whole."""

    def __init__(self, folder: str, block: int, dtype: str) -> None:
        self.fs, path = opened(folder)
        self.fs.create_dir(path)
        self.block, self.dtype, self.path = block, dtype, path
        self.temporary = f"{path}/_attempt-{uuid.uuid4().hex}"
        self.ids = self.fs.open_output_stream(self.temporary)
        self.ends, self.docs, self.size = [0], [], 0

    def add(self, doc_id: int, ids: bytes) -> None:
        self.ids.write(ids)
        self.size += len(ids) // np.dtype(self.dtype).itemsize
        self.ends.append(self.size)
        self.docs.append(doc_id)

    def close(self) -> tuple[int, int, int]:
        self.ids.close()
        self.fs.move(self.temporary, f"{self.path}/{self.block:06d}.ids")
        for name, values, kind in (("offsets", self.ends, "<u8"), ("docs", self.docs, "<i8")):
            with self.fs.open_output_stream(self.temporary) as out:
                out.write(np.array(values, kind).tobytes())
            self.fs.move(self.temporary, f"{self.path}/{self.block:06d}.{name}")
        return self.block, len(self.docs), self.size


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    blocks: int | None = None,
    encode_special_tokens: bool = True,
) -> dict:
    """Encode all texts, write them in ascending order of ids, and return the manifest."""
    blocks = blocks or default_blocks(docs)
    dtype = vocabulary_dtype(tokenizer)
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), order_key(F.col("doc_id")).alias("doc_id"))
    bounds = block_bounds(rows, blocks)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer, dtype, encode_special_tokens).encode_all
        end = np.array([end_id], dtype).tobytes()
        writer, done = None, []
        for batch in batches:
            encoded = (ids for texts in slices(batch["text"]) for ids in encode_all(texts))
            for doc_id, block, ids in zip(batch["doc_id"].to_pylist(), batch["block"].to_pylist(), encoded):
                if writer is None or writer.block != block:
                    done += [writer.close()] if writer else []
                    writer = BlockWriter(folder, block, dtype)
                writer.add(doc_id, ids + end)
        done += [writer.close()] if writer else []
        columns = [[row[k] for row in done] for k in range(3)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["block", "n_docs", "n_ids"]
        )

    written = (
        rows.withColumn("block", block_of(F.col("doc_id"), bounds))
        .repartition(blocks, "block")
        .sortWithinPartitions("block", "doc_id", F.xxhash64("text"), "text")
        .mapInArrow(write, "block int, n_docs long, n_ids long")
    )
    parts, base = [], 0
    for row in sorted(written.collect()):  # three numbers for each block
        parts.append({"block": row["block"], "n_docs": row["n_docs"], "n_ids": row["n_ids"], "base": base})
        base += row["n_ids"]
    manifest = {"dtype": dtype, "end_id": end_id, "n_ids": base, "parts": parts}
    fs, path = opened(folder)
    fs.create_dir(path)
    with fs.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    fs, path = opened(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as source:
        return json.loads(source.read())


def load(folder: str, block: int, name: str, kind: str) -> np.ndarray:
    """A file of a block as an array: mapped into memory if it is local."""
    fs, path = opened(folder)
    path = f"{path}/{block:06d}.{name}"
    if not fs.get_file_info(path).size:
        return np.empty(0, kind)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with fs.open_input_file(path) as source:
        return np.frombuffer(source.read(), kind)


def documents_of(folder: str, part: dict, dtype: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, global start, ids) of each document of a block."""
    ids, ends = load(folder, part["block"], "ids", dtype), load(folder, part["block"], "offsets", "<u8")
    for k, doc_id in enumerate(load(folder, part["block"], "docs", "<i8").tolist()):
        a, b = int(ends[k]), int(ends[k + 1])
        yield None if doc_id == LOWEST else doc_id, part["base"] + a, ids[a:b]


def read_token_files(spark: SparkSession, folder: str, batch: int = 4096) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``. One task for each block."""
    manifest = read_manifest(folder)
    parts, dtype = manifest["parts"], manifest["dtype"]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in frame["id"]:
                rows = []
                for doc_id, start, ids in documents_of(folder, parts[at], dtype):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == batch:
                        yield framed(rows)
                        rows = []
                yield framed(rows)

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def framed(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
