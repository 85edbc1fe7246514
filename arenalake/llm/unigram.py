"""SentencePiece encoding by unigram Viterbi over a double-array trie of pieces, and decoding.

The trie has the pieces' UTF-8 bytes, with the white-space marker as a plain space, so a marker
that stands in a text itself cannot be confused with one: it goes through byte fallback like any
character without a piece, and decoding always gives the text back. A space is put before each
text, as the vocabulary expects, and taken off again. No piece has a space after another
character, so words with the spaces before them are encoded alone; of the words of a batch, each
distinct one goes through the trie once, and all of them together.

Scores are log probabilities. A file whose scores are merge ranks (0, -1, -2 and so on) has none;
ranks are then read as a Zipf distribution. Ties go to the longer last piece.

Defined results: a null or empty text has no tokens and decodes to the empty text; repeated rows
get equal tokens; null ids stay; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
#: Longer words go through the plain loop, one by one.
LONG = 256


#: A run of letters, with the spaces before it, or a run of other characters.
_RUNS = re.compile(r" *[^\W\d_]+| *(?:[^\w ]|[\d_])+| +").findall


@dataclass(frozen=True)
class Trie:
    """A double array: the child of node n for byte c is t = base[n] + c, if parent[t] is n."""

    base: np.ndarray
    parent: np.ndarray
    value: np.ndarray  # the piece that ends at the node, or -1

    @classmethod
    def build(cls, pieces: dict[bytes, int]) -> Trie:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for piece, number in pieces.items():
            node = 0
            for c in piece:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = number
        # Nodes with several children go behind all such nodes so far; single children fill the gaps.
        size = 4 * len(children) + 512
        base, parent, value = ([k] * size for k in (0, -1, -1))
        parent[0] = -2
        gap, front = 1, 1
        waiting = [(0, 0)]  # (node, slot)
        while waiting:
            node, slot = waiting.pop()
            value[slot] = ends[node]
            codes = sorted(children[node])
            if not codes:
                base[slot] = size  # past all nodes: no child is found there
                continue
            if len(codes) == 1:
                while parent[gap] != -1 or gap < codes[0]:
                    gap += 1
                at = gap - codes[0]
            else:
                at = max(front - codes[0], 0)
                while any(at + c < size and parent[at + c] != -1 for c in codes):
                    at += 1
                front = at + codes[0]
            if at + 512 > size:
                raise ValueError("too many nodes with several children for the array")
            base[slot] = at
            for c in codes:
                parent[at + c] = slot
            waiting += [(children[node][c], at + c) for c in codes]
        for x, filler in ((base, size), (parent, -1), (value, -1)):
            x += [filler] * 512
        return cls(*(np.array(x, np.int32) for x in (base, parent, value)))


@dataclass(frozen=True)
class Vocabulary:
    texts: list[bytes]  # of each id, for decoding; empty for control pieces
    scores: np.ndarray
    byte_ids: np.ndarray
    trie: Trie
    unknown: float  # score of a byte without a piece
    letters_alone: bool  # no piece has a letter beside a character that is none, but for a space before it

    def forced(self, word: str) -> list[str]:
        """The word in parts that no piece spans."""
        return _RUNS(word) if self.letters_alone else [word]

    @classmethod
    def of(cls, pieces: list[str], scores: list[float], plain: list[bool], byte_ids: list[int]) -> Vocabulary:
        """``plain`` marks the pieces that stand for their text."""
        texts = [p.replace(MARKER, " ").encode() if is_plain else b"" for p, is_plain in zip(pieces, plain)]
        for value, number in enumerate(byte_ids):
            texts[number] = bytes([value])
        known = {t: i for i, (t, is_plain) in enumerate(zip(texts, plain)) if is_plain and t}
        of_known = [scores[i] for i in known.values()]
        return cls(
            texts,
            np.array(scores),
            np.array(byte_ids, np.int32),
            Trie.build(known),
            min(of_known, default=0.0) - 10,
            all(len(_RUNS(t.decode())) == 1 for t in known),
        )


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file that has byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.vocab_size())
    pieces = [model.id_to_piece(i) for i in every]
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in every]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    scores = [model.get_score(i) for i in every]
    own = [scores[i] for i in every if plain[i]]
    if all(float(s).is_integer() for s in own):  # merge ranks, which ids follow
        first = next(i for i in every if plain[i])
        total = math.log(sum(1 / (r + 2) for r in range(len(own))))
        scores = [-math.log(max(i - first, 0) + 2) - total for i in every]
    return Vocabulary.of(pieces, scores, plain, byte_ids)


# Bytes of a character by its first byte; continuation bytes never start one.
CHAR_BYTES = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10, np.int64)


def encode_word(word: bytes, v: Vocabulary) -> list[int]:
    """Viterbi for one word of any length."""
    base, parent, value = v.trie.base, v.trie.parent, v.trie.value
    n = len(word)
    best, back = [0.0] + [-math.inf] * n, [(0, -1)] * (n + 1)
    for i in range(n):
        if best[i] == -math.inf:
            continue
        node, char, single = 0, int(CHAR_BYTES[word[i]]), False
        for j in range(i, n):
            to = int(base[node]) + word[j]
            if parent[to] != node:
                break
            node = to
            piece = int(value[node])
            if piece >= 0:
                single |= j + 1 - i == char
                score = best[i] + v.scores[piece]
                if score > best[j + 1]:
                    best[j + 1], back[j + 1] = score, (i, piece)
        if not single:
            end, score = min(i + char, n), best[i] + v.unknown * char
            if score > best[end]:
                best[end], back[end] = score, (i, -1)
    out: list[int] = []
    at = n
    while at:
        start, piece = back[at]
        out[:0] = [piece] if piece >= 0 else [int(v.byte_ids[b]) for b in word[start:at]]
        at = start
    return out


def encode_together(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """Viterbi for many words at once, each result as bytes of 32-bit integers.

    All places of all words walk down the trie together; the pieces found are edges, and the best
    paths follow them by place within the word.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    text = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    first = ends - sizes
    place = np.arange(len(text)) - np.repeat(first, sizes)  # within the word
    word_end = np.repeat(ends, sizes)
    edges = []  # (place within the word, start, end, piece)
    single = np.zeros(len(text), bool)
    at = np.arange(len(text))
    node, depth = np.zeros(len(text), np.int32), 0
    while len(at):
        inside = at + depth < word_end[at]
        at, node = at[inside], node[inside]
        to = v.trie.base[node] + text[at + depth]
        there = v.trie.parent[to] == node
        at, node = at[there], to[there]
        depth += 1
        piece = v.trie.value[node]
        ended = piece >= 0
        start, piece = at[ended], piece[ended]
        single[start[CHAR_BYTES[text[start]] == depth]] = True
        edges.append((place[start], start, start + depth, piece))
    alone = np.flatnonzero(~single & ((text & 0xC0) != 0x80))
    edges.append((place[alone], alone, np.minimum(alone + CHAR_BYTES[text[alone]], word_end[alone]), np.full(len(alone), -1)))
    where, start, end, piece = (np.concatenate(x) for x in zip(*edges))
    gain = np.where(piece >= 0, v.scores[piece], v.unknown * (end - start))
    order = np.argsort(where, kind="stable")
    start, end, piece, gain = start[order], end[order], piece[order], gain[order]
    steps = np.searchsorted(where[order], np.arange(int(sizes.max()) + 1))
    # Word k owns the slots of its places and one more, for its end.
    shift = np.repeat(np.arange(len(words)), sizes)
    best = np.full(len(text) + len(words), -np.inf)
    back = np.zeros(len(best), np.int64)
    taken = np.full(len(best), -1, np.int64)
    start, end = start + shift[start], end + shift[start]
    best[first + np.arange(len(words))] = 0
    for lo, hi in zip(steps, [*steps[1:], len(start)]):
        score = best[start[lo:hi]] + gain[lo:hi]
        better = score > best[end[lo:hi]]
        target = end[lo:hi][better]
        best[target], back[target], taken[target] = score[better], start[lo:hi][better], piece[lo:hi][better]
    begin = first + np.arange(len(words))
    slot = ends + np.arange(len(words))
    steps_back = []  # (word, piece, its start and end in the text), last pieces first
    moving = np.flatnonzero(slot > begin)
    while len(moving):
        here, before = slot[moving], back[slot[moving]]
        steps_back.append((moving, taken[here], before - moving, here - moving))
        slot[moving] = before
        moving = moving[before > begin[moving]]
    owner, piece, a, b = (np.concatenate(x)[::-1] for x in zip(*steps_back))
    order = np.argsort(owner, kind="stable")
    owner, piece = owner[order], piece[order].astype(np.int32)
    cuts = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
    raw = piece.tobytes()
    out = [raw[4 * x : 4 * y] for x, y in zip(cuts, cuts[1:])]
    a, b = a[order], b[order]
    for k in np.unique(owner[piece < 0]).tolist():
        ids = []
        for at in range(cuts[k], cuts[k + 1]):
            ids += [piece[at]] if piece[at] >= 0 else v.byte_ids[text[a[at] : b[at]]].tolist()
        out[k] = np.array(ids, np.int32).tobytes()
    return out


def encode_words(words: list[str], v: Vocabulary) -> list[bytes]:
    """Ids of each word, as bytes of 32-bit integers."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    usual = [w for w in raw if w and len(w) <= LONG]
    quick = iter(encode_together(usual, v) if usual else ())
    return [
        next(quick) if w and len(w) <= LONG else np.array(encode_word(w, v), np.int32).tobytes() for w in raw
    ]


_parts = re.compile(r" *[^ ]+| +$").findall


def words_of(text: str) -> list[str]:
    """The text with a space before it, cut before each space that follows another character."""
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _parts(" " + text)
    return [" " + w for w in text.split(" ")]


def decode(ids: np.ndarray, v: Vocabulary) -> str:
    return b"".join(map(v.texts.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


def encode_texts(texts: list[str], v: Vocabulary, known: dict[str, bytes], kept: int) -> list[np.ndarray]:
    """Ids of each text; ``known`` keeps the ids of at most ``kept`` words, and of those of this call."""
    cut = [words_of(t) for t in texts]
    every = set().union(*cut)
    new = every - known.keys()
    if len(known) + len(new) > kept:  # go on with the words of this call
        stay = {w: known[w] for w in every - new}
        known.clear()
        known.update(stay)
    pieces = {w: v.forced(w) for w in new}
    parts = list(set().union(*pieces.values()) - known.keys())
    known.update(zip(parts, encode_words(parts, v)))
    known.update((w, b"".join(map(known.__getitem__, p))) for w, p in pieces.items() if len(p) > 1)
    return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in cut]


def encode_documents(
    docs: DataFrame, v: Vocabulary, columns: list[str], kept: int = 500_000, at_once: int = 512
) -> DataFrame:
    """The named columns with ``ids`` (array of int), ``n_tokens`` and ``decoded`` (text read back from ids)."""
    fields = [docs.schema[c] for c in columns]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    nullable = {f.name: "Int64" for f in fields if f.dataType.simpleString() == "bigint"}

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, bytes] = {}
        for frame in frames:
            for at in range(0, len(frame), at_once):
                part = frame.iloc[at : at + at_once]
                ids = encode_texts([t or "" for t in part["__text"]], v, known, kept)
                out = part[columns].astype(nullable)
                yield out.assign(ids=ids, n_tokens=[len(x) for x in ids], decoded=[decode(x, v) for x in ids])

    return docs.select(*columns, F.col("text").alias("__text")).mapInPandas(
        encode, schema + "ids array<int>, n_tokens long, decoded string"
    )
