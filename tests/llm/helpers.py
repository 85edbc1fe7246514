"""Awkward inputs, and plain versions of the operators."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators might use themselves.
CLASHING = ("n_words", "kept", "block", "key", "node", "pass", "line", "row", "copies", "score", "ids", "at", "base", "all")


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeilnorst") for _ in range(r.randint(2, 8))) + str(r.randrange(vocabulary)).translate(str.maketrans("0123456789", "uvwxyzjkqm")) for _ in range(n))


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, empty and long texts, repeated rows and ids, odd characters."""
    long = "\n".join(words(i, 40) for i in range(300))
    base = words(1, 120)
    return [
        (1, base, "en", "a", len(base)),
        (1, base, "en", "a", len(base)),
        (2, base + " more words here", None, "a", None),
        (3, None, "en", None, None),
        (None, words(2, 50), None, None, 9),
        (None, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "en", "b", 4),
        (6, long, "en", "a", len(long)),
        (7, "ÄÖ ß 𝄞 ▁ x  y\r\n\x0b<*> \\### : </turn> 🙂", "de", "b", 1),
        (7, "same id, other text", "de", "b", 1),
        (-8, "x" * 3000, "fr", "b", 3000),
        (9, base.upper(), "en", "c", 1),
    ]


def documents(spark, rows, clashing: bool = False):
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return out.withColumns({n: F.lit(f"own {n}") for n in CLASHING}) if clashing else out


def keys_of(rows):
    """Rows as a multiset of comparable tuples."""
    return Counter(tuple(str(x) for x in r) for r in rows)


def shingle_set(text, k):
    found = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not found:
        return frozenset()
    k = min(k, len(found))
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def plain_components(rows, k, percent):
    """(doc_id, n_shingles, component_id) by comparing all sets."""
    by_set = defaultdict(list)
    for doc_id, text in rows:
        by_set[shingle_set(text, k)].append(doc_id)
    sets = [s for s in by_set if s]
    parent = {s: s for s in sets}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(sets):
        for b in sets[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                parent[find(a)] = find(b)
    least = {}
    for s in sets:
        for d in by_set[s]:
            old = least.get(find(s))
            least[find(s)] = d if old is None else old if d is None else min(old, d)
    return [(d, len(s), least[find(s)] if s else d) for s, ids in by_set.items() for d in ids]


def plain_stats(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    found = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(found) - 7):
        windows[tuple(found[i : i + 8])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def plain_templates(line):
    """All templates of a line."""
    raw = WORD.findall(line)
    ts = ["<*>" if re.search("[0-9]", w) else w for w in raw]
    n = len(ts)

    def steady(fixed):
        fields = fixed.count("<*>")
        return fields <= 3 and 2 * fields <= len(fixed)

    if not n:
        return []
    found = [("template", *ts) if n >= 4 and steady(ts) else ("line", *raw)]
    if n >= 12:
        for k, at in enumerate((3, 3 + (n - 6) // 2, n - 3)):
            fixed = ts[:at] + ts[at + 3 :]
            if steady(fixed):
                found.append((k, *fixed))
    return found


def plain_line_dedup(rows):
    """{(doc_id, text): text left} by the rules of the template tree."""
    owners = defaultdict(set)
    keyed = []
    for doc_id, text in rows:
        own = 2**63 - 1 if doc_id is None else doc_id
        for at, line in enumerate(text.split("\n") if text is not None else []):
            for key in plain_templates(line):
                owners[key].add(own)
                keyed.append((key, own, doc_id, text, at))
    gone = {(doc_id, text, at) for key, own, doc_id, text, at in keyed if own > min(owners[key])}
    return {
        (d, t): None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, t, i) not in gone)
        for d, t in rows
    }
