"""Quality rules: text statistics as Spark expressions, and a decision list learned from labels.

Statistics and verdicts are column expressions on the whole text. The list is learned by sequential
covering (grow a conjunction of thresholds on one part of the labelled rows, prune it on the other)
over the statistics of at most ``sample_rows`` labelled documents; only those few numbers reach the
driver. It comes out as one ordered ``CASE WHEN``.

Defined results: a null or empty text has no words and fails the base rule; labels without a
document, or null, are not used; of several labels of a document the lowest counts; without labels
the list is empty and the base rule decides alone. Repeated rows get equal verdicts, and all
columns of the input stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: What the list may test; all are ratios, so that they mean the same in long and short texts.
FEATURES = ("mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "mark_rate")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in a window of so many words that the text has more than once."""
    def hashes(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ws) - window)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(ws, i + k) for k in range(window))))

    def places(hs: Column) -> Column:
        """Starts of the windows whose hash occurs again, in ascending order."""
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda ps: F.array_sort(
                F.transform(
                    F.filter(
                        ps,
                        lambda p, j: F.coalesce(F.get(ps, j + 1)["h"] == p["h"], F.lit(False))
                        | F.coalesce(F.get(ps, j - 1)["h"] == p["h"], F.lit(False)),
                    ),
                    lambda p: p["i"],
                )
            ),
        )

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        add = F.aggregate(
            starts,
            zero,
            lambda a, i: F.struct(
                (a["n"] + i + window - F.greatest(a["end"], i)).alias("n"), (i + window).alias("end")
            ),
        )
        return add["n"]

    repeats = let(
        hashes(words),
        lambda hs: F.when(F.size(F.array_distinct(hs)) < F.size(hs), covered(places(hs))).otherwise(0),
    )
    return F.when(F.size(words) > window, repeats).otherwise(0)


def text_stats(text: Column) -> Column:
    """A struct of counts over the whole text; a null text counts as empty."""
    full = F.coalesce(text, F.lit(""))

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(full, pattern, ""))

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            repeated_words(ws).cast("long").alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return F.struct(
        let(words_of(text), of_words).alias("words"),
        let(lines, of_lines).alias("lines"),
        (F.length(full) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(full) - without("[A-Z]")).cast("long").alias("n_upper"),
        (F.length(full) - without("[!?]")).cast("long").alias("n_marks"),
    )


def with_stats(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` and the statistics as columns, in one pass."""
    at = "__text_stats"
    names = {
        "n_words": "words.n_words",
        "word_chars": "words.word_chars",
        "n_repeat_words": "words.n_repeat_words",
        "n_lines": "lines.n_lines",
        "n_dup_lines": "lines.n_dup_lines",
        "n_symbols": "n_symbols",
        "n_upper": "n_upper",
        "n_marks": "n_marks",
    }
    known = docs.withColumn(at, text_stats(F.col("text")))
    return known.select(*docs.columns, *(F.col(f"{at}.{path}").alias(prefix + n) for n, path in names.items()))


def features(prefix: str = "") -> dict[str, Column]:
    def c(name: str) -> Column:
        return F.col(prefix + name).cast("double")

    words = F.greatest(c("n_words"), F.lit(1.0))
    return {
        "mean_word": c("word_chars") / words,
        "symbol_rate": c("n_symbols") / words,
        "dup_line_rate": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1.0)),
        "repeat_rate": c("n_repeat_words") / words,
        "upper_rate": c("n_upper") / F.greatest(c("word_chars"), F.lit(1.0)),
        "mark_rate": c("n_marks") / words,
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self, known: dict[str, Column]) -> Column:
        value = known[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, x: np.ndarray) -> np.ndarray:
        value = x[:, FEATURES.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Test, ...]


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, (t.holds(x) for t in rule), np.ones(len(x), bool))


def _grow(x: np.ndarray, bad: np.ndarray, tests: list[Test], longest: int) -> Rule:
    """Add the test of the highest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < longest and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        base = np.log2(p0 / (p0 + n0))
        gains = []
        for test in tests:
            now = inside & test.holds(x)
            p, n = (now & bad).sum(), (now & ~bad).sum()
            gains.append(p * (np.log2(p / (p + n)) - base) if p else 0.0)
        most = max(gains, default=0.0)
        if most <= 1e-9:
            break
        # Of equal cuts the middle one: as far from the good rows as from the bad ones.
        equal = [t for t, gain in zip(tests, gains) if gain >= most - 1e-9]
        equal = [t for t in equal if (t.feature, t.above) == (equal[0].feature, equal[0].above)]
        rule += (equal[len(equal) // 2],)
        inside &= rule[-1].holds(x)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that does best on rows it was not grown on."""
    def value(r: Rule) -> float:
        inside = _holds(r, x)
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[: k + 1] for k in range(len(rule))), key=lambda r: (value(r), -len(r)), default=())


def learn_rules(
    x: np.ndarray,
    bad: np.ndarray,
    least_precision: float = 0.95,
    least_rows: int = 3,
    longest: int = 3,
    most_rules: int = 12,
    cuts: int = 64,
) -> list[Rule]:
    """An ordered list of conjunctions that mark bad rows, by sequential covering."""
    quantiles = np.linspace(0, 1, cuts + 1)[1:-1]
    tests = []
    for j, name in enumerate(FEATURES):
        own = [np.quantile(part[:, j], quantiles) for part in (x, x[bad]) if len(part)]
        for cut in np.unique(np.round(np.concatenate(own), 6)) if own else ():
            tests += [Test(name, True, float(cut)), Test(name, False, float(cut))]
    rules: list[Rule] = []
    grown = np.arange(len(x)) % 3 != 0
    left = np.ones(len(x), bool)
    while len(rules) < most_rules and (left & bad & grown).any():
        rule = _grow(x[left & grown], bad[left & grown], tests, longest)
        held = left & ~grown
        rule = _prune(rule, x[held], bad[held]) if rule else rule
        if not rule:
            break
        inside = _holds(rule, x) & left
        right = (inside & bad).sum()
        if right < least_rows or right < least_precision * inside.sum():
            break
        rules.append(rule)
        left &= ~inside
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = 8_000, **options) -> list[Rule]:
    """Learn the list from at most ``sample_rows`` labelled documents, picked by a hash of the id."""
    known = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("__quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows pairs of numbers: a bounded broadcast. The statistics come after the grouping, so
    # that they are of these documents alone; of several texts of an id one counts, by its hash.
    chosen = (
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "__quality")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    )
    by_name = features()
    found = (
        with_stats(chosen)
        .select("doc_id", "n_words", F.col("__quality").alias("q"), *(by_name[n].alias(n) for n in FEATURES))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .collect()
    )
    found = [r for r in found if r["n_words"]]
    if not found:
        return []
    x = np.array([[r[n] for n in FEATURES] for r in found], float)
    return learn_rules(x, np.array([r["q"] == 0 for r in found]), **options)


def rule_name(rule: Rule) -> str:
    return " and ".join(f"{t.feature} {'>' if t.above else '<='} {t.threshold:g}" for t in rule)


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The name of the first rule that rejects, null if none does: an ordered CASE WHEN."""
    known = features(prefix)
    out = None
    for rule in rules:
        hit = reduce(lambda a, b: a & b, (t.column(known) for t in rule))
        out = (F if out is None else out).when(hit, rule_name(rule))
    return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None).cast("string"))


def base_failed(prefix: str = "") -> Column:
    words, repeats = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < 20) | (100 * repeats > 30 * words)


def passes_base_rule(text: Column) -> Column:
    """Whether a text by itself passes the base rule."""
    counts = text_stats(text)["words"]
    return let(counts, lambda c: (c["n_words"] >= 20) & (100 * c["n_repeat_words"] <= 30 * c["n_words"]))


def judge(docs: DataFrame, rules: list[Rule], prefix: str = "") -> DataFrame:
    """``docs`` with its statistics, ``base_failed``, ``rejected_by`` and ``kept``."""
    known = with_stats(docs, prefix)
    return known.withColumns({prefix + "base_failed": base_failed(prefix), prefix + "rejected_by": verdict(rules, prefix)}).withColumn(
        prefix + "kept", ~F.col(prefix + "base_failed") & F.col(prefix + "rejected_by").isNull()
    )
