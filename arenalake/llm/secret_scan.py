"""Secret scans: known forms of secrets, and a battery of randomness tests for the rest.

Known forms are patterns. Everything else that could be a key is a run of at least ``LEAST`` letters,
digits and the signs of base 64. Its encoding is the smallest alphabet that has all its characters;
over that alphabet three statistics are taken: chi-squared against equal frequencies, the number of
runs above and below the middle, and the correlation of neighbours. A run counts as random if none
of the three rejects randomness. How unlikely it is for a run of words to look so uniform is the
lower tail of a non-central chi-squared whose shift grows with the length: short runs prove little.

These probabilities are tested together, over all runs of all documents, by the step-up procedure
that bounds the share of false discoveries, with weights in proportion to the length. Only counts
per length and probability class reach the driver, a bounded number of them.

Spans are in code points, ends exclusive. Everything is a column expression; rows are independent
but for the one threshold. Defined results: a null or empty text has no spans; repeated rows get
equal spans; all columns stay, the added ones are prefixed; without runs nothing is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.llm.quality_rules import let

# The known forms, each with the group whose length counts and its least length.
FORMS = {
    "assign": (
        "((?i)password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
        "(?i)password|passwd|secret|token|api_?key",
    ),
    "access": ("AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    "hex": ("[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
}
LEAST = 20
RUN = "[A-Za-z0-9+/_-]{%d,}" % LEAST
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets from the smallest on, and how far from equal the frequencies of words are over each:
#: the sum of squared shares (about 0.066 for letters, 0.17 among a to f) times the size, less 1.
ALPHABETS = (
    ("digits", DIGITS, None),
    ("hex", DIGITS + "abcdef", 1.7),
    ("hex upper", DIGITS + "ABCDEF", 1.7),
    ("lower", LOWER, 0.7),
    ("upper", LOWER.upper(), 0.7),
    ("base 32", LOWER.upper() + "234567", 1.1),
    ("base 36", DIGITS + LOWER, 1.4),
    ("base 36 upper", DIGITS + LOWER.upper(), 1.4),
    ("base 62", DIGITS + LOWER.upper() + LOWER, 3.1),
    ("base 64", DIGITS + LOWER.upper() + LOWER + "+/", 3.2),
    ("base 64 url", DIGITS + LOWER.upper() + LOWER + "-_", 3.2),
    ("base 66", DIGITS + LOWER.upper() + LOWER + "+/-_", 3.3),
)
REJECT = 0.001  # level at which each of the three tests rejects randomness
CLASS = 8  # classes of probability to a factor of e
LONGEST = 256  # longer runs weigh as much as these


SPAN = "struct<start:int,end:int,text:string>"
PLACES = 512  # matches that are gathered at a time, and
STRETCH = 4096  # code points of a stretch of text: both keep the work a match the same in texts of any length


def matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Spans (start, end, text) of the leftmost matches whose group is long enough."""
    def spans(known: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(known["gaps"], i))
            end = start + F.length(F.get(known["found"], i))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(known["found"], i).alias("text"))
            own = F.when(F.length(F.get(known["inner"], i)) >= least, F.array(span)).otherwise(none_of(f"array<{SPAN}>"))
            return F.struct(end.alias("at"), F.concat(state["out"], own).alias("out"))

        def some(state: Column, first: Column) -> Column:
            """The spans of the next places, added as one array."""
            last = F.least(first + PLACES, F.size(known["found"])) - 1
            zero = F.struct(state["at"].alias("at"), none_of(f"array<{SPAN}>").alias("out"))
            return let(
                F.aggregate(F.sequence(first, last), zero, step),
                lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")),
            )

        firsts = F.sequence(F.lit(0), F.size(known["found"]) - 1, F.lit(PLACES))
        zero = F.struct(F.lit(0).alias("at"), none_of(f"array<array<{SPAN}>>").alias("out"))
        return F.when(F.size(known["found"]) > 0, F.flatten(F.aggregate(firsts, zero, some)["out"])).otherwise(none_of(f"array<{SPAN}>"))

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("inner"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    return let(found, spans)


def apart_from(spans: Column, others: Column, size: Column) -> Column:
    """The spans that no other one overlaps: others are first dealt to the stretches of the text they touch."""
    stretches = F.transform(
        F.sequence(F.lit(0), F.floor(size / STRETCH).cast("int")),
        lambda k: F.filter(others, lambda o: (o["start"] < (k + 1) * STRETCH) & (o["end"] > k * STRETCH)),
    )

    def free(by_stretch: Column) -> Column:
        def overlapped(s: Column) -> Column:
            first = F.floor(s["start"] / STRETCH).cast("int")
            touched = F.slice(by_stretch, first + 1, F.floor(s["end"] / STRETCH).cast("int") - first + 1)
            return F.exists(touched, lambda part: F.exists(part, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))

        return F.filter(spans, lambda s: ~overlapped(s))

    return F.when(F.size(others) > 0, let(stretches, free)).otherwise(spans)


def _of_kind(place: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end"))


def none_of(kind: str) -> Column:
    return F.array().cast(kind)


def base_spans(text: Column) -> Column:
    """All spans of known forms, as (start, place of the kind in the list, end)."""
    full = F.coalesce(text, F.lit(""))
    of_kinds = []
    for place, (pattern, group, least, hint) in enumerate(FORMS.values()):
        own = F.transform(matches(full, pattern, group, least), _of_kind(place))
        of_kinds.append(F.when(full.rlike(hint), own).otherwise(none_of("array<struct<start:int,kind:int,end:int>>")))
    return F.array_sort(F.concat(*of_kinds))


def normal_tail(z: Column) -> Column:
    """The chance of a standard normal value above z (z at least 0 is best): a rational approximation."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def run_tests(run: Column) -> Column:
    """A struct: n, ``random`` (no test rejects randomness), ``p`` (chance that words look as uniform)."""
    def alphabet(r: Column) -> Column:
        out = None
        for _, signs, distance in ALPHABETS:
            hit = r.rlike("^[" + signs.replace("-", "\\-") + "]*$")
            value = F.struct(F.lit(signs).alias("signs"), F.lit(distance).cast("double").alias("distance"))
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out

    def statistics(known: Column) -> Column:
        v, k, n = known["v"], known["k"].cast("double"), F.size(known["v"]).cast("double")
        half = known["k"] / 2
        total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
        squares = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
        counts = F.transform(F.sequence(F.lit(0), known["k"] - 1), lambda i: F.size(F.filter(v, lambda x: x == i)))
        walk = F.aggregate(
            v,
            F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("products"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high")),
            lambda a, x: F.struct(
                x.cast("double").alias("last"),
                (a["products"] + F.when(a["last"] >= 0, a["last"] * x).otherwise(0.0)).alias("products"),
                (a["runs"] + F.when((a["last"] < 0) | ((a["last"] >= half) != (x >= half)), 1.0).otherwise(0.0)).alias("runs"),
                (a["high"] + F.when(x >= half, 1.0).otherwise(0.0)).alias("high"),
            ),
        )
        return F.struct(
            n.alias("n"),
            k.alias("k"),
            known["distance"].alias("distance"),
            (F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * k / n - n).alias("chi"),
            walk.alias("walk"),
            total.alias("total"),
            squares.alias("squares"),
            (F.get(v, F.lit(0)) * F.get(v, F.size(v) - 1)).cast("double").alias("ends"),
        )

    def decide(s: Column) -> Column:
        n, k, high = s["n"], s["k"], s["walk"]["high"]
        free = k - 1
        z_chi = (s["chi"] - free) / F.sqrt(2 * free * (n - 1) / n)
        crossing = 2 * high * (n - high)
        spread = crossing * (crossing - n) / (n * n * (n - 1))
        z_runs = F.when(spread > 0, (s["walk"]["runs"] - 1 - crossing / n) / F.sqrt(spread)).otherwise(F.lit(99.0))
        moment = n * s["squares"] - s["total"] * s["total"]
        circular = n * (s["walk"]["products"] + s["ends"]) - s["total"] * s["total"]
        z_serial = F.when(moment > 0, (circular / moment + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.lit(99.0))
        random = (
            (normal_tail(z_chi) >= REJECT)
            & (2 * normal_tail(F.abs(z_runs)) >= REJECT)
            & (2 * normal_tail(F.abs(z_serial)) >= REJECT)
        )
        shift = n * s["distance"]
        z_words = (free + shift - s["chi"]) / F.sqrt(2 * free + 4 * shift)
        p = F.when(random & s["distance"].isNotNull(), normal_tail(z_words)).otherwise(1.0)
        return F.struct(n.cast("int").alias("n"), random.alias("random"), F.greatest(p, F.lit(1e-300)).alias("p"))

    def with_alphabet(a: Column) -> Column:
        return F.struct(
            F.transform(
                F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.call_function("position", c, a["signs"]) - 1
            ).alias("v"),
            F.length(a["signs"]).alias("k"),
            a["distance"].alias("distance"),
        )

    return let(let(let(alphabet(run), with_alphabet), statistics), decide)


def weighted_class(test: Column, mean_length: float) -> Column:
    """The class of the probability divided by the weight, higher for less likely ones."""
    weight = F.least(test["n"], F.lit(LONGEST)) / F.lit(mean_length)
    return F.floor(-F.log(F.least(test["p"] / weight, F.lit(1.0))) * CLASS).cast("int")


def run_spans(text: Column) -> Column:
    """Spans of all runs with their tests."""
    full = F.coalesce(text, F.lit(""))
    spans = F.transform(
        matches(full, RUN, 0, LEAST),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), run_tests(s["text"]).alias("test")),
    )
    kind = "array<struct<start:int,end:int,test:struct<n:int,random:boolean,p:double>>>"
    return F.when(full.rlike(RUN), spans).otherwise(none_of(kind))


def step_up(counts: list[tuple[int, float, int]], mean_length: float, rate: float) -> int | None:
    """The least class that is reported. ``counts``: (length, class of p by its log, how many)."""
    tests = sum(c for _, _, c in counts)
    by_class: dict[int, int] = {}
    for length, log_p, count in counts:
        weighted = max(0.0, log_p + math.log(min(length, LONGEST) / mean_length))
        by_class[math.floor(weighted * CLASS)] = by_class.get(math.floor(weighted * CLASS), 0) + count
    found, least = 0, None
    for c in sorted(by_class, reverse=True):
        found += by_class[c]
        if math.exp(-c / CLASS) <= rate * found / tests:
            least = c
    return least


def fit_threshold(docs: DataFrame, rate: float = 0.001) -> tuple[float, int | None]:
    """Mean length of all runs of all documents, and the least class to report."""
    runs = docs.select(F.explode(run_spans(F.col("text"))).alias("r")).select(
        F.least(F.col("r.test.n"), F.lit(LONGEST)).alias("n"), F.floor(-F.log("r.test.p") * CLASS).alias("c")
    )
    # At most LONGEST lengths times CLASS * 691 classes.
    counts = [(r["n"], r["c"] / CLASS, r["count"]) for r in runs.groupBy("n", "c").count().collect()]
    total = sum(c for _, _, c in counts)
    if not total:
        return 1.0, None
    mean = sum(n * c for n, _, c in counts) / total
    return mean, step_up(counts, mean, rate)


def scan(docs: DataFrame, mean_length: float, least_class: int | None, prefix: str = "") -> DataFrame:
    """``docs`` with the prefixed columns ``base`` and ``all``: arrays of (start, kind, end), kinds as listed
    in ``FORMS`` and then the random runs outside the known forms."""
    known = docs.withColumn(prefix + "base", base_spans(F.col("text")))
    if least_class is None:
        return known.withColumn(prefix + "all", F.col(prefix + "base"))
    base = F.col(prefix + "base")
    likely = F.filter(
        run_spans(F.col("text")),
        lambda r: r["test"]["random"] & (weighted_class(r["test"], mean_length) >= least_class),
    )
    random = let(likely, lambda runs: apart_from(runs, base, F.length("text")))
    return known.withColumn(prefix + "all", F.array_sort(F.concat(base, F.transform(random, _of_kind(len(FORMS))))))


def of_kind_count(spans: Column, place: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == place)).cast("long")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(k) for k in (*FORMS, "random")))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")),
        ),
        ",",
    )
