from arenalake.llm import line_templates

from .helpers import awkward_rows, documents, keys_of, plain_line_dedup, words


def deduped(spark, rows, **options):
    docs = documents(spark, rows, clashing=True)
    out = line_templates.drop_recurring_lines(docs, **options)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    return out


def check(spark, rows):
    plain = plain_line_dedup([r[:2] for r in rows])
    found = deduped(spark, rows).select("doc_id", "text").collect()
    assert keys_of(found) == keys_of((d, plain[d, t]) for d, t, *_ in rows)


def sample_rows():
    shared = words(1, 30)
    log = "user {} logged in from {} at {} and then left the building again after some time"
    changed = shared.split(" ")
    changed[16] = "other"
    texts = [f"{words(10 + k, 25)}\n{shared}\n{words(50 + k, 15)}" for k in range(8)]
    texts += [f"{log.format(*w)}\n{words(70 + k, 9)}" for k, w in enumerate([("a1", "10.0.0.1", "12:30"), ("b2", "10.9.0.1", "3")])]
    texts += [f"{' '.join(changed)}\n\n \nall rights reserved here\n{words(90, 3)}"]
    texts += [f"all rights reserved here\n{words(100 + k, 12)}" for k in range(12)]
    texts += ["two words\ntwo words", "two words", "rare short line here", "rare short line here"]
    return [(i, t, None, None, None) for i, t in enumerate(texts)]


def test_recurring_templates_are_dropped_but_for_the_first(spark):
    rows = sample_rows()
    check(spark, rows)
    left = {r["doc_id"]: r for r in deduped(spark, rows).collect()}
    shared = words(1, 30)
    assert shared in left[0]["text"] and all(shared not in left[k]["text"] for k in range(1, 8))
    assert "logged in" in left[8]["text"] and "logged in" not in left[9]["text"]  # variable fields
    assert "other" not in left[10]["text"]  # the open field in the middle
    assert left[21]["text"] == "all rights reserved here\n".join(["", ""]).strip() or "reserved" not in left[21]["text"]
    assert left[23]["text"] == "two words\ntwo words" and left[24]["text"] == ""
    assert left[25]["text"] == "rare short line here" and left[26]["text"] == ""
    assert left[1]["__n_lines"] == 3 and left[1]["__n_dropped"] == 1


def test_awkward_rows_and_empty_table(spark):
    rows = awkward_rows()
    rows += [(10, rows[8][1], None, None, None), (None, rows[8][1], None, None, None)]  # a copy of the long text
    check(spark, rows)
    assert deduped(spark, []).count() == 0


def test_one_rule_for_lines_of_any_length(spark):
    def text(k):
        return "\n".join([words(200 + k, 12), "All rights reserved.", " All  rights reserved. ", f"page {k}", "3 4", f"own{chr(97 + k)}", ""])

    rows = [(k, text(k), None, None, None) for k in range(4)]
    rows += [(30, "only here\n" * 10, None, None, None), (31, "a b c d\n" * 10, None, None, None), (32, "a b c d", None, None, None)]
    check(spark, rows)
    left = {r["doc_id"]: r["text"] for r in deduped(spark, rows).collect()}
    assert left[0] == rows[0][1]  # the document of the lowest id keeps all
    for k in range(1, 4):
        assert left[k] == "\n".join([words(200 + k, 12), f"page {k}", f"own{chr(97 + k)}", ""]), k
    assert left[30] == rows[4][1] and left[31] == rows[5][1] and left[32] == ""  # many lines of one document


def test_fields_are_few_and_rows_of_numbers_no_template(spark):
    def numbers(k, n):
        return " ".join(str(1000 * k + i) for i in range(n))

    half = "one {} two {} three {}"
    more = "one {} two {} three {} four {}"
    mixed = f"{words(300, 6)} {{}} {words(301, 6)}"
    texts = [
        "\n".join([numbers(k, 9), numbers(77, 9), numbers(k, 30), half.format(*[k] * 3), more.format(*[k] * 4), mixed.format(numbers(k, 3))])
        for k in range(4)
    ]
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    check(spark, rows)
    left = {r["doc_id"]: r["text"] for r in deduped(spark, rows).collect()}
    assert left[0] == texts[0]
    for k in range(1, 4):
        assert left[k] == "\n".join([numbers(k, 9), numbers(k, 30), more.format(*[k] * 4)]), k


def test_open_fields_are_bounded(spark):
    base = words(400, 40).split(" ")

    def changed(*at):
        return " ".join(f"other{chr(97 + at[0])}" if i in at else w for i, w in enumerate(base))

    lines = [changed(3), changed(3, 4, 5), changed(20, 21, 22), changed(37, 38, 39), changed(10), changed(2), changed(36, 37), changed(4, 21)]
    rows = [(0, " ".join(base), None, None, None)] + [(k + 1, line, None, None, None) for k, line in enumerate(lines)]
    check(spark, rows)
    left = {r["doc_id"]: r["text"] for r in deduped(spark, rows).collect()}
    assert [left[k + 1] == "" for k in range(8)] == [True, True, True, True, False, False, False, False]


def test_a_text_does_not_go_with_each_of_its_lines(spark):
    long = "\n".join(f"{words(k % 50, 6)} line {chr(97 + k % 26)} {'x' * (k % 90)}" for k in range(200_000))
    rows = [(1, long, None, None, None), (2, long, None, None, None), (3, "short", None, None, None)]
    out = deduped(spark, rows)
    assert {r["doc_id"]: (r["__n_lines"], r["__n_dropped"]) for r in out.collect()} == {1: (200_000, 0), 2: (200_000, 200_000), 3: (1, 0)}
