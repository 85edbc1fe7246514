"""Article extraction: markup, character references, what is left out, and the given pages."""

import html
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.llm import html_blocks
from arenalake.llm.html_pages import LABELLED_PAGES
from arenalake.llm.queries import op11_html_extraction
from arenalake.llm.tree import fit_tree


def text(page):
    return html_blocks.article_texts([page], html_blocks.default_tree())[0]


def plain_article(page):
    """Cuts the article element of the given pages by patterns; good for their markup only."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    body = re.sub(r"<(/?[a-z]\w*)?$", "", body)
    blocks = [html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def test_given_pages_against_patterns(spark):
    for sf in ("sf0.001", "sf0.1"):
        folder = f"/root/testdata/{sf}"
        got = {r["page_id"]: r for r in op11_html_extraction(spark, folder).collect()}
        rows = duckdb.sql(f"SELECT page_id, url, html FROM '{folder}/pages.parquet'").fetchall()
        assert len(got) == len(rows)
        for page_id, url, page in rows:
            expected = plain_article(page)
            assert got[page_id]["text"] == expected and got[page_id]["n_chars"] == len(expected) and got[page_id]["url"] == url


ARTICLE = "<article><h1>A title</h1><p>First words of it, and more of them.</p><p>Of.</p></article>"
EXPECTED = "A title\nFirst words of it, and more of them.\nOf."


@pytest.mark.parametrize(
    "around",
    [
        "<nav><a href='/'>Home</a></nav>{}<footer>All rights reserved by somebody or other.</footer>",
        "<header><p>Some site with a long claim about how good it is for all its readers everywhere.</p></header>{}",
        "<aside><p>A side story of twenty words or more that stands beside the article and is not a part of it at all.</p></aside>{}",
        "<div class='sidebar'><p>Something long enough to look like text, with a sentence, and another one after it.</p></div>{}",
        "<div id='cookieBanner'>We use cookies on this site to make it better for you and for all of our partners.</div>{}",
        "{}<section id='comments'><article><p>I was the first reader to say something long and wise about it here.</p></article></section>",
        "{}<div class=\"reader-comments\"><p>No.</p></div>",
        "<form action=/s><p>Search for whatever you like in all of our pages and those of others.</p></form>{}",
        "<script>var a = '<article><p>no</p></article>';</script><style>p{{margin:0}}</style>{}<noscript><p>Turn it on</p></noscript>",
        "<!-- <article><p>no</p> -->{}<template><p>no text of the page</p></template><div class=ad>Buy now!</div>",
        "<body class='menu-open ad-free'><div role=\"search\">Search here</div>{}</body>",
        "<div data-x='a>b' title=\"<p>\">menu</div>{}<p hidden>hidden words</p>",
    ],
)
def test_left_out(around):
    assert text(around.format(ARTICLE)) == EXPECTED


def test_parts_inside_the_article():
    inner = (
        "<article><header><h1>T</h1></header><p>One <a href='/'>two</a> three.</p><div class='ad'><p>Buy this now, it is cheap.</p></div>"
        "<ul><li>a b</li><li>c</li></ul><p>End.</p><section class=comments><h2>Comments</h2><p>Nice words by a reader, and a few more.</p></section></article>"
    )
    assert text(inner) == "T\nOne two three.\na b\nc\nEnd."


def test_references_and_white_space():
    page = "<article><p> a&amp;b &lt;i&gt; &#65;&#x42; &eacute;&nbsp;x\r\n\t y &amp &am; &notin; 1 < 2 <b>bo</b>ld<br>er</p></article>"
    assert text(page) == "a&b <i> AB é x y & &am; ∉ 1 < 2 bold er"


def test_cut_off_pages():
    assert text("<article><p>One two</p><p>Three fo") == "One two\nThree fo"
    assert text("<article><p>One two</p><p") == "One two"
    assert text("<article><p>One two</p><a href='x") == "One two"
    assert text("<article><p>One two <!-- three") == "One two"
    assert text("<article><p>One two <script>x") == "One two"
    assert text("<article><p>One &am") == "One &am"
    assert text("<article><p>One two<") == "One two<"


def test_pages_without_marks_need_words_and_link_density():
    filler = " ".join(["word"] * 45) + "."
    links = "".join(f"<div><a href='/'>{' '.join(['go'] * n)}</a></div>" for n in (30, 2, 28))
    got = text(f"{links}<div>{filler}</div><div>{filler}</div><div>{filler}</div>{links}")
    assert got == "\n".join([filler] * 3)


def test_labelled_table_and_tree():
    x, y = html_blocks.labelled_blocks(LABELLED_PAGES)
    assert len(x) > 200 and (html_blocks.default_tree().predict(x) == (y == 1)).mean() > 0.97
    used = set(html_blocks.default_tree().feature.tolist())
    assert used & {0, 2, 4} and used & {1, 3, 5}  # words and link densities
    # Held-out pages: each is left out in turn.
    right = total = 0
    for k in range(len(LABELLED_PAGES)):
        tree = fit_tree(*html_blocks.labelled_blocks(LABELLED_PAGES[:k] + LABELLED_PAGES[k + 1 :]))
        x, y = html_blocks.labelled_blocks(LABELLED_PAGES[k : k + 1])
        right += int((tree.predict(x) == (y == 1)).sum())
        total += len(y)
    assert right / total > 0.9


def test_tree_splits():
    x = np.array([[0, 1], [1, 0], [2, 1], [3, 0], [4, 1], [5, 0]], float)
    y = np.array([0, 0, 0, 1, 1, 1])
    tree = fit_tree(x, y, least=1)
    assert tree.feature.tolist()[0] == 0 and tree.threshold[0] == 2.5
    assert tree.predict(x).tolist() == [False] * 3 + [True] * 3
    assert fit_tree(x, np.zeros(6, int)).predict(x).tolist() == [False] * 6


def test_nulls_empty_long_and_repeated(spark):
    long_page = "<article>" + "<p>some words here</p>" * 50_000 + "</article>"
    nested = "<div>" * 3_000 + "<article><p>deep</p></article>"
    quotes = "<article><p>x</p>" + "<a b='" * 3_000
    rows = [(1, None), (2, ""), (3, long_page), (3, long_page), (None, ARTICLE), (5, "plain"), (6, nested), (7, quotes)]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = frame.select("page_id", html_blocks.main_text(F.col("html")).alias("text")).collect()
    texts = [r["text"] for r in got]
    assert texts[0] == texts[1] == "" and texts[2] == texts[3] == "\n".join(["some words here"] * 50_000)
    assert texts[4] == EXPECTED and texts[6] == "deep" and texts[7].startswith("x")
    assert frame.where("false").select(html_blocks.main_text(F.col("html"))).count() == 0
