"""Main text: minimum cuts against brute force, and pages of several shapes."""

from __future__ import annotations

import itertools
import random

from cadence.llm import html


def test_cuts_are_minimal():
    rnd = random.Random(4)
    for _ in range(300):
        n = rnd.randint(1, 8)
        odds = [rnd.choice([-3, -1.5, -0.5, 0.5, 1.5, 3]) for _ in range(n)]
        edges = {(i, j): rnd.choice([0.5, 1.0, 2.0]) for i, j in itertools.combinations(range(n), 2) if rnd.random() < 0.4}
        cost = lambda x: sum(abs(z) for z, v in zip(odds, x) if (z > 0) != v) + sum(w for (i, j), w in edges.items() if x[i] != x[j])  # noqa: B023, E731
        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(html.minimum_cut(odds, edges)) - best) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{color:red}</style><script>document.write("<p>no</p>")</script></head>
<body class="main page"><header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies on this site. Please accept them all.</div>
<article><h1>Real &amp; true</h1><p><b>First   paragraph
 of text.<br><p>Second&nbsp;one has <i>more</i> words&hellip; It goes on.</p>
<div class="ad">Buy now! Cheap things. Really good offers here.</div><p>Short.</p>
<form><label>Mail</label><input name=x><button>Send</button></form><aside>Related stories. More of them.</aside>
<blockquote>A quote that belongs here.</blockquote></article>
<section id="comments"><p>Great article! I liked it. Thank you so much for this.</p></section><footer>&copy; 2020</footer>"""


def test_article_without_its_frame():
    assert html.main_text(PAGE).split("\n") == [
        "Real & true", "First paragraph of text.", "Second one has more words… It goes on.", "Short.", "A quote that belongs here.",
    ]


def test_pages_without_marks_and_broken_pages():
    frame = '<div class="menu"><a href=a>Home</a> <a href=b>News</a></div>'
    body = "<div><p>Some text here. It is long enough to be content.</p><p>Ok.</p></div>"
    assert html.main_text(frame + body) == "Some text here. It is long enough to be content.\nOk."
    assert html.main_text("<article><p>cut off in the mid<b>dle</") == "cut off in the middle"
    assert html.main_text("<article>1 < 2 and a <3 b</article>") == "1 < 2 and a <3 b"
    assert html.main_text("<!-- <p>x</p> --><script>never closed <p>y") == ""


def test_columns_nulls_long_pages_and_empty_table(spark):
    long = "<article>" + "".join(f"<p>Paragraph number {i} is here. It has text.</p>" for i in range(5000)) + "</article>"
    rows = [(1, "u", None, "old"), (2, None, "", "old"), (3, "u", PAGE, "old"), (3, "u", PAGE, "old"), (None, "u", long, "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 5 and by[1].text == by[2].text == "" and by[1].n_chars == 0
    assert by[None].text.count("\n") == 4999 and by[3].n_chars == len(by[3].text)
    assert html.extract(pages.limit(0)).count() == 0
