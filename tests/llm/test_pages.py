"""Main text of pages: layouts by hand, the given pages against their markup, the scan against all runs."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from feedstream.llm import pages

PRIOR = dict(pages.PRIOR)
P1 = "The first paragraph of the article has a good number of words in it, as articles do."
P2 = "The second one goes on about the same matter and is about as long as the first one was."
P3 = "End."


def text(page, weights=PRIOR):
    return pages.content(page, weights)


LAYOUTS = {
    "article": (f"<html><body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{P1}<p>{P2}</p><p>{P3}</article>"
                f"<footer>All rights reserved by the owner of this page and others</footer></body></html>", ["Title", P1, P2, P3]),
    "classes": (f"<body><div id='top-nav'><ul><li><a>Home</a><li><a>News</a></ul></div><div class='cookie-notice'>We use cookies to "
                f"make this page better, do you agree?</div><div class=content><h1>Title</h1><div>{P1}</div><div class='ad-slot'>Buy this "
                f"now</div><p>{P2}</p></div><div class='comments'><h3>Comments</h3><p>{P1} I disagree with it.</p></div>"
                f"<div class='site-footer'>Contact and legal matters</div>", ["Title", P1, P2]),
    "comments inside": (f"<main><h1>Title</h1><p>{P1}</p><p>{P2}</p><section id=comments><article class=comment><p>{P1} {P2} {P1}"
                        f"</p></article></section></main>", ["Title", P1, P2]),
    "aside, form and share": (f"<article><header><h1>Title</h1></header><p>{P1}</p><aside><p>{P2} {P2} {P2}</p></aside><form>Your mail "
                              f"<input><button>Send</button></form><p>{P2}</p><div class='share-buttons'><a>Tweet</a></div></article>",
                              ["Title", P1, P2]),
    "lists and tables": (f"<article><p>{P1}</p><ul><li>one</li><li>two <b>bold</b><li>three</ul><table><tr><td>a<td>b</table><blockquote>"
                         f"said</blockquote><pre>x\n  y</pre></article>", [P1, "one", "two bold", "three", "a", "b", "said", "x y"]),
    "references": (f"<article><p>{P1} &lt;b&gt; &amp;amp; caf&eacute; &#8212; &#x1F600;&nbsp;x &notit; 3 < 4</p></article>",
                   [f"{P1} <b> &amp; café — 😀 x ¬it; 3 < 4"]),
    "scripts": (f"<head><title>T</title><style>p{{}}</style></head><script>var t='</p><p>{P2}';</script><article><p>{P1}<script>x<"
                f"</script> on</p><!-- <p>{P2}</p> --><noscript>{P2}</noscript><template>{P2}</template></article>", [P1 + " on"]),
    "quotes in attributes": (f"<article data-x='a > b' title=\"it's <p>\"><p class=x>{P1}</p></article>", [P1]),
    "breaks": (f"<article><p>{P1}<br>{P2}<br/>\n on  it</p></article>", [f"{P1} {P2} on it"]),
    "inline": (f"<article><p>{P1} in<b>side</b> <a href=x>a link of some words</a></p><p><a href=y>Read more</a></p></article>",
               [f"{P1} inside a link of some words", "Read more"]),
    "classes of the whole page": (f"<body class='has-sidebar no-comments'><div class='layout-with-sidebar'><div class='post'><h2>Title</h2>"
                                  f"<p>{P1}</p></div></div><div class=sidebar><p>{P2} {P2}</p></div></body>", ["Title", P1]),
    "hidden": (f"<article><p>{P1}</p><p hidden>{P2}</p><div style='display: none'>{P2}</div><p aria-hidden=true>x</p></article>", [P1]),
    "two articles": (f"<article><p>{P3}</p></article><article><p>{P1}</p><p>{P2}</p></article>", [P1, P2]),
    "closed twice": (f"</div></p><article></span><p>{P1}</b></p></article></article>", [P1]),
    "cut": (f"<article><p>{P1}</p><p>{P2}<a href='x", [P1, P2]),
    "no tags": (f"{P1}\n\n{P2}", [f"{P1} {P2}"]),
    "nothing": ("", []), "only tags": ("<p><div></div>", []), "only menu": ("<nav>a b c</nav>", []), "open script": ("<script>a b", []),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    assert text(LAYOUTS[name][0]) == LAYOUTS[name][1]


def expected(page):
    """Of the given pages, which all have one article of headings and paragraphs."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p)>", inner)]
    return [b for b in blocks if b]


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in pages.op11(spark, "/root/testdata/sf0.1").collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        whole = "\n\n".join(expected(r.html))
        assert got[r.page_id] == (whole, len(whole)), r.page_id


def test_run_with_the_largest_sum():
    """The linear scan against the sums of all runs."""
    chosen = random.Random(3)
    for _ in range(300):
        parts = [chosen.choice(["<hr>", "<section>", "</section>", "<p>", "<h2>", f"<p>{'w ' * chosen.randint(1, 9)}</p>"]) for _ in range(12)]
        weights = {**PRIOR, "hr": -chosen.random() * 9, "section": -5.0, "h2": -2.5}
        items = pages.blocks_of(pages.parsed("".join(parts)))
        score = [sum(weights[k] * n for k, n in pages.word_kinds(x)) if not x[0] else weights.get(x[0], pages.TAG) for x in items]
        best = max([0.0, *(sum(score[a:b]) for a in range(len(score)) for b in range(a + 1, len(score) + 1))])
        got = text("".join(parts), weights)
        runs = [[x[1] for x in items[a:b] if not x[0]] for a in range(len(score)) for b in range(a + 1, len(score) + 1)
                if abs(sum(score[a:b]) - best) < 1e-9]
        assert got in (runs or [[]])


def test_weights_come_from_labelled_pages(spark):
    page = f"<body><section>{P1}</section><hr><article><p>{P1}</p><figure>{P2}</figure></article></body>"
    rows = spark.createDataFrame([(i, page) for i in range(50)] + [(99, None), (100, "<p>no label")], "page_id long, html string")
    weights = pages.fit_weights(rows)
    assert weights["section"] < -1 and weights["hr"] < -1 and weights["figure"] == pages.LIGHT
    assert pages.fit_weights(rows.limit(0)) == PRIOR
    assert all(pages.LEAST <= w <= pages.MOST for k, w in weights.items() if k.startswith("word"))


def test_edge_rows(spark):
    deep, long = "<div>" * 3000 + P1, f"<article><p>{'many words ' * 200_000}</p></article>"
    rows = [(1, None), (2, ""), (3, deep), (3, deep), (None, P1), (4, long), (5, "<a '" * 2000), (6, "<" * 5000), (7, "&#0; &#xD800; <p>\x00" + P1)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns(
        {"text": F.lit("old"), "n_chars": F.lit("x"), "_html": F.lit("y")})
    got = pages.main_text(df, PRIOR)
    assert got.columns == ["page_id", "n_chars", "_html", "text"]
    texts = [(r.page_id, r.text) for r in got.collect()]
    assert len(texts) == len(rows) and texts[:5] == [(1, ""), (2, ""), (3, P1), (3, P1), (None, P1)]
    assert texts[5][1] == " ".join(["many words"] * 200_000)
    assert pages.main_text(df.limit(0), PRIOR).count() == 0
