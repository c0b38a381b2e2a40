"""Extraction of main texts: the field against plain sums, held-out layouts, and the given pages."""

import html
import itertools
import re

import numpy as np
import pytest
from conftest import SF_DIR

from stockloom.llm import html_text, layouts
from stockloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return html_text.train()


def test_viterbi_equals_search_of_all_paths():
    drawn = np.random.default_rng(1)
    for n in (1, 2, 7):
        score, step = drawn.normal(size=(n, 2)), drawn.normal(size=(2, 2))
        value = lambda p: sum(score[range(n), p]) + sum(step[a, b] for a, b in itertools.pairwise(p))
        assert tuple(html_text.viterbi(score, step)) == max(itertools.product((0, 1), repeat=n), key=value)


def test_likelihood_and_gradient_equal_plain_sums():
    drawn = np.random.default_rng(2)
    chains = [([[1, 5], [5], [2, 3]], [0, 1, 1]), ([[4]], [1]), ([[1], [2]], [1, 0])]
    data = html_text.padded(chains)
    weight, step = np.zeros((html_text.SLOTS, 2)), drawn.normal(size=(2, 2))
    weight[:6] = drawn.normal(size=(6, 2))

    def plain(weight, step):
        total = 0
        for seen, known in chains:
            score = np.array([weight[s].sum(0) for s in seen])
            value = lambda p: sum(score[range(len(p)), p]) + sum(step[a, b] for a, b in itertools.pairwise(p))
            every = [value(p) for p in itertools.product((0, 1), repeat=len(seen))]
            total += value(known) - np.logaddexp.reduce(every)
        return total / len(chains)

    value, slope, slope_step = html_text.likelihood(weight, step, data)
    assert np.isclose(value, plain(weight, step))
    for table, found, at in ((weight, slope, (5, 1)), (weight, slope, (2, 0)), (step, slope_step, (0, 1)), (step, slope_step, (1, 1))):
        table[at] += 1e-5
        above = plain(weight, step)
        table[at] -= 2e-5
        below = plain(weight, step)
        table[at] += 1e-5
        assert np.isclose(found[at], (above - below) / 2e-5, atol=1e-6)


def test_held_out_layouts(model):
    good = total = 0
    for seen, known in html_text.labelled_chains(200, seed=77):
        path = html_text.viterbi(html_text.scores(seen, model), model.step)
        good, total = good + sum(a == b for a, b in zip(path, known)), total + len(known)
    assert good / total > 0.98


PAGE = """<!doctype html><html><head><title>News</title><script>if (a < b) document.write("<p>x</p>")</script></head><body>
<div id="cookie-banner" class="notice"><p>We use cookies on this site.</p><button>Accept</button></div>
<header class="site-header"><a href="/">The Daily</a><form action="/s"><input name="q"><label>Search</label></form></header>
<nav><ul><li><a href="/a">Politics</a><li><a href="/b">Sports</a></ul></nav>
<div class="wrapper"><article class="post"><h1>Bridge opens &amp; traffic&nbsp;flows</h1>
<p>The bridge opened on <b>Monday</b>,
 after two years.<p>It cost 3 &lt; 4 million &#8364;.
<div class="ad"><p>Buy tyres now!</p></div>
<p>Engineers said &quot;it will last&quot;.<br>They smiled.</p>
<ul><li>Length: 300 m</li><li>Width: 20 m</li></ul></article>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/x">Cat on the roof again</a></li></ul></aside></div>
<section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>What a fine bridge. I drove over it.</p></div></section>
<form class="newsletter"><p>Subscribe to our newsletter</p></form>
<footer>&copy; The Daily. All rights reserved. <a href="/i">Imprint</a></footer></body></html>"""


def test_a_usual_page(model):
    assert html_text.main_text(PAGE, model).split("\n") == [
        "Bridge opens & traffic flows",
        "The bridge opened on Monday, after two years.",
        "It cost 3 < 4 million €.",
        "Engineers said \"it will last\". They smiled.",
        "Length: 300 m",
        "Width: 20 m",
    ]


def _article(page):
    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r for r in QUERIES["op12_html_extraction"](spark, SF_DIR).collect()}
    rows = pages.collect()
    assert len(got) == len(rows) and all(got[r.page_id].url == r.url for r in rows)
    assert [got[r.page_id].text for r in rows] == [_article(r.html) for r in rows]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_odd_pages(spark, model):
    long = "<article>" + "".join(f"<p>Paragraph {i} of a very long page, with words.</p>" for i in range(20_000)) + "</article>"
    deep = "<div>" * 3000 + "Some deep words, at last." + "</div>" * 3000
    pages = [None, "", "   ", "plain words, no markup at all.", "<p>open <b>bold", "</div></p>x < y & z &unknown; &#0;", "<![weird[x]]><!-- <p>no</p>", deep, long, long]
    rows = [(i, None if i == 1 else "u", p, "old", 3, 1.5) for i, p in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, score double")
    found = html_text.extracted(table, model)
    assert found.columns == ["page_id", "url", "score", "text", "n_chars"]
    got = {r.page_id: r for r in found.collect()}
    assert len(got) == len(pages) and [got[i].text for i in range(3)] == [""] * 3 and got[1].url is None
    assert got[8].text == got[9].text and got[8].text.count("\n") == 19_999 and got[8].n_chars == len(got[8].text)
    assert html_text.extracted(table.limit(0), model).collect() == []


def test_layouts_repeat():
    assert list(layouts.labelled_pages(5, 3)) == list(layouts.labelled_pages(5, 3))
