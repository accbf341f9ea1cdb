"""Main texts: blocks of marked-up cases, the given pages against a plain reading of their articles, layouts that weren't learnt."""

import html
import re

import numpy as np
import pytest

from sheafwork.llm import queries
from sheafwork.llm.common import table
from sheafwork.llm.page_text import _path, _backward, _forward, layouts, learn_labeller, main_text, page_blocks


def texts(page):
    return [t for _, t, _ in page_blocks(page)]


def test_blocks_of_broken_markup():
    assert texts("<p>a <b>b<br>c</b>\n d<p>e</div> f<i>g</i><ul><li>x<li>y</ul>z") == ["a b c d", "e", "fg", "x", "y", "z"]
    assert texts("<script>var t='</p>';</script ><style>p{}</style>a<!-- <p>no</p> -->b<!-- open") == ["ab"]
    assert texts("1 < 2 &amp; 3 &gt; 2 &lt;p&gt; &#233;&eacute;&am &copy &nbsp; x") == ["1 < 2 & 3 > 2 <p> éé&am © x"]
    assert texts("<a title='x > y' href=z>in</a><p class=\"a'b\">q</p><p unclosed") == ["in", "q"]
    assert texts("<script>never closed <p>a") == [] and texts("") == [] and texts("plain") == ["plain"] and texts("</>x<?php >y") == ["xy"]
    paths = [p for p, *_ in page_blocks("<div class='Side-bar main'><p>a<div id=adBox>b</div></div><p>c")]
    assert paths == [("<div", "side", "bar", "main", "<p"), ("<div", "side", "bar", "main", "<div", "ad", "box"), ("<p",)]


def test_long_pages_take_time_in_proportion():
    assert len(texts("<p>x" * 50_000)) == 50_000
    assert texts("<" * 200_000) == ["<" * 200_000]
    assert len(texts("<a b='" * 20_000 + "<p>x")) <= 2
    assert texts("<div>" * 2_000 + "x") == ["x"]


def test_gradients():
    r = np.random.default_rng(0)
    gates, u, weight = r.normal(size=(2, 4, 12)), r.normal(size=(3, 12)), r.normal(size=(2, 4, 3))
    loss = lambda: float((_forward(gates, u)[0] * weight).sum())
    dgates, du = _backward(weight, _forward(gates, u)[1], u)
    for a, d in ((gates, dgates), (u, du)):
        for _ in range(12):
            i = tuple(r.integers(s) for s in a.shape)
            old = a[i]
            a[i] = old + 1e-5
            up = loss()
            a[i] = old - 1e-5
            down = loss()
            a[i] = old
            assert abs((up - down) / 2e-5 - d[i]) < 1e-6


@pytest.fixture(scope="module")
def labeller(spark):
    return learn_labeller(table(spark, "/root/testdata/sf0.001", "pages"))


def article(page):
    inner = re.search(r"<article>(.*?)(?:</article>|<footer|$)", page, re.S)[1]
    found = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
    return "\n\n".join(b for b in found if b)


def test_given_pages(spark, sf_dir):
    want = {r.page_id: (r.url, article(r.html)) for r in table(spark, sf_dir, "pages").collect()}
    found = {r.page_id: (r.url, r.text) for r in queries.QUERIES["op13_block_labeller"](spark, sf_dir).collect()}
    assert found == want


def test_pages_that_were_not_in_the_sample(spark, labeller):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    rows = main_text(pages.withColumnsRenamed({"url": "text"}), labeller, keep=["page_id", "html", "text"]).collect()
    assert len(rows) == 250 and all(r["text_"] == article(r.html) and r.n_chars == len(r["text_"]) for r in rows)


def test_layouts_that_were_not_learnt(spark, labeller):
    sample = [page_blocks(r.html) for r in table(spark, "/root/testdata/sf0.01", "pages").orderBy("page_id").limit(60).collect()]
    fresh = layouts(sample, 300, seed=77)
    found = labeller.labels([x for x, _ in fresh])
    right = np.concatenate([np.array(y) == f for (_, y), f in zip(fresh, found)])
    assert right.mean() > 0.98


def test_context_of_blocks_counts(labeller):
    """A block without a telling path is judged by the blocks around it."""
    body = "The garden was quiet, and the gate stood open for anyone who came by. " * 3
    page = [(_path("html body div.post p"), body, 0)] * 3
    side = [(_path("html body div.sidebar ul li"), "About us", 8)] * 3
    a, b = labeller.labels([side + page + side, page])
    assert a.tolist() == [False] * 3 + [True] * 3 + [False] * 3 and b.all()


def test_nulls_and_empty_tables(spark, labeller):
    schema = "page_id long, url string, html string, text string, id int"
    rows = [(None, None, None, "t", 1), (1, "u", "", None, None), (1, "u", "", None, None), (2, "v", "<article><p>Only this one.</p></article>", "", 0)]
    found = main_text(spark.createDataFrame(rows, schema), labeller, keep=["page_id", "url", "text"]).collect()
    assert sorted((r[0] or 0, r["text_"], r["n_chars"]) for r in found) == [(0, "", 0), (1, "", 0), (1, "", 0), (2, "Only this one.", 14)]
    empty = spark.createDataFrame([], schema)
    assert main_text(empty, learn_labeller(empty)).collect() == []
    assert main_text(spark.createDataFrame(rows[:1], schema), learn_labeller(spark.createDataFrame(rows[:1], schema))).count() == 1
