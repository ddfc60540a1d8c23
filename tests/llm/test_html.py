"""Main text of pages: the parser, the tree model against full enumeration, held-out pages, odd pages."""

import itertools

import numpy as np
import pytest

from merchant_signals.llm import dom, html_extract, labelled_pages, queries
from tests.llm import brute

PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t) for i, t in brute.corpus(600, seed=9)], "doc_id bigint, text string")
    return html_extract.fit(labelled_pages.labelled_pages(docs))


def blocks(html):
    page = dom.parse(html)
    return [(page.tag[page.parent[i]], t) for i, t in enumerate(page.text) if t is not None]


def test_parser():
    assert blocks("<p>a <b>b</b>c<br>d<p>e") == [("p", "a bc d"), ("p", "e")]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d"), ("#page", "e")]
    assert blocks("<script>var t='</p><p>x'</script><style>p{}</style><p>a</p><!-- <p>no</p> -->") == [("p", "a")]
    assert blocks("<p>a &amp; &lt;b&gt; &eacute;&#233;&#xe9; &am &nbsp; x</p>") == [("p", "a & <b> ééé &am x")]
    assert blocks("</div></p>x<div>y</span>z") == [("#page", "x"), ("div", "yz")]
    assert blocks("a < b <3 c") == [("#page", "a < b <3 c")]
    assert blocks('<div title="a > b">x') == [("div", "x")]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == [("td", "a"), ("td", "b"), ("td", "c")]
    assert blocks("<head><title>no</title><body>yes") == [("body", "yes")]
    for cut in ("<", "<p", '<p class="', "<!--", "<script>", "&", "", "<!", "</"):
        assert len(blocks("<p>x</p>" + cut)) in (1, 2)
    deep = dom.parse("<div>" * 30_000 + "x")
    assert deep.text[-1] == "x" and len(deep.tag) == 30_002
    assert dom.words_of_names("siteFooter nav-2_Main") == ["site", "footer", "nav", "main"]


def test_message_passing_equals_enumeration(model):
    """Marginals of small trees, from the sum over all their states."""
    for html in ('<nav><a href="/">x</a></nav><article><p>A long enough line of text, it is.</p><div class="ad">y</div></article>',
                 "<p>x</p>", "", '<div class="comments"><p>z</p></div>'):
        page = dom.parse(html)
        n, s = len(page.tag), html_extract.STATES
        kinds, feats = html_extract._kinds(page), html_extract.features(page)
        total = np.zeros((n, s))
        for states in itertools.product(range(s), repeat=n):
            w = model.root[states[0]]
            for i in range(n):
                power = html_extract.BLOCK_POWER if page.tag[i] == "#text" else 1
                w += power * sum(model.feature[f][states[i]] for f in feats[i] if f in model.feature)
                if i:
                    w += model.child.get(kinds[i], model.any_child)[states[page.parent[i]], states[i]]
            for i in range(n):
                total[i, states[i]] += np.exp(w)
        want = total / total.sum(1, keepdims=True)
        for got in model.marginals([page, dom.parse("<p>other</p>"), page])[::2]:
            assert np.allclose(got, want, atol=1e-9)


def test_held_out_pages(model):
    """Pages that the model wasn't fitted on: nearly all blocks are told apart."""
    texts = [t for _, t in brute.corpus(300, seed=77) if t and t.strip()]
    right = wrong = 0
    for i in range(1, len(texts)):
        html, said = labelled_pages.lay_out(10**9 + i, texts[i], texts[i - 1])
        page = dom.parse(html)
        states = html_extract.label(page, list(labelled_pages.blocks_said(said)))
        kept = model.marginals([page])[0][:, html_extract.ALL] >= 0.5
        for t, state, k in zip(page.text, states, kept):
            if t is not None:
                right, wrong = right + ((state == html_extract.ALL) == k), wrong + ((state == html_extract.ALL) != k)
    assert right / (right + wrong) > 0.97


def test_extract_cases(spark, model):
    article = "<article><h1>Über all</h1><p>One   line\nof <i>text</i>,<br>and &amp; more.</p><div class='ad'>Buy this now</div></article>"
    page = f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{article}<section id='comments'><p>I liked it, thank you very much for this.</p></section><footer>&copy; x</footer>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<nav><a href='/'>Home</a></nav>"), (None, "u", page), (5, "u", page[:120])]
    docs = spark.createDataFrame([(*r, "t", 9) for r in rows], PAGES + ", text string, n_chars int")
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in html_extract.extract(docs, model).collect()), key=str)
    said = "Über all\n\nOne line of text, and & more."
    want = [(1, "u", said), (1, "u", said), (2, None, ""), (3, "u", ""), (4, "u", ""), (None, "u", said)]
    assert [g for g in got if g[0] != 5] == sorted(want, key=str)
    assert html_extract.extract(spark.createDataFrame([], PAGES), model).collect() == []
    long = "<article>" + "<p>word word word.</p>" * 40_000 + "</article>"
    r = html_extract.extract(spark.createDataFrame([(1, "u", long)], PAGES), model).first()
    assert r["text"].count("\n\n") == 39_999  # nothing is cut


def test_labels():
    page = dom.parse("<body><nav>x</nav><article><p>x</p><p>y</p></article><p>y</p></body>")
    states = html_extract.label(page, ["x", "y"])
    assert [page.tag[page.parent[i]] for i, t in enumerate(page.text) if t is not None and states[i] == html_extract.ALL] == ["p", "p"]
    assert html_extract.label(page, ["z"]) is None and html_extract.label(page, []) is None


def test_query_columns(spark, tmp_dir):
    spark.createDataFrame(brute.corpus(60), "doc_id bigint, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, "u", "<article><p>Ünï text.</p></article>")], PAGES).write.parquet(f"{tmp_dir}/pages.parquet")
    assert queries.op11_html_extraction(spark, tmp_dir).collect()[0].asDict() == {"page_id": 1, "url": "u", "text": "Ünï text.", "n_chars": 9}
    with pytest.raises(ValueError, match="labelled"):
        html_extract.fit(spark.createDataFrame([], "html string, blocks array<string>"))
