"""Main-text extraction: the reader, the decoding against all states, and held-out pages."""

import itertools

import numpy as np
import pytest

from tidemark.llm import pagetext
from tidemark.llm.boosting import BoostedTrees
from tidemark.llm.dom import read_page
from tidemark.llm.layouts import labelled_pages
from tidemark.llm.pagetext import DROP, KEEP, MIXED

PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def model():
    return pagetext.train()


def blocks(html):
    return [text for _, text, _ in read_page(html).blocks]


def test_reader_on_odd_markup():
    assert blocks("<p>a<b>b</b> c<br>d\n\t e&amp;&lt;&#233;&nbsp;f<p>g<ul><li>h<li>i</ul>j") == ["ab c d e&<é f", "g", "h", "i", "j"]
    assert blocks('<script>var t="</p>";</SCRIPT x><style>p{}</style><title>t</title>a<textarea>x</textarea><select><option>y</select>b') == ["a", "b"]
    assert blocks("<!-- <p>no --><!DOCTYPE x><p class='a>b' id=\"c>d\">yes</p><p>1 < 2 &unknown; & 3</p>") == ["yes", "1 < 2 &unknown; & 3"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></div></p>f") == ["a", "b", "c", "d", "e", "f"]
    assert blocks("") == [] == blocks("<p> \n </p><br>") == blocks("<script>never closed <p>x") == blocks('<p title="never closed>x')
    assert blocks("plain text") == ["plain text"] and blocks("<p>cut <b") == ["cut"] and blocks("a<!-- open") == ["a"]
    deep = read_page("<div>" * 3000 + "x" + "</p></span>" * 3000 + "</div>" * 10)
    assert [t for _, t, _ in deep.blocks] == ["x"] and deep.nodes[deep.blocks[0][0]].depth == 3000
    assert read_page("<p>a <a href=x>bc</a></p>").blocks == [(1, "a bc", 2)]


def test_decoding_takes_the_most_likely_allowed_states():
    rng = np.random.default_rng(41)
    pages = [read_page(h) for h in ("<div><p>a</p><ul><li>b<li>c</ul></div><p>d", "<div><div><p>a</div></div>", "x", "<p>a<p>b<p>c<p>d")]
    nodes = pagetext.gather(pages)
    for _ in range(60):
        log_p = np.log(rng.dirichlet([0.7] * 3, len(nodes.tag)))
        state = pagetext.decode(log_p, nodes)
        for page, base in zip(pages, nodes.first.tolist()):
            n = len(page.nodes)
            allowed = {MIXED: (MIXED, KEEP, DROP), KEEP: (KEEP, DROP), DROP: (DROP,)}
            every = (s for s in itertools.product(range(3), repeat=n) if all(s[i] in allowed[s[v.parent]] for i, v in enumerate(page.nodes) if i))
            best = max(sum(log_p[base + i, x] for i, x in enumerate(s)) for s in every)
            assert sum(log_p[base + i, x] for i, x in enumerate(state[base : base + n])) == pytest.approx(best)


def test_boosted_trees_learn_a_rule_of_two_columns():
    rng = np.random.default_rng(43)
    x = rng.random((4000, 6)).astype(np.float32)
    y = np.where(x[:, 1] > 0.6, 2, (x[:, 4] > 0.5).astype(int))
    fitted = BoostedTrees(3, 25, columns=0.7).fit(x[:3000], y[:3000])
    assert (fitted.log_odds(x[3000:]).argmax(axis=1) == y[3000:]).mean() > 0.97
    assert np.exp(fitted.log_probabilities(x[:50])).sum(axis=1) == pytest.approx(1)
    again = BoostedTrees(3, 25, columns=0.7).fit(x[:3000], y[:3000])
    assert (again.log_odds(x) == fitted.log_odds(x)).all()


def test_held_out_layouts(model):
    pages = [read_page(h) for h in labelled_pages(200, 99)]
    nodes, state = model.states(pages)
    hits = kept = main = 0
    for page, base in zip(pages, nodes.first.tolist()):
        want, got = ({(i, t) for i, (n, t, _) in enumerate(page.blocks) if x[n] == KEEP} for x in (pagetext.node_labels(page), state[base : base + len(page.nodes)]))
        hits, kept, main = hits + len(want & got), kept + len(got), main + len(want)
    assert hits >= 0.96 * main and hits >= 0.96 * kept


def test_given_pages_give_their_articles(spark, model):
    rows = pagetext.extract_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), model).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    wrong = 0
    for r in rows:
        page = read_page(html[r["page_id"]])
        article = next(i for i, n in enumerate(page.nodes) if n.tag == "article")
        wrong += r["text"] != "\n".join(t for n, t, _ in page.blocks if article <= n < page.ends[article])
        assert r["n_chars"] == len(r["text"])
    assert len(rows) == len(html) and wrong == 0


def test_parts_of_other_pages(spark, model):
    text = "The council met on Monday to discuss the new bridge. Work begins in spring, and the road stays open."
    html = (
        '<html><head><title>t</title></head><body><div id="cookie-notice"><p>We use cookies to improve this site. Please accept.</p></div><header><a href="/">Site</a>'
        '<nav><a href="/a">News</a> <a href="/b">Sport</a></nav></header><main><article><h1>A new bridge</h1>'
        f'<p>{text}</p><div class="advert">Buy our shoes now, they are cheap.</div><p>{text} &copy;</p></article></main>'
        '<section id="comments"><h3>Comments</h3><div class="comment"><p>I think this is a fine idea, the old one is too narrow.</p></div>'
        '<form><textarea>say</textarea><button>Send</button></form></section><aside class="sidebar"><p>Most read</p><ul><li><a href="/c">Other</a></ul></aside>'
        "<footer>&copy; Site. All rights reserved.</footer></body></html>"
    )
    rows = [(1, "u", html), (1, "u", html), (None, None, None), (2, "v", ""), (3, "w", html.replace("</p>", f"</p><p>{text}</p>" * 2000, 1))]
    pages = spark.createDataFrame(rows, PAGES)
    got = sorted(map(tuple, pagetext.extract_text(pages, model).collect()), key=repr)
    want = f"A new bridge\n{text}\n{text} ©"
    assert got[:2] == [(1, "u", want, len(want))] * 2 and got[2] == (2, "v", "", 0) and got[4] == (None, None, "", 0)
    assert got[3][2].count(text) >= 2000
    clash = pages.selectExpr("*", "'x' AS text", "1 AS n_chars", "'x' AS node")
    assert sorted(map(tuple, pagetext.extract_text(clash, model).collect()), key=repr) == got
    assert pagetext.extract_text(pages.limit(0), model).collect() == []
