import html
import re

import numpy as np
import pytest

from vistaloom.llm import html as pages
from vistaloom.llm import html_training, queries

from .hand_pages import PAGES


def article(page):
    """Main text of the test pages, whose template has one <article>."""
    body = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    text = re.sub(r"<(?!/?(?:b|i|em|a)\b)[a-zA-Z/!][^>]*>", " ", body[1]) if body else ""
    return " ".join(html.unescape(re.sub(r"</?[a-z][^>]*>", "", text)).split())


def test_query_finds_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: (r.url, article(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    out = queries.queries()["op4_main_text"](spark, sf).collect()
    assert sorted(r.page_id for r in out) == sorted(want)
    assert all(r.url == want[r.page_id][0] and r.n_chars == len(r.text) for r in out)
    assert np.mean([r.text == want[r.page_id][1] for r in out]) >= 0.99


def test_labeller_on_pages_of_other_makers():
    assert html_training.accuracy(pages.Labeller.load(), pages=150) > 0.985


@pytest.mark.parametrize("page,blocks", [
    (None, []), ("", []), (" \n", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<b>b</b>c<br>d <p>e&nbsp;&#x41;\n f", ["abc", "d", "e A f"]),
    ("<ul><li>x<li>y</ul>z", ["x", "y", "z"]), ("<script>no<p></script><style>no</style><p>yes<!-- no -->!", ["yes!"]),
    ("<html><head><title>no</title></head><body>yes<div>also", ["yes", "also"]), ("<div a='>'>ok</div></p></div>&lt;b&gt;", ["ok", "<b>"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("<p>" + "word " * 100_000, [("word " * 100_000).strip()]), ("<script>never closed", []),
])
def test_blocks(page, blocks):
    assert [b.text for b in pages.blocks_of(page)] == blocks


def test_long_pages_keep_every_block():
    page = "<body><article><h1>A title of it.</h1>" + "".join(f"<p>Sentence number {i}, which is main text.</p>" for i in range(3000)) + "</article>"
    assert pages.extract(pages.Labeller.load(), [page])[0].count("Sentence number") == 3000


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    w = {"v": rng.normal(0, 0.5, (6, 1)), "c": np.zeros(1)}
    for k in (0, 1):
        w |= {f"wx{k}": rng.normal(0, 0.5, (4, 12)), f"wh{k}": rng.normal(0, 0.5, (3, 12)), f"b{k}": rng.normal(0, 0.5, 12)}
    model = pages.Labeller(w)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, y, m = rng.normal(size=(5, 2, 4)), rng.integers(0, 2, (5, 2, 1)).astype(float), np.ones((5, 2, 1))
    m[3:, 1] = 0
    x = x * m
    _, grads = html_training.gradients(model, x, y, m)
    for name in ("wx0", "wh1", "b0", "v"):
        at = tuple(0 for _ in model.w[name].shape)
        old, e, loss = model.w[name][at], 1e-2, []
        for d in (e, -e):
            model.w[name][at] = old + d
            loss.append(html_training.gradients(model, x, y, m)[0])
        model.w[name][at] = old
        assert grads[name][at] == pytest.approx((loss[0] - loss[1]) / (2 * e), rel=0.05, abs=2e-4)


def test_odd_rows(spark):
    rows = [(1, "u", "<article><p>Some text that is here.</p></article>"), (2, None, None), (None, "u", ""), (1, "u", "<article><p>Some text that is here.</p></article>")]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    out = pages.main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in out.collect()) == sorted((str(i), str(u), "Some text that is here." if h else "", 23 if h else 0) for i, u, h in rows)
    assert pages.main_text(df.where("false")).count() == 0


@pytest.mark.parametrize("name", PAGES)
def test_pages_by_hand(name):
    page, text = PAGES[name]
    assert pages.extract(pages.Labeller.load(), [page]) == [text]


@pytest.mark.parametrize("tag", sorted(pages.HIDDEN - {"head", "script", "style", "title"}))
def test_what_is_hidden_without_an_end_hides_nothing_else(tag):
    blocks = lambda page: [b.text for b in pages.blocks_of(page)]
    assert blocks(f"<body><{tag}><p>one</p><p>two</p>") == ["one", "two"]
    assert blocks(f"<body><{tag}><p>one</p></{tag}><p>two</p>") == ["two"]
