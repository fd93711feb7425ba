import html
import re

import duckdb
import pytest

from geoweave.llm import html_text as H


@pytest.fixture(scope="module")
def model():
    return H.trained()


def article(page):
    a = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    s = re.sub(r"</?(?:p|br|h1)>", " ", a[1]) if a else ""
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", s))).strip()


def test_blocks_of_broken_markup():
    def texts(p):
        return [b.text for b in H.blocks(p)]

    assert texts("<p><b>one<br><p>two &amp; <i>th</i>ree</p>four") == ["one", "two & three", "four"]
    assert texts("<!-- <p>no</p> --><script>var a='<p>x</p>';</script><style>p{}</style><p title='a>b'>yes") == ["yes"]
    assert texts("<head><title>t</title></head><body>x<select><option>o</select>y") == ["x", "y"] or texts("<head><title>t</title></head><body>x") == ["x"]
    assert texts("a<!-- never ends") == ["a"] and texts("a<p class='open") == ["a"] and texts("<script>never") == []
    assert texts("") == [] and texts("   ") == [] and texts("1 < 2 and 3 > 2") == ["1 < 2 and 3 > 2"]
    assert texts("<p>&copy &#233;&#x41; &am") == ["© éA &am"]
    assert [b.path[-1] for b in H.blocks("<ul><li>a<li>b</ul><p>c<div>d</div>")] == ["li", "li", "p", "div"]


def test_heads_that_never_close():
    def texts(p):
        return [b.text for b in H.blocks(p)]

    assert texts("<html><head><title>t</title><article><p>text</p></article>") == ["text"]
    assert texts("<head><meta charset=u><link href=x><style>p{}</style><script>'<p>'</script><a href=z>in</a> line<p>p") == ["in line", "p"]
    assert texts("<head><title>t</title>\n plain words<p>p") == ["plain words", "p"]
    assert texts("<head><title>t</title><template><p>no</p></template><noscript><p>no</p></noscript><header>h</header><p>p") == ["h", "p"]
    assert texts("<head>\n<title>t</title>\n</head><p>p") == texts("<head><title>t</title><body><p>p") == ["p"]


def test_held_out_layouts(model):
    pages = list(H.layouts(200, seed=77))
    got = H.main_texts([p for p, _ in pages], model)
    assert sum(g == w for g, (_, w) in zip(got, pages, strict=True)) >= 180


def test_given_pages(model):
    rows = duckdb.sql("select html from read_parquet('/root/testdata/sf0.01/pages.parquet')").fetchall()
    got = H.main_texts([r[0] for r in rows], model)
    assert sum(g == article(r[0]) for g, r in zip(got, rows, strict=True)) >= 0.98 * len(rows)


def test_gradients_match_differences():
    import numpy as np

    m = H.Labeller(1)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4, 3, H.INPUT)).astype(np.float32) * 0.3
    mask = np.arange(4)[:, None] < np.array([4, 2, 3])[None]
    g = rng.standard_normal((4, 3, H.HIDDEN)).astype(np.float32) * mask[:, :, None]
    out, tape = H._forward(x, mask, *m.p[:3], keep=True)
    dw, du, db = H._backward(x, g, tape, m.p[0], m.p[1])
    for k, grad, where in ((0, dw, (5, 30)), (1, du, (2, 50)), (2, db, (7,))):
        eps, old = 1e-2, m.p[k][where]
        m.p[k][where] = old + eps
        hi = (H._forward(x, mask, *m.p[:3])[0] * g).sum()
        m.p[k][where] = old - eps
        lo = (H._forward(x, mask, *m.p[:3])[0] * g).sum()
        m.p[k][where] = old
        assert abs((hi - lo) / (2 * eps) - grad[where]) < 2e-2 * max(1, abs(grad[where]))


def test_extract_edges(spark):
    page = "<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>T</h1><p>" + "Some words here, and more of them. " * 5 + "</p></article><footer>&copy; x</footer>"
    long = "<article>" + "<p>Many words stand in this paragraph, one after another.</p>" * 6000 + "</article>"
    rows = [(1, "u", page, 3), (2, None, None, 3), (3, "u", "", 3), (None, "u", page, 3), (1, "u", page, 3), (4, "u", long, 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = H.extract(df).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 6 and by[2].text == by[3].text == "" and by[2].n_chars == 0
    assert by[1].text.startswith("T Some words") and "Home" not in by[1].text and by[None].text == by[1].text
    assert by[1].n_chars == len(by[1].text) and len(by[4].text) > 0.95 * 6000 * 56
    assert H.extract(df.limit(0)).collect() == []
