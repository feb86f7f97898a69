import re

import numpy as np
import pytest

from textloom.llm import html_extract as hx

from .common import clashing

SCHEMA = "page_id long, url string, html string"


def article_of(page):
    """By hand, for the synthetic pages: the text of the article element, one space for white space."""
    import html

    body = page[page.index("<article>") + 9 : page.rindex("</article>")]
    return " ".join(html.unescape(re.sub(r"<!--.*?-->", "", re.sub(r"</?(p|br|h1|li|ul|div|td|tr|table)\b[^>]*>", " ", body)).replace("<b>", "").replace("</b>", "")).split())


def test_synthetic_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    plain = [r for r in rows if r.html and "<article>" in r.html and "</article>" in r.html]
    assert len(plain) > 200
    bad = [r.page_id for r in plain if hx.main_text(r.html) != article_of(r.html)]
    assert not bad


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style><script>if (a<b) document.write("<p>no</p>")</script></head>
<body class="has-sidebar"><header><h1>Site</h1><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav></header>
<div class="cookie-notice">We use cookies to give you the best experience on this site, accept?</div>
{main}
<aside>Read also: something long enough to look like text, really, with many words in it.</aside>
<form><label>Mail</label><input name=q><button>Send</button></form><footer>&copy; 2020 Someone, all rights reserved</footer><script>x</script></body></html>"""
TEXT = "A first paragraph with enough words &amp; signs to count as text, and <b>bold</b> ones; caf&eacute; &#8211; fine."
MEANT = "A first paragraph with enough words & signs to count as text, and bold ones; café – fine."


@pytest.mark.parametrize(
    "main,want",
    [
        (f"<article><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p></article>", f"Head {MEANT} {MEANT}"),
        (f"<main><article><header><h1>Head</h1><div class=share>Share this</div></header><p>{TEXT}<ul><li>one<li>two</ul></article><section class=comments><p>{TEXT}</p></section></main>", f"Head {MEANT} one two"),
        (f"<div id=content><h1>Head</h1><p>{TEXT}</p><p>{TEXT}</p><p>short</p></div><div class='comment-list'><p>{TEXT}</p></div>", f"Head {MEANT} {MEANT} short"),
        (f"<table><tr><td width=20%><a href=1>one</a> <a href=2>two</a></td></tr></table><div><p>{TEXT}</p>\n<!-- <p>hidden</p> --><pre>a\n  b</pre><p>{TEXT}</p></div>", f"{MEANT} a b {MEANT}"),
        (f"<article><p>{TEXT}<br>line</p><div class='ad-slot'>Buy now, buy a lot of it, it is cheap</div><blockquote>{TEXT}</blockquote></article>", f"{MEANT} line {MEANT}"),
    ],
)
def test_pages_by_hand(main, want):
    assert hx.main_text(PAGE.format(main=main)) == want


@pytest.mark.parametrize(
    "hidden",
    [
        "<svg><path d='M0'/></svg>", "<svg><g><path d='M0'/><circle r='1'/></g></svg>", "<svg><g><path d='M0'></svg>", "<svg><title>icon</title><use href='#a'/></svg>", "<math><mi>x<mo/></math>",
        "<select><option>A<option>B</select>", "<datalist><option>A<option>B</datalist>", "<button><div>More</button>", "<object><param name='a'><p>No plugin</object>",
    ],
)
def test_text_after_hidden_elements_stays(hidden):
    for page in (f"<article>{hidden}<p>first part of it</p>{hidden}<p>second {hidden} part</p></article>", f"<body>{hidden}<p>first part of it</p><p>second {hidden} part</p></body>"):
        assert hx.main_text(page) == "first part of it second part", page


@pytest.mark.parametrize("page", [None, "", " \n ", "<", "<p", "<!--", "<p><b>", "</p></div>", "<![CDATA[x", "&#xZZ;", "<script>never ends", "<a href='", "\x00", "<p>" * 3000])
def test_nothing_fails(page):
    assert isinstance(hx.main_text(page), str)


def test_plain_text_is_its_own_article():
    assert hx.main_text("just  some\ntext &lt;b&gt; 1 < 2") == "just some text <b> 1 < 2"


def test_smoothing_and_clusters():
    x = np.array([0.0, 0, 0, 10, 10, 10, 0, 0])
    s = hx.smooth(x)
    assert len(s) == len(x) and s[4] > 8 and s[0] < 1
    assert hx.upper_cluster(s).tolist() == [False, False, False, True, True, True, False, False]
    assert hx.upper_cluster(np.ones(3)).all() and hx.smooth(np.ones(3)) == pytest.approx(np.ones(3))


def test_edges(spark):
    long = "<article>" + f"<p>{TEXT}</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x</p>"), (2, "u", ""), (3, "u", long)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "text", "n_chars", "h", "i", "u")
    out = sorted(((r.page_id, r.url, r.n_chars, r.text[:1]) for r in hx.extract(df).collect()), key=repr)
    assert out == sorted([(1, "u", 0, ""), (1, "u", 0, ""), (None, None, 1, "x"), (2, "u", 0, ""), (3, "u", 20_000 * (len(MEANT) + 1) - 1, "A")], key=repr)
    assert hx.extract(spark.createDataFrame([], SCHEMA)).collect() == []
