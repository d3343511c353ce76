"""Main text of pages: planted articles in many layouts, broken markup, and the given pages against a plain cut of their article element."""

import html
import re

import pytest

from tillstar.llm import html_text
from tillstar.llm import queries as registered

FOLDER = "/root/testdata/sf0.01"
PARAGRAPHS = [
    "Rain fell over the harbour all night, and by morning the lower streets, the market and the old quay were under water.",
    "Crews had been called at four, the mayor said, but the pumps were slow to start.",
    "Short.",
    "“Nobody slept,” one baker said & shrugged, “but the ovens are dry, so there is bread.”",
]
BODY = "".join(f"<p>{html.escape(p)}</p>" for p in PARAGRAPHS)
WANT = " ".join(PARAGRAPHS)
MENU = '<ul class="menu"><li><a href="/a">Home page</a></li><li><a href="/b">World news, politics</a></li><li><a href="/c">Sport</a></li></ul>'
COMMENTS = "<h3>Comments</h3>" + "".join(f"<p>I disagree, strongly, with point {i}, and so do all of my friends, I think.</p>" for i in range(30))
AROUND = {
    "elements": f"<header>Site name</header><nav>{MENU}</nav>%s<aside>Most read today, and more</aside><footer>&copy; All rights</footer>",
    "classes": f'<div class="site-header">Site name</div><div id="navBar">{MENU}</div>%s<div class="right-sidebar"><p>Most read, by far.</p></div>',
    "roles": f'<div role="banner">Site</div><div role="navigation">{MENU}</div>%s<div role="contentinfo">Imprint, legal</div>',
    "comments": f'%s<section id="comments">{COMMENTS}</section>',
    "notices": '<div class="cookie-banner"><p>We use cookies, and more cookies, to show you this page.</p></div>%s<div role="dialog">Sign in</div>',
    "adverts": '<div class="ad">Buy now, pay later, or never.</div>%s<div class="sponsored-box"><p>Our partner, the bank, lends.</p></div>',
    "forms": "<form><p>Your name, your address</p><input><textarea>write</textarea></form>%s<button>Send</button><select><option>One</select>",
    "hidden": '<script>var t = "<p>no, no, no</p>";</script><style>p{margin:0}</style>%s<noscript>Enable it</noscript><!-- <p>no</p> --><p hidden>x</p>',
}
HOLDERS = {
    "article": "<article>%s</article>",
    "main": "<main>%s</main>",
    "div": '<div class="post-content">%s</div>',
    "nested": "<div><div><div>%s</div></div></div>",
    "layout class": '<div class="content with-sidebar comments-open">%s</div>',
    "table": "<table><tr><td>%s</td></tr></table>",
}


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("holder", HOLDERS)
def test_article_alone_is_kept(around, holder):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{AROUND[around] % (HOLDERS[holder] % BODY)}</body></html>"
    assert html_text.main_text(page) == WANT


def test_sections_lists_and_headings_stay_whole():
    page = "<article><h1>Title</h1><section><p>One, two.</p></section><section><h2>Next</h2><ul><li>a<li>b</ul><pre>x\n  y</pre></section></article>"
    assert html_text.main_text(page) == "Title One, two. Next a b x y"
    split = f"<body><nav>{MENU}</nav><div><section>{BODY}</section><section>{BODY}</section><section><p>And so it ended for them.</p></section></div></body>"
    assert html_text.main_text(split) == f"{WANT} {WANT} And so it ended for them."


def test_menus_inside_the_article_go():
    related = '<ul><li><a href="/1">Another story of the day</a><li><a href="/2">And one more</a><li><a href="/3">And a third</a></ul>'
    assert html_text.main_text(f"<article>{BODY}{related}</article>") == WANT
    linked = '<p>See <a href="/x">the report</a> and <a href="/y">its annex</a>, published by the council in the spring of last year.</p>'
    text = "See the report and its annex, published by the council in the spring of last year."
    assert html_text.main_text(f"<article>{BODY}{linked}</article>") == f"{WANT} {text}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("plain text, no markup", "plain text, no markup"),
        ("<p>a<b>b</b>c</p><p>d", "abc d"),
        ("<p><b>One.<br><p>Two.</p></body>", "One. Two."),
        ("<article>x &lt;b&gt; &#233;&eacute; &am &amp &copy;&nbsp;y</article>", "x <b> éé &am & © y"),
        ("<article>" + "<div>" * 1000 + "deep" + "</div>" * 1000 + "<p>after</p></article>", "deep after"),
        ("<article><p>a < b and 3 > 2</p></div></section></article>", "a < b and 3 > 2"),
        ("<article><p title='it>s'>in</p><p class=\"x>out</p>", "in out"),
        ("<head><title>t</title><p>body begins</p>", "body begins"),
        ("<article><p>\t many \n\n blanks   </p></article>", "many blanks"),
        ("<nav><a href=x>only</a></nav>", ""),
        ("<article><script>if (a < b) '</p>'", ""),
    ],
)
def test_awkward_pages(page, text):
    assert html_text.main_text(page) == text


def test_long_page_in_linear_time():
    page = "<article>" + "".join(f"<p>Paragraph {i}, of many.</p>" for i in range(60_000)) + "</article>"
    assert html_text.main_text(page).count("of many.") == 60_000
    broken = "<article>" + "<p class=\"x>a</p>" * 30_000 + "</article>"
    assert html_text.main_text(broken)


def test_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, `_row` string"
    rows = [(1, "u", f"<article>{BODY}</article>", "x", 1, "r"), (1, "u", f"<article>{BODY}</article>", "x", 1, "r")]
    rows += [(None, None, None, None, None, None), (2, None, "<p>é𝄞</p>", "x", 1, "r")]
    got = html_text.extract(spark.createDataFrame(rows, schema).repartition(2))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(1, "u", WANT, len(WANT))] * 2 + [(None, None, "", 0), (2, None, "é𝄞", 2)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []


def test_given_pages(spark):
    """Each page is marked with an article element, which a plain cut finds."""

    def cut(page):
        inside = re.sub(r"</?(?:b|i|em|a|span)\b[^>]*>", "", re.search("<article>(.*?)</article>", page, re.S)[1])
        blocks = (" ".join(html.unescape(b).split()) for b in re.split("<[^>]*>", inside))
        return " ".join(b for b in blocks if b)

    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = registered.op11_html_extraction(spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, cut(pages[r.page_id].html), len(r.text))
