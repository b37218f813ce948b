import html
import re

from tagwise.llm import density
from tagwise.sources.tables import table
from tests.llm import helpers as H

SCHEMA = "page_id long, url string, html string, text string, n_chars string"

ARTICLE = "<h1>Title &amp; more</h1><p>First   para\ngraph with <b>bold</b> and <a href='/x'>a link</a>.<p>Second one, left open &eacute;&#233;.<ul><li>point one<li>point two</ul>"
WANT = "Title & more\n\nFirst para graph with bold and a link.\n\nSecond one, left open éé.\n\npoint one\n\npoint two"


def page(article, before="", after=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><p>no</p>';</script></head><body>"
        f"<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>{before}{article}{after}<footer>&copy; site, all rights reserved</footer></body></html>"
    )


def test_article_without_what_stands_around_it():
    noise = "<div class='ad'>Buy this great thing now.</div><aside><p>Side bar text that is long enough to count here.</p></aside><form><p>Your mail</p><input></form>"
    comments = "<div id='comments'><p>A reader comment that is quite long, with many words in it, and more words.</p><p>Another.</p></div>"
    cookie = "<div class='cookie-notice'><p>We use cookies and other things to make this site better for all.</p></div><!-- <p>hidden</p> -->"
    for wrap in ("<article>{}</article>", "<main><div class='content'>{}</div></main>", "<div><div id='post'>{}</div></div>"):
        assert density.main_text(page(wrap.format(ARTICLE), noise + cookie, comments)) == WANT


def test_odd_markup():
    assert density.main_text(None) == "" == density.main_text("") == density.main_text("<html><body><nav>x</nav></body></html>")
    assert density.main_text("just text &lt;b&gt; no tags") == "just text <b> no tags"
    assert density.main_text("<p title='a > b'>one</p><p>two<br>lines</p></div></p>") == "one\n\ntwo lines"
    assert density.main_text("<article><p>a < b and 3 <4</p><p>c<p>d") == "a < b and 3 <4\n\nc\n\nd"
    assert density.main_text("<article><p>x</p><script>never closed <p>y") == "x"
    assert density.main_text("<div>" * 5000 + "deep text" + "</div>" * 5000) == "deep text"


def test_very_long_page_is_read_whole():
    words = "<p>" + "word " * 200 + "</p>"
    text = density.main_text(page("<article>" + words * 2000 + "</article>"))
    assert text.count("\n\n") == 1999 and len(text) == 2000 * 999 + 1999 * 2
    assert len(density.main_text("<p " + "a='" * 20_000)) >= 0  # unmatched quotes take no quadratic time


def test_edge_cases_on_a_table(spark, scratch):
    rows = [(1, "u", page("<article>" + ARTICLE + "</article>"), "c", "c"), (2, None, None, "", ""), (3, "u", "", "", ""), (None, "v", "<p>x</p>", "", "")]
    rows += [rows[0]]
    got = density.op4_html_extraction(spark, H.sf_dir(spark, scratch, pages=(rows, SCHEMA))).collect()
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in got) == sorted(
        [("1", "u", WANT, len(WANT))] * 2 + [("2", "None", "", 0), ("3", "u", "", 0), ("None", "v", "x", 1)]
    )


def test_empty_table(spark, scratch):
    assert density.op4_html_extraction(spark, H.sf_dir(spark, scratch, pages=([], SCHEMA))).collect() == []


def plain(page):
    """The given pages hold their text in one article element."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    parts = (" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", m[1]))
    return "\n\n".join(x for x in parts if x)


def test_given_pages(spark):
    rows = table(spark, "/root/testdata/sf0.01", "pages").collect()
    got = {r.page_id: r.text for r in density.op4_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    assert all(got[r.page_id] == plain(r.html) for r in rows) and len(got) == len(rows)
