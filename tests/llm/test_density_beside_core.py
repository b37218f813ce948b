import pytest

from tagwise.llm import density
from tests.llm.test_density import page

LONG = [("Sentence number %d of a long paragraph. " % i * 8).strip() for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in LONG)
LINKS = "<div><a href='/1'>Another page</a> <a href='/2'>And one more page</a></div>"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f"<div class=post><h1>Title of 25 characters ok</h1><div class=content>{BODY}</div></div>", ["Title of 25 characters ok", *LONG]),
        (f"<article><header><h1>Title</h1></header><div>{BODY}</div></article>", ["Title", *LONG]),
        (
            f"<main><h1>Title</h1><p>Stand-first.</p><div>{BODY}</div><ul><li>one</li><li>two</li></ul><p>The end.</p></main>",
            ["Title", "Stand-first.", *LONG, "one", "two", "The end."],
        ),
        (f"<article>Loose lead.<section><div>{BODY}</div><p>Short.</p></section></article>", ["Loose lead.", *LONG, "Short."]),
        (f"<div><h1>Title</h1><div>{BODY}</div></div>", ["Title", *LONG]),
    ],
)
def test_short_blocks_beside_the_content_stay(html, want):
    assert density.main_text(page(html)) == "\n\n".join(want)


def test_lists_of_links_and_blocks_outside_the_article_go():
    html = f"<div><h1>Site</h1><div>Short line.</div><article><h1>Title</h1><div>{BODY}</div>{LINKS}</article><p>Away.</p></div>"
    assert density.main_text(page(html)) == "\n\n".join(["Title", *LONG])
