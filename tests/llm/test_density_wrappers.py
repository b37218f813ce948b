import pytest

from tagwise.llm import density
from tests.llm.test_density import ARTICLE, WANT, page

PARAGRAPHS = [f"Paragraph {i} of the article says something, at some length, about number {i}." for i in range(8)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
COMMENTS = "<div id='comments'><p>" + "A reader says a lot about this. " * 60 + "</p></div>"


@pytest.mark.parametrize("attribute", ['style="overflow: hidden"', 'title="the hidden valley"', 'data-aria-hidden="true"', "data-id='sidebar'", 'data-role="menu"'])
def test_other_attributes_hide_nothing(attribute):
    assert density.main_text(page(f"<div {attribute}>{ARTICLE}</div>")) == WANT


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", 'title="x" hidden', "aria-hidden=true", 'class="x" role="menu"', "id='sidebar'"])
def test_hidden_elements_are_dropped(attribute):
    assert density.main_text(page(f"<article>{ARTICLE}</article>", f"<div {attribute}><p>Not to be seen by anyone.</p></div>")) == WANT


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "container has-sidebar", "post comments-closed", "with-nav", "elementor-widget elementor-widget-text"])
def test_layout_wrappers_keep_the_article(name):
    want = "\n\n".join(PARAGRAPHS)
    assert density.main_text(page(f'<div class="{name}"><div>{BODY}</div></div>')) == want
    assert density.main_text(page(f'<div class="{name}"><article><h1>Title</h1>{BODY}</article>{COMMENTS}</div>')) == "Title\n\n" + want


def test_an_article_dealt_over_widgets():
    widgets = "".join(f'<div class="elementor-widget"><p>{p}</p></div>' for p in PARAGRAPHS)
    assert density.main_text(page(f"<div>{widgets}</div>", after=COMMENTS)) == "\n\n".join(PARAGRAPHS)


def test_long_comments_beside_a_short_article():
    area = COMMENTS.replace("id='comments'", "class='comments-area'")
    assert density.main_text(page(f"<article>{BODY}</article>", after=COMMENTS + area)) == "\n\n".join(PARAGRAPHS)
