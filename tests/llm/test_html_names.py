"""Pages that lost their articles to unclosed elements, to parts of attributes and to class names."""

from __future__ import annotations

import pytest

from docspark.llm import htmltext

TEXT = "Some words of an article that goes on for quite a while. " * 6
TEXT = TEXT.strip()


@pytest.mark.parametrize("page", [
    "<div><button>Go</div><article><p>{}</p></article>", "<svg viewBox='0 0 1 1'/><article><p>{}</p></article>",
    "<button>A<article><p>{}</p></article><button>B</button>",
    "<body class='overflow-x-hidden'><div><p>{}</p></div>", "<body><div style='overflow:hidden'><p>{}</p></div>",
    "<div aria-hidden='false'><p>{}</p></div>", "<article class='post tag-a tag-b tag-c'><p>{}</p></article>",
    "<body class='no-sidebar'><div><p>{}</p></div>"])
def test_articles_stay(page):
    assert TEXT in htmltext.main_text(page.format(TEXT))


@pytest.mark.parametrize("page", [
    "<div hidden><p>{}</p></div>", "<div class='hidden'><p>{}</p></div>", "<div style='display: none'><p>{}</p></div>",
    "<div class='cookie-banner'><p>{}</p></div>", "<svg><text>{}</text></svg>", "<noscript><p>{}</p></noscript>",
    "<script>{}", "<div class='site-footer'><p>{}</p></div>"])
def test_boilerplate_goes(page):
    assert htmltext.main_text(page.format(TEXT)) == ""
