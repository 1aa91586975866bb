"""Main text where class names mislead."""

import pytest

from claimlens.llm import html_text

LONG = " ".join(f"Sentence number {i} of the main text, long enough to count." for i in range(12))
HINTED = {
    "state of the layout": (f"<div class='layout has-sidebar'><article><h1>A</h1><p>{LONG}</p></article></div>", f"A\n\n{LONG}"),
    "state of the menu": (f"<div class='menu-open'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
    "wrapper": (f"<div class='sidebar'><article><h1>A</h1><p>{LONG}</p></article></div>", f"A\n\n{LONG}"),
    "sections": (
        f"<article><h1>A</h1><p>{LONG}</p><section id='social-history'><p>S {LONG}</p></section>"
        f"<section class='related-work'><p>R {LONG}</p></section><div class='related-posts'><p>No {LONG}</p></div></article>",
        f"A\n\n{LONG}\n\nS {LONG}\n\nR {LONG}",
    ),
    "comment articles": (
        f"<main><article><h1>A</h1><p>{LONG}</p><p>{LONG}</p></article><article class='comment'><p>C {LONG}</p></article></main>",
        f"A\n\n{LONG}\n\n{LONG}",
    ),
    "long advert": (f"<div class='ad'>Buy now, buy now, buy now.</div><article><h1>A title</h1><p>Text.</p></article>", "A title\n\nText."),
}


@pytest.mark.parametrize("name", HINTED)
def test_hints_only_weigh(name):
    body, want = HINTED[name]
    assert html_text.main_text(f"<html><body>{body}</body></html>") == want


CHOSEN = {
    "cards beside the text": (
        f"<div id='story'><div><p>{LONG}</p></div><div><p>{LONG}</p></div>"
        "<article><a href='/x'>card one</a></article><article><a href='/y'>card two</a></article></div>",
        [LONG],
    ),
    "two articles": (
        f"<main><article><h1>One</h1><p>{LONG}</p><p>{LONG}</p></article><article><h1>Two</h1><p>Second {LONG}</p></article></main>",
        ["One", LONG, f"Second {LONG}", "Two"],
    ),
    "loose text": (f"<div>Loose {LONG} <b>bold</b><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></div>", [f"Loose {LONG} bold", LONG]),
    "no articles": (f"<div><ul><li><a href='/'>a</a><li><a href='/'>b</a></ul></div><div><p>{LONG}</p><p>{LONG}</p></div>", [LONG]),
}


@pytest.mark.parametrize("name", CHOSEN)
def test_density_decides(name):
    body, wanted = CHOSEN[name]
    got = html_text.main_text(f"<html><body>{body}</body></html>").split("\n\n")
    assert all(w in got for w in wanted)
