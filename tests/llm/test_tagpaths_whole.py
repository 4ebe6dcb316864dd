"""Main text where names of elements mislead, and of pages without end tags."""

import time

import pytest

from relstream.llm.tagpaths import main_text

PARAGRAPH = "A paragraph of some length, with commas, and a full stop. It goes on, and on."
STORY = "".join(f"<p>{k}. {PARAGRAPH} {PARAGRAPH}</p>" for k in range(6))


def test_teasers_in_article_elements_do_not_hide_the_story():
    teasers = "".join(f"<article><p>Teaser {k}, in short, here.</p></article>" for k in range(3))
    text = main_text(f"<body><div><div>{STORY}</div></div>{teasers}</body>")
    assert all(f"{k}. {PARAGRAPH}" in text for k in range(6))


def test_wrappers_with_ambiguous_names_keep_the_text():
    for name in ("no-sidebar", "has-sidebar", "elementor-widget-container", "post-header", "legal-article", "comments"):
        text = main_text(f"<body><div class='{name}'><h2>Head</h2>{STORY}</div><div class='sidebar'>Side, side.</div></body>")
        assert all(f"{k}. {PARAGRAPH}" in text for k in range(6)) and "Side" not in text, name
    assert PARAGRAPH in main_text(f"<body><div class='widget'><article><p>{PARAGRAPH}</p></article></div><div>{STORY[:40]}</div></body>")


def test_raw_elements_that_close_themselves_are_empty():
    for raw in ("<svg a='b'/>", "<svg a=b/>", "<math/>", "<object data='x' />", "<iframe src='x'/>"):
        assert main_text(f"<article><p>One.</p>{raw}<p>{PARAGRAPH}</p></article>") == f"One.\n\n{PARAGRAPH}", raw
    assert main_text("<article><p>One.</p><object data=a/>no</object></article>") == "One."


@pytest.mark.parametrize("name", ["comment-list", "post-comments", "share-bar", "related-posts", "cookie-notice-bar", "site-notice"])
def test_named_parts_inside_an_article_go(name):
    other = "<p>Something else, said by others, at some length, in this place.</p>" * 3
    for wrap in ("article", "div"):
        text = main_text(f"<body><{wrap}><h1>Head</h1>{STORY}<div class='{name}'>{other}</div></{wrap}></body>")
        assert "said by others" not in text and all(f"{k}. {PARAGRAPH}" in text for k in range(6)), (name, wrap)


def test_comments_longer_than_the_article_go():
    comments = "".join(f"<div class='comment-body'><p>Reader {k}: {PARAGRAPH} {PARAGRAPH}</p></div>" for k in range(30))
    text = main_text(f"<body><div><h1>Head</h1>{STORY}</div><div class='post-comments'>{comments}</div></body>")
    assert "Reader" not in text and text.count("\n\n") >= 5


def test_a_layout_of_many_named_parts_keeps_the_text():
    parts = "".join(f"<div class='elementor-widget'><div class='elementor-widget-container'><p>{k}. {PARAGRAPH}</p></div></div>" for k in range(6))
    text = main_text(f"<body><div>{parts}</div><footer>f</footer></body>")
    assert text == "\n\n".join(f"{k}. {PARAGRAPH}" for k in range(6))


def test_small_boxes_inside_an_article_need_the_ratio():
    text = main_text(f"<article><h1>T</h1>{STORY}<div><div>12</div></div><ul><li>An item</ul></article>")
    assert "12" not in text.split("\n\n") and "An item" in text and text.startswith("T\n\n0. ")


@pytest.mark.parametrize("unit", ["<div>", "<div><p>so, so.", "<div class='comments'>so.", "<span hidden>x", "</div>x<section>", "<td>x</p>", "<ul><li>y"])
def test_tags_that_are_never_closed_cost_by_their_number(unit):
    begin = time.perf_counter()
    main_text(unit * 100_000)
    assert time.perf_counter() - begin < 10
