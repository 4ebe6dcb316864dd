"""Main text of pages: broken markup, surroundings, references, odd input."""

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from relstream.llm.tagpaths import Paths, blocks, extract, main_text

PARAGRAPH = "A paragraph of some length, with commas, and a full stop. It goes on, and on."


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href=x>Home, sweet home</a></ul></nav>", "<header><h1>Site name</h1></header>", "<footer>&copy; me, 2024</footer>",
    "<aside>An aside, which is long, longer, longest.</aside>", '<div class="sidebar left"><p>Side, side.</p></div>',
    '<div id="cookie-notice"><p>We use cookies, as all do.</p></div>', '<section class="comments"><p>First! So, so good.</p></section>',
    '<div class="ad">Buy, buy, buy.</div>', "<form><label>Name</label><input><textarea>x, y</textarea></form>",
    "<script>if (a < b) { document.write('<p>no</p>'); }</script>", "<style>p > a { color: red }</style>", "<!-- <p>gone, too.</p> -->",
    '<div hidden>Unseen, unsaid.</div>', '<p style="display: none">Unseen, unsaid.</p>', "<noscript>Turn it on, please.</noscript>",
])
@pytest.mark.parametrize("inside", [True, False])
def test_surroundings_are_left_out(around, inside):
    body = f"<h1>Title</h1><p>{PARAGRAPH}</p>{around if inside else ''}<p>{PARAGRAPH}</p>"
    if inside and around.startswith("<header"):
        body = body.replace(around, "")  # an article's own header may hold its title
    page = f"<html><body>{'' if inside else around}<article>{body}</article></body></html>"
    assert main_text(page) == f"Title\n\n{PARAGRAPH}\n\n{PARAGRAPH}"


def test_without_an_article_element_ratios_decide():
    links = "".join(f"<li><a href={k}>link {k}</a>" for k in range(12))
    page = f"<body><div class=top><ul>{links}</ul></div><div><div><p>{PARAGRAPH}<p>{PARAGRAPH} More of it.</div></div><div><span>x</span></div>"
    assert main_text(page) == f"{PARAGRAPH}\n\n{PARAGRAPH} More of it."


def test_references_white_space_and_breaks():
    page = "<article><p>Fish &amp; chips,&nbsp;&eacute;t&#233;\n\n  &lt;b&gt; a<br>b  <i>c</i>d&#x41;</article>"
    assert main_text(page) == "Fish & chips, été <b> a b cdA"


def test_markup_may_stop_anywhere():
    page = f"<html><body><article><h1>T</h1><p><b>{PARAGRAPH}<br><p>{PARAGRAPH}</p></article><footer>f</footer></body></html>"
    for cut in range(len(page)):
        main_text(page[:cut])
    assert main_text(page) == f"T\n\n{PARAGRAPH}\n\n{PARAGRAPH}"


@pytest.mark.parametrize("page", [None, "", "<html></html>", "<script>x", "<!-- never ends", "<nav>a</nav>"])
def test_pages_without_text(page):
    assert main_text(page) == ""


def test_plain_text_is_its_own_main_text():
    assert main_text("just a < b text") == "just a < b text"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='x'>", "</div>", "<article>", "</article>", "<li>", "text, so. ", "<a href=1>", "</a>",
                                 "<nav>", "</nav>", "&amp;", "<", ">", "<b", "'", '"', "<script>", "</script>", "<td>", "<!--", "-->"])))
def test_any_markup_is_survived(parts):
    text = main_text("".join(parts))
    assert text == text.strip() and "\n\n\n" not in text


def test_a_very_long_page():
    page = "<article>" + f"<p>{PARAGRAPH}" * 20_000
    assert main_text(page).count("\n\n") == 19_999
    assert len(list(blocks("<div>" * 3_000 + "x", Paths()))) == 1


def test_table_with_clashing_columns_and_repeats(spark, sf):
    rows = [(1, "u", f"<p>{PARAGRAPH}", "old"), (1, "u", f"<p>{PARAGRAPH}", "old"), (None, None, None, None)]
    df = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"))
    assert sorted(map(tuple, df.select("page_id", "text", "n_chars").collect()), key=repr) == [
        (1, PARAGRAPH, len(PARAGRAPH)), (1, PARAGRAPH, len(PARAGRAPH)), (None, "", 0)]
    assert extract(spark.createDataFrame([], "page_id bigint, html string")).collect() == []


def test_the_test_pages_against_their_pattern(spark, sf):
    """In these pages the article is what stands between its tags."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for row in extract(pages.withColumn("raw", pages["html"])).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", row["raw"], re.S).group(1)
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " " if "br" in p else "", p))).strip()
                 for p in re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))]
        assert row["text"] == "\n\n".join(p for p in parts if p)
