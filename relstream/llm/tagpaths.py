"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relstream.llm.common import map_rows

# Elements by their role in HTML.
_BLOCKS = set("""
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav noframes ol optgroup option p pre section
    summary table tbody td tfoot th thead title tr ul""".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup: it ends at their end tag, or where the page ends.
_RAW = set("script style textarea title iframe noscript noembed noframes xmp template svg math object select canvas".split())
#: Never main text, wherever they stand.
_NOT_TEXT = set("head nav footer aside form menu dialog button label fieldset legend".split())
_STARTS = _BLOCKS | _NOT_TEXT
_STOPS = _BLOCKS | {"button", "label", "legend"}
#: A start tag that ends an open element of these, up to the container.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
#: Elements that do not end an open paragraph: it can hold them.
_IN_PARAGRAPH = {"option", "optgroup"}
# Words in class, id and role that name what surrounds an article.
_AROUND = set("""
    ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo outbrain taboola navbar topbar toolbar
    breadcrumb breadcrumbs pagination masthead copyright cookie cookies consent gdpr popup newsletter disqus commentlist
    contentinfo""".split())
#: The same as whole names only; as a part of one they also name layouts and wrappers around the article.
_AROUND_WHOLE = set("""
    paywall login signup adv promotion promoted nav navigation menu pager header footer legal sidebar aside widget widgets rail related recommended
    recommendations trending popular more-stories notice notices alert modal overlay dialog subscribe subscription search share
    sharing social follow tags comment comments respond reply replies discussion skip hidden print-only complementary form""".split())
#: Of these, words that as a part of a name say how an element looks or is laid out: they only lower a path's ratio.
_LAYOUT = set("header hidden legal form skip alert modal overlay dialog adv login print-only complementary".split())
#: Words for what readers write. Comments can be longer than the article: they hold a page's text only if hardly any is elsewhere.
_READERS = set("comment comments respond reply replies discussion".split())
#: Shares of a page's text that keep elements with an ambiguous name: of any word, and of a word for readers' text.
_MOST, _NEARLY_ALL = 0.5, 0.9
#: What a path's ratio is multiplied with if an element on it has an ambiguous name and stays.
_DOUBTED = 0.3
#: Inside an article, the ends of paths whose blocks are short by nature.
_SHORT = set("h1 h2 h3 h4 h5 h6 hgroup li dt dd td th tr caption figcaption summary p pre blockquote".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)/?>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_NAMES = re.compile(r"[a-z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?¿¡…。，、；：！？]")


class Block(NamedTuple):
    path: int
    text: str
    linked: int


class Paths:
    """A page's root-to-leaf paths as a tree: 0 is the root, and a path's number is greater than that of the path above."""

    def __init__(self) -> None:
        self.parents, self.tags, self.depths = [0], [""], [0]
        self.articles = [0]  # the deepest path to an article or main element on the way, or 0
        self._known: dict[tuple[int, str], int] = {}

    def below(self, path: int, tag: str) -> int:
        found = self._known.setdefault((path, tag), len(self.tags))
        if found == len(self.tags):
            self.parents.append(path)
            self.tags.append(tag)
            self.depths.append(self.depths[path] + 1)
            self.articles.append(found if tag in ("article", "main") else self.articles[path])
        return found

    def sums(self, own: dict[int, float]) -> list[float]:
        """Each path's sum over itself and all paths below it."""
        total = [own.get(path, 0.0) for path in range(len(self.tags))]
        for path in range(len(total) - 1, 0, -1):
            total[self.parents[path]] += total[path]
        return total


class Mark(NamedTuple):
    """An element named as surrounding: the mark it stands in, the word that names it, how (surely, named or partly), and the
    words of the marks around it."""
    above: int
    word: str
    how: str
    around: frozenset[str]


class Open(NamedTuple):
    """An open element: whether its text counts, whether it is doubted, its mark, and the mark its innermost article stands in (-1: none)."""
    tag: str
    path: int
    counts: bool
    doubted: bool
    mark: int
    article_in: int


_PAGE = Open("", 0, True, False, 0, -1)


def _is_around(tag: str, attributes: str, in_article: bool) -> tuple[str, str]:
    """Whether an element stands around the article, and the word that says so: "never" text by its name or state, "surely" or "named"
    so by its class, id or role, "partly" if an ambiguous word is a part of a name, "doubted" if one for layouts is, or ""."""
    if tag in _NOT_TEXT or tag == "header" and not in_article:
        return "never", tag
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return "", ""
    bare = _ATTRIBUTE.sub(" ", attributes).lower().split()
    if "hidden" in bare:
        return "never", "hidden"
    said: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role") and tag not in ("html", "body", "article", "main"):
            for token in value.split():
                parts = _NAMES.findall(token)
                if token in _AROUND:
                    said["surely"] = token
                elif token in _AROUND_WHOLE:
                    said["named"] = token
                for part in parts:
                    if part in _AROUND:
                        said.setdefault("named", part)
                    elif part in _AROUND_WHOLE and part != "header":
                        said.setdefault("doubted" if part in _LAYOUT else "partly", part)
        elif name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return "never", name
    return next(((how, said[how]) for how in ("surely", "named", "partly", "doubted") if how in said), ("", ""))


def _closes_itself(tag: str, attributes: str) -> bool:
    """Whether a start tag's last slash ends its element; after an unquoted value the slash belongs to the value."""
    return attributes.endswith("/") and (tag in ("svg", "math") or re.search(r"=\s*[^\s\"'>]+/$", attributes) is None)


def blocks(page: str, paths: Paths) -> Iterator[Block]:
    """Text blocks with their path of block elements in `paths`, without what is never main text.

    An element that its class, id or role names as surrounding stays, doubted, if it holds the only article or main
    elements or, unless the name is not ambiguous (a whole word like ad), most of the page's text. Where the word is a part
    of a name, all elements with this word are taken together: they may be a layout that the text is cut into.
    """
    marks = [Mark(0, "", "", frozenset())]
    found = list(_marked(page, paths, marks))
    sizes, articles = [0] * len(marks), [0] * len(marks)
    total = total_articles = 0
    for block, innermost in found:
        size = max(0, len(block.text) - block.linked)
        total += size
        sizes[innermost.mark] += size
        if innermost.article_in >= 0:
            total_articles += size
            articles[innermost.article_in] += size
    for k in range(len(marks) - 1, 0, -1):
        sizes[marks[k].above] += sizes[k]
        articles[marks[k].above] += articles[k]
    by_word: dict[str, int] = {}
    for mark, size in zip(marks, sizes):
        if mark.word not in mark.around:
            by_word[mark.word] = by_word.get(mark.word, 0) + size
    stays = [True]
    for k, mark in enumerate(marks[1:], 1):
        least = total * (_NEARLY_ALL if mark.word in _READERS else _MOST)
        holds_text = mark.how != "surely" and (by_word[mark.word] if mark.how == "partly" else sizes[k]) > least
        stays.append(stays[mark.above] and (holds_text or 0 < articles[k] == total_articles))
    for block, innermost in found:
        if stays[innermost.mark]:
            yield block._replace(path=paths.below(block.path, "doubted")) if innermost.mark or innermost.doubted else block


def _marked(page: str, paths: Paths, marks: list[Mark]) -> Iterator[tuple[Block, Open]]:
    """Text blocks, each with the innermost element it stands in; elements named as surrounding are added to `marks`.

    Markup may be broken: elements that HTML ends by itself are ended, unmatched end tags are skipped, and a page may stop
    anywhere. Inline elements and line breaks are part of their block. Work grows with the page, however deep it is:
    what is open is also known by its name.
    """
    open_: list[Open] = []
    places: dict[str, list[int]] = {}  # where elements of a name are open
    endless: set[str] = set()  # names without another end tag
    pieces: list[str] = []
    linked = links = 0
    at = 0

    def flush() -> Iterator[tuple[Block, Open]]:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                innermost = open_[-1] if open_ else _PAGE
                yield Block(innermost.path, text, min(linked, len(text))), innermost
        pieces.clear()
        linked = 0

    def deepest(names: set[str]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=-1)

    def close(names: set[str], within: set[str]) -> None:
        depth = deepest(names)
        if depth > deepest(within):
            while len(open_) > depth:
                places[open_.pop().tag].pop()

    def text_of(piece: str) -> None:
        nonlocal linked
        if piece and (not open_ or open_[-1].counts):
            pieces.append(piece)
            linked += len(piece) if links else 0

    def end_of(tag: str) -> int | None:
        """Where the next end tag of this name ends."""
        stop = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
        if not stop:
            endless.add(tag)
        return stop.end() if stop else None

    while found := _TAG.search(page, at):
        text_of(page[at:found.start()])
        at = found.end()
        ends, tag, attributes = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if tag in _RAW and not ends and _closes_itself(tag, attributes):
            continue
        if tag in _RAW and not ends:
            at = end_of(tag) or len(page)
        elif tag == "a":
            links = 0 if ends else 1
        elif tag == "br":
            text_of("\n")
        elif ends and tag in _STOPS:
            yield from flush()
            close({tag}, set())
            links = 0
        elif not ends and tag in _STARTS:
            yield from flush()
            if tag not in _IN_PARAGRAPH and tag not in ("button", "label", "legend"):
                close({"p"}, {"td", "th", "button", "caption"})
            if tag in _ENDS:
                close(*_ENDS[tag])
            if tag not in _VOID:
                above = open_[-1] if open_ else _PAGE
                how, word = _is_around(tag, attributes, above.article_in >= 0)
                mark = above.mark
                if how in ("surely", "named", "partly"):
                    outer = marks[mark]
                    marks.append(Mark(mark, word, how, outer.around | {outer.word}))
                    mark = len(marks) - 1
                places.setdefault(tag, []).append(len(open_))
                open_.append(Open(tag, paths.below(above.path, tag), above.counts and how != "never", above.doubted or how == "doubted", mark,
                                  mark if tag in ("article", "main") else above.article_in))
        elif not ends and tag not in _VOID and attributes and _is_around(tag, attributes, True)[0] in ("never", "surely", "named"):
            at = end_of(tag) or at  # an inline element that is not main text
    text_of(page[at:])
    yield from flush()


def select(found: list[Block], paths: Paths, share: float = 0.1) -> list[str]:
    """The main text's blocks, in page order.

    1. Per path: text length, punctuation and nodes of all its blocks, less the text of links. Text per node times one
       plus the logarithm of punctuation per node is the path's ratio.
    2. Smoothing: a path's ratio is averaged with those of all paths, each by its length and by the square of the share of
       this path's steps that they have in common. Headings so gain from the paragraphs beside them. A square is the
       sum of the odd numbers up to it, so each path adds up what lies below its steps: one walk up the tree, one down.
    3. Fusing: the smoothed ratio and the path's own are multiplied and rooted; a path of links alone has none.
    4. Paths reach the text if they have `share` of the best fused ratio. If article or main elements hold the best path and
       half of the text that does, the paths outside of them do not count, and blocks inside that are short by nature
       (headings, list items, cells) stay unless they are links; plain boxes inside need the ratio. Otherwise ratios alone decide.
    """
    if not found:
        return []
    rows: dict[int, list[int]] = {}
    for block in found:
        row = rows.setdefault(block.path, [0, 0, 0, 0])
        row[0] += len(block.text)
        row[1] += len(_PUNCTUATION.findall(block.text))
        row[2] += 1
        row[3] += block.linked
    own = {path: max(0.0, n - 2 * linked) / nodes * (1 + math.log1p(marks / nodes)) for path, (n, marks, nodes, linked) in rows.items()}
    weighed = paths.sums({path: row[0] * own[path] for path, row in rows.items()})
    lengths = paths.sums({path: row[0] for path, row in rows.items()})
    for path in range(1, len(weighed)):
        odd, above = 2 * paths.depths[path] - 1, paths.parents[path]
        weighed[path] = odd * weighed[path] + (weighed[above] if above else 0)
        lengths[path] = odd * lengths[path] + (lengths[above] if above else 0)
    fused = {path: math.sqrt(weighed[path] / lengths[path] * own[path]) * (_DOUBTED if paths.tags[path] == "doubted" else 1) for path in rows}
    best = max(fused.values())
    kept = {path for path, ratio in fused.items() if ratio and ratio >= share * best}
    inside = {path for path in kept if paths.articles[path]}
    held = sum(rows[path][0] for path in inside)
    if 2 * held < sum(rows[path][0] for path in kept) or not any(fused[path] == best for path in inside):
        inside = set()  # teasers or comments beside the text
    roots = {paths.articles[path] for path in inside}
    if roots:
        within = [False]
        for path in range(1, len(paths.tags)):
            within.append(within[paths.parents[path]] or path in roots)
        end = {path: paths.tags[paths.parents[path] if paths.tags[path] == "doubted" else path] for path in rows}
        kept = {path for path, (n, _, _, linked) in rows.items()
                if within[path] and 2 * linked <= n and (path in kept or end[path] in _SHORT)}
    return [block.text for block in found if block.path in kept]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    paths = Paths()
    return "\n\n".join(select(list(blocks(page, paths)), paths))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """`pages` with `text`, the page's main text, and `n_chars`, its code points; columns of these names are replaced.

    Blocks are joined by an empty line; white space inside a block is one blank. Null, empty and text-free pages give an
    empty text. Pages are read one by one and whole, at any length; equal pages give equal texts; an empty table gives an
    empty one.
    """
    carried = [f for f in pages.schema if f.name.lower() not in ("text", "n_chars") and f.name != html]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), "text string, n_chars bigint"])

    def each(_):
        def apply(*columns):
            texts = [main_text(page) for page in columns[-1]]
            return *columns[:-1], texts, [len(text) for text in texts]
        return apply

    return map_rows(pages.select(*(F.col(f"`{f.name}`") for f in carried), F.col(f"`{html}`")), each, schema)
