"""Main text of HTML pages by the distribution of text over line blocks.

1. Markup is stripped into lines: every block element starts a line. A line counts the visible characters that
   speak for an article; what stands in menus, forms, scripts, adverts, comment sections and the like (by element,
   role, or a word of its class or id) and text that is mostly links leave a line of length 0. The borders
   of an article element are a run of empty lines.
2. A sliding window sums the lengths of ``WINDOW`` lines. A surge point is a line with text whose window reaches
   ``SURGE`` characters (or the page's highest sum, if that is less); from there a text runs on to the dive point,
   where the window sums to 0. Lines with text just before a surge that the empty lines do not cut off belong to it.
3. Text between surge and dive points is kept. If a page has articles, only runs inside those count.

Kept lines are the article's blocks: character references decoded, white space turned into one space, trimmed,
joined by a line feed; nothing else is dropped.

Cases: a null or empty page, and one without text, gives an empty text; unclosed and misnested elements, cut-off
pages, comments and raw texts that hold tags are read as browsers do in these cases; bytes that are not valid
UTF-8 become U+FFFD; repeated rows give repeated results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import importable_on_workers, sliced, utf8

WINDOW, SURGE = 3, 80
LINKS = 0.5  # a line with a larger part of its characters in links is a menu

# Elements of HTML by what they mean here, and words of class, id and role that mark page furniture.
RAW_TEXT = frozenset("script style noscript iframe noembed noframes template textarea title xmp object svg math".split())
FURNITURE = frozenset("""nav footer aside form button select option input label fieldset menu dialog head 
    audio video canvas map applet""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rp rt rtc s
    samp small span strike strong sub sup time tt u var wbr nobr blink marquee""".split())
ARTICLE = frozenset("article main".split())
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising advertorial adsense adslot adbox adunit banner banners
    sponsor sponsored sponsors promo promos promotion promoted teaser teasers outbrain taboola
    nav navbar navigation navi menu menus submenu megamenu breadcrumb breadcrumbs pagination pager paging toc tabs
    header masthead topbar footer foot bottom copyright colophon imprint
    sidebar sidebars side aside rail widget widgets related recommended recommendations trending popular
    notice notices cookie cookies consent gdpr privacy banner alert alerts disclaimer popup modal overlay lightbox
    newsletter subscribe subscription signup signin login register paywall
    comment comments commentlist comentario comentarios kommentar kommentare commentaires respond reply replies disqus discussion
    share sharing social socials follow tags tagcloud
    search searchbox form skip hidden noprint""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# These may also name a part of an article, in a class with one of ARTICLE_WORDS; a class that starts with one of
# ABOUT speaks of a layout, not of what the element holds.
WEAK = frozenset("header form tags story top".split())
ARTICLE_WORDS = frozenset("article post entry story content".split())
ABOUT = frozenset("has with no without is".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_BARE = re.compile(r"(?:^|\s)hidden(?:\s|$|/)", re.I)
_MARK = re.compile(r"[a-zA-Z]+?(?=[A-Z][a-z])|[a-zA-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hr main menu nav ol p pre section table ul""".split())
_OWN_KIND = {"li": {"ul", "ol", "menu"}, "option": {"select"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
             "dt": {"dl"}, "dd": {"dl"}}


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    named = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    if _UNSEEN.search(named.get("style", "")) or named.get("aria-hidden") == "true" or _BARE.search(_ATTRIBUTE.sub(" ", attributes)):
        return True
    if named.get("role", "").lower() in ROLES:
        return True
    if tag in ("body", "html") or tag in ARTICLE and not in_article:
        return False  # the whole page, or the article, whatever it is called
    if len(tag) == 2 and tag.startswith("h"):
        return False
    for name in f"{named.get('class', '')} {named.get('id', '')}".split():
        words = {m.lower() for m in _MARK.findall(name)}
        marks = MARKS & words
        if marks and not (marks <= WEAK and words & ARTICLE_WORDS) and _MARK.findall(name)[0].lower() not in ABOUT:
            return True
    return False



class _Lines:
    """Lines of a page: text parts, characters, characters in links, and the article they are in (0: none)."""

    def __init__(self):
        self.texts: list[str] = []
        self.lengths: list[int] = []
        self.articles: list[int] = []
        self.parts: list[str] = []
        self.linked = 0

    def add(self, raw: str, in_link: bool) -> None:
        self.parts.append(raw)
        if in_link:
            self.linked += len("".join(raw.split()))

    def end(self, article: int, furniture: bool) -> None:
        """The line ends here; a line without text is one only if it held furniture."""
        text = " ".join(html.unescape("".join(self.parts)).split())
        size = len(text) - text.count(" ")
        if text and not furniture:
            self._line(text, 0 if self.linked > LINKS * max(size, 1) else size, article)
        elif text:
            self._line("", 0, article)
        self.parts, self.linked = [], 0

    def _line(self, text: str, size: int, article: int) -> None:
        self.texts.append(text)
        self.lengths.append(size)
        self.articles.append(article)

    def gap(self, article: int) -> None:
        for _ in range(WINDOW):
            self._line("", 0, article)


def strip_markup(page: str) -> _Lines:
    """The lines of a page."""
    out, stack = _Lines(), []  # open elements: (tag, furniture, article number, link)
    at, articles = 0, 0

    def state() -> tuple[bool, int, bool]:
        return stack[-1][1:] if stack else (False, 0, False)

    def close(upto: int) -> None:
        """End the line, then the elements from ``upto`` on."""
        furniture, article, _ = state()
        out.end(article, furniture)
        left = stack[upto:]
        del stack[upto:]
        if any(tag in ARTICLE and number and number != state()[1] for tag, _, number, _ in left):
            out.gap(state()[1])

    while at < len(page):
        start = page.find("<", at)
        tag = _TAG.match(page, start) if start >= 0 else None
        if start < 0 or tag is None:  # text to the end, or a bare <
            stop = len(page) if start < 0 else start + 1
            out.add(page[at:stop], state()[2])
            at = stop
            continue
        if start > at:
            out.add(page[at:start], state()[2])
        at = tag.end()
        if tag.group(2) is None:  # comment, doctype
            continue
        name, closing, attributes = tag.group(2).lower(), bool(tag.group(1)), tag.group(3)
        if name in INLINE:
            if name == "br":
                out.add(" ", False)
            elif name == "a":  # links do not nest
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "a"), None)
                if depth is not None:
                    del stack[depth]
                if not closing:
                    furniture, article, _ = state()
                    stack.append(("a", furniture, article, True))
            elif not closing and attributes and not state()[0] and not attributes.endswith("/") and _is_furniture(name, attributes, True):
                end = re.compile(rf"</{name}\s*>|</?(?:p|div|article|section|li|td)\b", re.I).search(page, at)
                at = end.start() if end else len(page)
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            close(len(stack) if depth is None else depth)
            continue
        if name in RAW_TEXT:
            out.end(state()[1], state()[0])
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            if not attributes.endswith("/"):
                at = end.end() if end else len(page)
            continue
        upto = len(stack)
        if name in _CLOSES_P and any(t == "p" for t, *_ in stack):
            upto = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p")
        elif name in _OWN_KIND:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _OWN_KIND[name]:
                    break
                if stack[i][0] == name:
                    upto = i
                    break
        if name == "body" and stack and any(t == "head" for t, *_ in stack):
            upto = next(i for i, (t, *_) in enumerate(stack) if t == "head")
        close(upto)
        if name in VOID:
            continue
        furniture, article, _ = state()
        if not furniture and _is_furniture(name, attributes, article > 0):
            furniture = True
        if name in ARTICLE and not furniture and not article:
            out.gap(0)
            articles += 1
            article = articles
        if not attributes.endswith("/"):
            stack.append((name, furniture, article, False))
    close(0)
    return out


def text_runs(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """(first line, line after the last) of the runs of text between surge and dive points."""
    n = len(lengths)
    sums = [sum(lengths[i:i + window]) for i in range(n)]
    bar = min(surge, max(sums, default=0))
    runs, i = [], 0
    while i < n:
        if not (lengths[i] and sums[i] >= bar and bar):
            i += 1
            continue
        stop = i
        while stop < n and sums[stop]:
            stop += 1
        first = i
        floor = runs[-1][1] if runs else 0
        while first > floor and any(lengths[max(floor, first - window + 1):first]):  # short lines that lead up to the surge
            first -= 1
        runs.append((first, stop))
        i = stop
    return runs


def main_text(page: str | None) -> str:
    """The text of the article on a page."""
    if not page:
        return ""
    lines = strip_markup(page)
    vouched = [size if article else 0 for size, article in zip(lines.lengths, lines.articles)]
    runs = text_runs(vouched, surge=1) if any(vouched) else text_runs(lines.lengths)
    return "\n".join(lines.texts[i] for a, b in runs for i in range(a, b) if lines.texts[i])



def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page. Narrow: one pass, no shuffle."""
    importable_on_workers(pages.sparkSession)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [main_text((data or b"").decode(errors="replace")) for data in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                          F.col(f"`{html_col}`").cast("string").alias("_html"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return source.mapInArrow(extracted, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
