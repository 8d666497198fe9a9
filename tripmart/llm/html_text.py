"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines: one for each block of text, and ``GAP`` empty ones for each element
that is no content (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
comments). If the page marks its article (``article``, ``main``), all lines in it are kept, and no
others.

Otherwise the text lengths of ``GAP`` neighbouring lines are summed, where a line that is mostly
links has none; text surges where the sum reaches ``SURGE`` characters, or half the page's largest
sum if that is less, and dives where it falls to nothing. Kept is every line from the first surge to
the last dive, with links or short ones included, and on both sides what follows up to a line of
links. A page of nothing but links is kept whole.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = 3
SURGE = 80

# Element names of HTML.
DROPPED = set(
    "head title nav header footer aside form button select textarea label iframe object svg math "
    "canvas audio video template noscript noframes dialog menu menuitem datalist map".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Names in class, id and role of what is no part of an article.
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar aside complementary widget widgets footer contentinfo "
    "comment comments commentlist reply replies disqus share sharing social related recommended "
    "newsletter subscribe subscription signup login search popup modal dialog overlay toolbar "
    "pagination pager skip".split()
)
PAGE_TOP = {"header", "masthead", "topbar"}
# Words that beside those make a name of the same thing, such as comment-list.
CONTAINERS = set(
    "list box bar block section area wrap wrapper container inner outer site top bottom primary "
    "secondary global form item items link links button buttons slot unit".split()
)
# Elements that a page's author may put around the article all the same.
AROUND = {"header", "footer", "aside", "nav", "form"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-z][^\s/>]*)(?P<rest2>[^>]*+)>"
    r"|<[!?][^>]*+>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE
)
_PARTS = re.compile(r"[^\W\d_]+")


class Tag(NamedTuple):
    start: int
    end: int
    name: str  # empty for comments, scripts and declarations
    close: bool
    rest: str


class Line(NamedTuple):
    text: str
    linked: int  # characters inside links
    inside: bool  # in the marked article


def _tags(page: str) -> list[Tag]:
    out = []
    for m in _TAG.finditer(page):
        name = m["name"] or m["name2"] or ""
        close = bool(m["close"] or m["close2"])
        out.append(Tag(m.start(), m.end(), name.lower(), close, m["rest"] or m["rest2"] or ""))
    return out


def _names(rest: str) -> set[str]:
    """Tokens of class, id and role."""
    if "=" not in rest:
        return set()
    found = set()
    for m in _ATTRIBUTE.finditer(rest):
        found.update((m[2] or m[3] or m[4] or "").lower().split())
    return found


def _name(names: set[str], words: set[str]) -> bool:
    """Whether a name consists of ``words``: has-sidebar and banner-title name something else."""
    for name in names:
        parts = set(_PARTS.findall(name))
        if parts & words and parts <= words | CONTAINERS:
            return True
    return False


def _ends(tags: list[Tag]) -> list[int | None]:
    """For each opening tag, the tag at which its element ends, in one pass over all tags."""
    ends: list[int | None] = [None] * len(tags)
    opened: dict[str, list[int]] = {}
    for k, tag in enumerate(tags):
        waiting = opened.setdefault(tag.name, [])
        if tag.name in ("p", "li"):  # their end tags may be left out
            if waiting:
                ends[waiting.pop()] = k if tag.close else k - 1
            if not tag.close:
                waiting.append(k)
        elif not tag.close:
            waiting.append(k)
        elif waiting:
            ends[waiting.pop()] = k
    return ends


def lines_of(page: str) -> tuple[list[Line], bool]:
    """Lines of text of a page, and whether it marks its article.

    A dropped article marks nothing. No element around ``main`` is dropped, and no form around an
    article; if no text is left at all, no element around an article is either.
    """
    tags = _tags(page)
    out = _lines(page, tags, ("main",))
    if not any(x.text for x in out) and any(t.name == "article" for t in tags):
        out = _lines(page, tags, ("main", "article"))
    return out, any(x.inside for x in out)


def _lines(page: str, tags: list[Tag], spared: tuple[str, ...]) -> list[Line]:
    """Lines of text; elements that are or hold one of ``spared`` are not dropped for their name."""
    opened = {
        x: [k for k, t in enumerate(tags) if t.name == x and not t.close]
        for x in ("main", "article")
    }
    ends = _ends(tags)
    out: list[Line] = []
    held: list[str] = []
    linked, links, article, at, k = 0, 0, 0, 0, 0

    def flush(empty: int = 0) -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(Line(text, linked, article > 0))
        out.extend([Line("", 0, False)] * empty)
        linked = 0

    while k <= len(tags):
        tag = tags[k] if k < len(tags) else Tag(len(page), len(page), "", False, "")
        piece = page[at : tag.start]
        if piece:
            held.append(piece)
            if links:
                linked += len(piece)
        at = tag.end
        k += 1
        if not tag.name or tag.name in INLINE and not _name(_names(tag.rest), BOILERPLATE):
            links = max(0, links + (-1 if tag.close else 1)) if tag.name == "a" else links
            continue
        if not tag.close and tag.name not in VOID:
            names = _names(tag.rest)
            top = tag.name == "header" or _name(names, PAGE_TOP)
            drop = tag.name in DROPPED and tag.name != "header" or _name(names, BOILERPLATE)
            if drop and tag.name not in ("html", "body") or top and not article:
                stop = ends[k - 1]
                hold = ("main", "article") if tag.name == "form" else spared
                around = tag.name in AROUND or tag.name not in DROPPED
                if around and stop is not None and any(
                    bisect_left(opened[x], k - 1) < bisect_left(opened[x], stop) for x in hold
                ):
                    stop = None
                if stop is not None:
                    flush(GAP)
                    k, at = stop + 1, tags[stop].end
                    continue
        flush()
        if tag.name in ("article", "main"):
            article = max(0, article + (-1 if tag.close else 1))
    flush()
    return out


def main_text(page: str) -> str:
    """Text between the surges and dives, blocks joined by a space.

    A marked article bounds the lines that are looked at, and its links are text like any other;
    where its text surges and dives is found in the same way.
    """
    lines, marked = lines_of(page)
    if marked:
        lines = [x for x in lines if x.inside]
    size = [len(x.text) if marked or 2 * x.linked <= len(x.text) else 0 for x in lines]
    sums = [sum(size[i : i + GAP]) for i in range(len(size))]
    most = max(sums, default=0)
    if not most:  # nothing but links
        return " ".join(x.text for x in lines if x.text)
    least = min(SURGE, most / 2)
    surges = [i for i, x in enumerate(sums) if size[i] and x >= least]
    start, stop = surges[0], surges[-1] + 1
    for i in range(stop, min(surges[-1] + GAP, len(lines))):  # the rest of the last surge
        if size[i]:
            stop = i + 1
    # Outward to the next line of links: a heading, or an end behind a dropped element.
    while start and (size[start - 1] or not lines[start - 1].text):
        start -= 1
    while stop < len(lines) and (size[stop] or not lines[stop].text):
        stop += 1
    return " ".join(x.text for x in lines[start:stop] if x.text)


SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


def extract(pages: DataFrame) -> DataFrame:
    """Main text of each row of ``pages`` (page_id, url, html); other columns are ignored.

    A null or empty page, or one without main text, has an empty text. Ids and urls are carried,
    null or repeated. Each page is worked on alone: no shuffle, no state.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(run, SCHEMA)
