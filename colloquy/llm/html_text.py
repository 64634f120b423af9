"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every paragraph gives points, for its length and its commas,
to its parent, and a smaller share to the ancestors above; a container's points are discounted
by the share of its text that stands in links. The best container is kept with those siblings
that score well enough or are plain prose, and its blocks of text come out in page order.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import slices

# Fixed values of HTML: elements without an end tag, with raw text, and those that open a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
# Elements and words in class, id or role that mark what is not the article.
ASIDE = frozenset(
    "nav header footer aside form script style noscript template iframe head button select input textarea dialog menu "
    "svg canvas object embed audio video map search".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent contentinfo cookie cookies disqus footer form gdpr hidden login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup promo promoted promotion related "
    "recommended replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags "
    "toolbar topbar widget".split()
)
# Words that may stand beside those in the name of a class without a meaning of their own.
PLAIN_WORDS = frozenset(
    "area bar body block bottom box btn button buttons card center container content first global group header icon icons "
    "inline inner item items js last layout left link links list main message module note outer page panel post posts "
    "primary region right row section secondary site slot story strip text title top unit wrap wrapper x".split()
)
# What marks even a paragraph or a heading of an article as foreign to it.
AD_WORDS = frozenset("ad ads adv advert adverts advertisement advertising cookie cookies hidden promo promoted sponsor sponsored subscribe".split())
# What marks a part of an article as foreign to it only if the part has little prose.
DOUBTFUL_WORDS = frozenset("form login recommended related search share sharing skip social tags toolbar widget".split())
KEEPS = frozenset("html body article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td th blockquote li dd h1 h2 h3 h4 h5 h6".split())

_MARKUP = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)"
    r"|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|[!?/][^>]*+>?)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'>/]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
_WORDS = re.compile(r"[A-Za-z][a-z]*+|[A-Z]++")


class Node:
    __slots__ = ("tag", "parent", "children", "aside", "points", "chars", "link_chars", "commas", "main", "doubt")

    def __init__(self, tag: str, parent: Node | None, aside: bool = False, main: bool = False, doubt: bool = False):
        self.tag, self.parent, self.aside, self.main, self.doubt = tag, parent, aside, main, doubt
        self.children: list[Node | str] = []
        self.points, self.chars, self.link_chars, self.commas = 0.0, 0, 0, 0


def _foreign_names(value: str, foreign: frozenset[str]) -> set[str]:
    """The foreign words of whole class names (or ids, or roles) that are made of foreign words, perhaps with plain ones."""
    found: set[str] = set()
    for name in value.strip("\"'").split():
        words = {w.lower() for w in _WORDS.findall(name)}
        if words & foreign and words <= ASIDE_WORDS | PLAIN_WORDS:
            found |= words & foreign
    return found


def _marks(tag: str, attrs: str, inside: bool) -> tuple[bool, bool, bool]:
    """(not part of the article, main content, doubtful) by element, class, id and role; inside: within an article or main content."""
    aside, main, doubt = tag in ASIDE, tag in ("article", "main"), False
    if attrs and "=" in attrs:
        foreign = AD_WORDS if inside and tag in PARAGRAPHS else ASIDE_WORDS
        for key, value in _ATTR.findall(attrs):
            key = key.lower()
            if key in ("class", "id", "role"):
                found = _foreign_names(value, foreign) if tag not in KEEPS else set()
                if inside and found and found <= DOUBTFUL_WORDS:
                    doubt = True
                elif found:
                    aside = True
                main = main or (key == "role" and value.strip("\"'").lower() == "main")
            elif key == "aria-hidden" and "true" in value.lower() or key == "style" and re.search(r"display\s*:\s*none", value):
                aside = aside or tag not in KEEPS
    return aside, main, doubt and not aside


class _Open:
    """The open elements of a page being parsed, with the places of each kind; nothing climbs from element to element."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.blocks, self.mains = [root], {}, [0], 0

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.mains += node.main
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Close the element at a place and all within it."""
        while len(self.nodes) > place:
            node = self.nodes.pop()
            self.at[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()
            self.mains -= node.main

    def last(self, tag: str) -> int:
        """The place of the innermost open element of a tag; 0 if there is none."""
        places = self.at.get(tag)
        return places[-1] if places else 0

    def first_after(self, tags: frozenset[str], place: int) -> int:
        """The place of the outermost open element of these tags beyond a place; 0 if there is none."""
        found = 0
        for tag in tags:
            places = self.at.get(tag, [])
            k = bisect.bisect_right(places, place)
            if k < len(places) and (not found or places[k] < found):
                found = places[k]
        return found


def parse(text: str) -> Node:
    """The tree of a page, in time proportional to its length; end tags that nothing opened are ignored, missing ones are supplied.

    A block's start ends an open paragraph; an inline end tag closes no block; a slash at the end of a start tag means nothing.
    """
    root = Node("#root", None)
    open_, doubts = _Open(root), False
    at, last_mark = 0, text.rfind(">")
    while at < len(text):
        found = _MARKUP.search(text, at) if at <= last_mark else None
        if not found or found.start() > last_mark:  # what is left has no markup but perhaps an open comment
            left = text[at:]
            open_.nodes[-1].children.append(html.unescape(left.partition("<!--")[0]))
            break
        if found.start() > at:
            open_.nodes[-1].children.append(html.unescape(text[at : found.start()]))
        at = found.end()
        tag = found["tag"]
        if tag is None:
            if found["cdata"] is not None:
                open_.nodes[-1].children.append(found["cdata"])
            continue
        tag = tag.lower()
        if found["end"]:
            place = open_.last(tag)
            if place and (tag in BLOCK or place > open_.blocks[-1]):
                open_.close(place)
            continue
        if tag in BLOCK and open_.nodes[open_.blocks[-1]].tag == "p":
            open_.close(open_.blocks[-1])
        if tag in CLOSED_BY:
            ends, stops = CLOSED_BY[tag]
            place = open_.first_after(ends, max(map(open_.last, stops)))
            if place:
                open_.close(place)
        aside, main, doubt = _marks(tag, found["attrs"], open_.mains > 0)
        if tag == "header" and open_.last("article"):  # an article's own heading stays
            aside = False
        new = Node(tag, open_.nodes[-1], aside, main, doubt)
        doubts = doubts or doubt
        open_.nodes[-1].children.append(new)
        if tag in VOID:
            continue
        if tag in RAW:
            close = _RAW_ENDS[tag].search(text, at)
            at = close.end() if close else len(text)
            continue
        open_.push(new)
    if doubts:
        _settle(root)
    return root


def _settle(root: Node) -> None:
    """Put doubtful parts aside unless half of their text or more is prose: blocks of 80 characters or more outside links."""
    order: list[tuple[Node, bool]] = []
    stack = [(root, False)]
    while stack:
        node, linked = stack.pop()
        order.append((node, linked))
        stack += [(c, linked or c.tag == "a") for c in node.children if not isinstance(c, str) and not c.aside]
    sums = {id(node): [0, 0, 0] for node, _ in order}  # all characters, those of the open block outside links, prose
    for node, linked in reversed(order):
        mine = sums[id(node)]
        own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        mine[0] += own
        mine[1] += 0 if linked else own
        if node.tag in BLOCK:
            mine[2] += mine[1] if mine[1] >= 80 else 0
            mine[1] = 0
        if node.doubt:
            node.aside = 2 * mine[2] < max(mine[0], 1)
        if node.parent is not None and not node.aside:
            for k in range(3):
                sums[id(node.parent)][k] += mine[k]




def _blocks(node: Node, out: list[list[str]]) -> None:
    """Runs of text under node, a new run at every block's edge; out's last run is open."""
    stack: list = [(node, iter(node.children))]
    if node.tag in BLOCK and out[-1]:
        out.append([])
    while stack:
        top, children = stack[-1]
        for child in children:
            if isinstance(child, str):
                out[-1].append(child)
            elif not child.aside:
                if child.tag in BLOCK:
                    if out[-1]:
                        out.append([])
                elif child.tag in ("br", "wbr"):
                    out[-1].append(" " if child.tag == "br" else "")
                stack.append((child, iter(child.children)))
                break
        else:
            stack.pop()
            if top.tag in BLOCK and out[-1]:
                out.append([])


def _score(root: Node) -> list[Node]:
    """Fill in the measures of every node that is not aside; the containers that got points.

    A paragraph's parent gets all its points, and so does the nearest article or main content around it; other
    ancestors, up to four levels, get a share that falls with the level.
    """
    order: list[tuple[Node, bool, Node | None]] = []
    stack: list[tuple[Node, bool, Node | None]] = [(root, False, None)]
    while stack:
        node, linked, main = stack.pop()
        order.append((node, linked, main))
        inner = node if node.main else main
        stack += [(c, linked or c.tag == "a", inner) for c in node.children if not isinstance(c, str) and not c.aside]
    containers: list[Node] = []

    def give(up: Node, points: float) -> None:
        if not up.points:
            containers.append(up)
        up.points += points

    for node, linked, main in reversed(order):
        texts = [c for c in node.children if isinstance(c, str)]
        own, commas = sum(len(" ".join(c.split())) for c in texts), sum(c.count(",") for c in texts)
        node.chars += own
        node.commas += commas
        node.link_chars += own if linked else 0
        paragraph = node.tag in PARAGRAPHS and node.chars
        if paragraph or own > 80 and node.tag in BLOCK:
            chars, marks = (node.chars, node.commas) if paragraph else (own, commas)
            gain = (1 + marks + min(chars / 100, 3)) * (1 - node.link_chars / max(node.chars, 1))
            share, up = 1.0, node.parent if paragraph else node
            for level in range(4):
                if up is None:
                    break
                if up is not main and (up.tag in BLOCK and up.tag not in PARAGRAPHS or up.tag == "#root"):
                    give(up, gain * share)
                    share = share / 2 if level == 0 else share * level / (level + 1)
                up = up.parent
            if main is not None and gain:
                give(main, gain)
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.commas += node.commas
            node.parent.link_chars += node.link_chars
    return containers


def _final(node: Node) -> float:
    return node.points * (1 - node.link_chars / max(node.chars, 1))


def _with_bare_text(row: list[Node | str], stays: list[int]) -> list[Node]:
    """The siblings that stay, and what stands between them outside any block, unless most of it is links."""
    kept: list[Node] = []
    for k, nearest in zip(stays, [None, *stays], strict=False):
        between = [] if nearest is None else row[nearest + 1 : k]
        at = 0
        while at < len(between):
            bare = Node("#text", None)
            while at < len(between) and (isinstance(between[at], str) or between[at].tag not in BLOCK):
                if isinstance(between[at], str):
                    bare.chars += len(" ".join(between[at].split()))
                elif not between[at].aside:
                    bare.chars += between[at].chars
                    bare.link_chars += between[at].chars if between[at].tag == "a" else between[at].link_chars
                bare.children.append(between[at])
                at += 1
            if bare.chars and 2 * bare.link_chars < bare.chars:
                kept.append(bare)
            at += 1
        kept.append(row[k])
    return kept


def _has_title(node: Node) -> bool:
    stack = [node]
    while stack:
        top = stack.pop()
        if top.tag == "h1":
            return True
        stack += [c for c in top.children if not isinstance(c, str) and not c.aside]
    return False


def _title_above(best: Node) -> Node | None:
    """The one h1 that stands beside an ancestor of the best container, before it and level with no other h1."""
    up = best.parent
    while up is not None and up.parent is not None and not up.main:
        titles = [(k, c) for k, c in enumerate(up.parent.children) if not isinstance(c, str) and not c.aside and c.tag == "h1" and c.chars]
        if titles:
            place = next(k for k, c in enumerate(up.parent.children) if c is up)
            return titles[0][1] if len(titles) == 1 and titles[0][0] < place else None
        up = up.parent
    return None


def main_text(page: str | None) -> str:
    """The article's text: blocks in page order, one line each; empty if there is none or page is null.

    Points decide which container it is; of equal ones article and main content come first, then the outermost.
    """
    if not page:
        return ""
    root = parse(page)
    containers = _score(root)
    if containers:
        best = max(reversed(containers), key=lambda x: (_final(x), x.main))  # of equals the outermost, then the first of the page
        kept: list[Node] = [best]
        if best.parent is not None:
            least = max(2.0, 0.2 * _final(best))
            row = best.parent.children
            stays = []
            for k, s in enumerate(row):
                if isinstance(s, str) or s.aside:
                    continue
                density = s.link_chars / max(s.chars, 1)
                prose = s.tag in HEADINGS or s.tag == "p" and (s.chars > 80 and density < 0.25 or s.chars and not density)
                if s is best or prose or s.tag in BLOCK and _final(s) >= least and density < 0.5:
                    stays.append(k)
            kept = _with_bare_text(row, stays)
        title = _title_above(best)
        if title is not None and not any(map(_has_title, kept)):
            kept.insert(0, title)
    else:
        kept = [root]
    runs: list[list[str]] = [[]]
    for node in kept:
        _blocks(node, runs)
        if runs[-1]:
            runs.append([])
    lines = (" ".join("".join(run).split()) for run in runs)
    return "\n".join(line for line in lines if line)


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html).

    A null or empty html gives an empty text of 0 characters; a null page_id or url stays null;
    repeated rows come out as often as they are; extra columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=OUT)

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
