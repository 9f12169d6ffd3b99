"""Operator 4: main text of HTML pages by tree scoring.

A page becomes a tree of its block elements.  Every paragraph of 25 code points or more
is worth one point, one for each comma and one for each hundred code points, at most
three; its container gets the points, the containers above a half, a third, ...
An element's score is discounted by its link density.  If the best element lies in an
<article>, that one is the article as a whole; siblings with at least a fifth of its
score, and sibling paragraphs of plain prose, are kept with it.  Otherwise the article
grows from the best element up to the body: each container's other children and own text
join it, but for those that are mostly links.

Never part of the text: scripts, styles, forms and other elements of the page's
frame (by element, by role, by words in class or id), hidden elements, and lists
inside the article that are nearly all links.  A class or id with other words besides
the frame's is weak evidence: an element so named counts for no container's score, but inside
the article it stays if it holds prose, few links and no form.  If the frame's word is the head
of the name (``reader-comments``, ``newsletter-box``) the element goes, as prose says nothing
then; only an id made from the heading it holds stays, unless it names comments.  Ids of headings and
paragraphs are no evidence, as they are made from their text.  A label is part of its sentence
unless it belongs to a control (``for``) or a form.

Time is linear in the page, however deep its blocks are nested: sums go from each element to
its container once, and a paragraph's points reach ``POINTS_REACH`` containers.

Defined results: null, empty or markup-only html gives the empty text; unclosed
and stray tags follow HTML's rules of implied ends; an unfinished comment, script or
tag at the end holds no text; null ids and urls are kept; repeated rows repeat; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as html_lib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, map_arrow, table, text_or_empty

MIN_PARAGRAPH = 25
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0
MENU_DENSITY = 0.8
#: outside an <article>: link density above which a container beside the best one is no article text
LINKS_DENSITY = 0.5
#: points by which an element inside the article stays though its class says frame
NAMED_LEAST = 10.0
#: containers above a paragraph that get a share of its points; the share of the last is under 1 %
POINTS_REACH = 128
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))

_words = lambda s: frozenset(s.split())
PARAGRAPHS = _words("p pre li td th dt dd h1 h2 h3 h4 h5 h6 blockquote figcaption caption summary address")
BLOCKS = PARAGRAPHS | _words(
    "html body div section article main ul ol dl table tbody thead tfoot tr figure details center "
    "nav header footer aside form fieldset dialog menu search hgroup object head select button "
    "optgroup option label canvas video audio svg math map noscript template datalist frameset")
#: elements whose text is no part of any article
FRAME = _words("nav header footer aside form fieldset dialog menu search head select button option optgroup "
               "canvas video audio svg math map object noscript template datalist frameset label")
RAW = _words("script style textarea title iframe xmp noembed noframes plaintext")
VOID = _words("area base br col embed hr img input link meta source track wbr param keygen")
#: a start tag of the key ends these open elements, up to the nearest container
ENDS = {"li": _words("li"), "dt": _words("dt dd"), "dd": _words("dt dd"), "tr": _words("tr td th"),
        "td": _words("td th"), "th": _words("td th"), "option": _words("option"),
        "tbody": _words("tr td th thead tbody"), "tfoot": _words("tr td th tbody")}
SCOPE = _words("ul ol dl table td th body article section div aside nav main object")
ENDS_P = BLOCKS - _words("label button object svg math map canvas video audio select option optgroup noscript template td th html body head")
ROLES = _words("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar")
BOILERPLATE = _words(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments "
    "commentlist consent cookie cookies cookiebar disqus footer gdpr header masthead menu menus modal nav navbar navigation "
    "newsletter notice notices overlay pager pagination popup promo promoted promotion related replies respond share "
    "sharing shoutbox sidebar sidebars signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets")
DISCUSSION = _words("comment comments commentlist disqus replies respond")
#: words that name a box as such; the head of a name stands before them
BOXES = _words("area block body box card container content form group inner item items list main outer panel row section thread wrap wrapper")
SAYS_THERE_IS = _words("has with without no is show hide")
TABLE = _words("td th table tr tbody thead tfoot body")
_CELLS = _words("td th table")
KEPT_NAMES = _words("html body article main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_CONTROL = re.compile(r"\bfor\s*=", re.I)
_COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("tag", "up", "out", "named", "points", "chars", "links", "n_links", "kids", "heading", "form")

    def __init__(self, tag: str, up: Node | None, out: bool, named: Name | None = None) -> None:
        self.tag, self.up, self.out, self.named = tag, up, out, named
        self.points, self.chars, self.links, self.n_links = 0.0, 0, 0, 0
        self.kids: list[Node] = []
        #: words of the first heading among the children; whether a form lies inside
        self.heading: frozenset | None = None
        self.form = False
        if up is not None:
            up.kids.append(self)

    def density(self) -> float:
        return self.links / self.chars if self.chars else 0.0

    def score(self) -> float:
        return self.points * (1 - self.density())


class Name:
    """What a class or id that says frame in part is: the attribute, the frame word that is
    its head (or none), and all its words."""
    __slots__ = ("attribute", "head", "words")

    def __init__(self, attribute: str, head: str, words: frozenset) -> None:
        self.attribute, self.head, self.words = attribute, head, words


def _name_words(name: str) -> list[str]:
    return [w.lower() for w in _NAME_PARTS.findall(name)]


def _names_frame(name: str) -> int:
    """One class or id: 3 if all its words are frame words, 2 if the head is (the last word
    but for numbers and words for boxes), 1 if another is, 0 if none is or if it just says that there is one."""
    parts = _name_words(name)
    if not parts or parts[0] in SAYS_THERE_IS or BOILERPLATE.isdisjoint(parts):
        return 0
    if all(w in BOILERPLATE or w.isdigit() for w in parts):
        return 3
    return 2 if _head(parts) in BOILERPLATE else 1


def _head(parts: list[str]) -> str:
    return next((w for w in reversed(parts) if w not in BOXES and not w.isdigit()), "")


def _in_frame(tag: str, attributes: str) -> tuple[bool, Name | None]:
    """(the element belongs to the page's frame or is hidden, else the name
    that says so in part)."""
    if tag in FRAME:
        return True, None
    named: Name | None = None
    if "=" not in attributes and "hidden" not in attributes:
        return False, None
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html_lib.unescape(a or b or c)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, None
        if name == "role" and value.strip().lower() in ROLES:
            return True, None
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, None
        if name in ("class", "id") and tag not in KEPT_NAMES and not (name == "id" and (tag == "p" or tag in HEADINGS)):
            for one in value.split():
                says, parts = _names_frame(one), _name_words(one)
                if says == 3:
                    return True, None
                head = _head(parts) if says == 2 else ""
                # a head outweighs a word, a class outweighs an id
                if says and (named is None or (bool(head), name == "class") > (bool(named.head), named.attribute == "class")):
                    named = Name(name, head, frozenset(w for w in parts if not w.isdigit()))
    return tag == "article" and bool(re.search(r"""(?:class|id)\s*=\s*["']?[^"'>]*\bcomment""", attributes, re.I)), named


class Page:
    """The block tree of one page and its text in page order."""

    def __init__(self, html: str) -> None:
        self.root = Node("html", None, False)
        self.stack = [self.root]
        #: all elements, containers first, and the depths at which each tag is open
        self.nodes = [self.root]
        self.open: dict[str, list[int]] = {}
        #: (node, text, code points in links) of every run of text between block boundaries
        self.blocks: list[tuple[Node, str, int]] = []
        self._run: list[str] = []
        self._linked = 0
        self._in_link = False
        self._parse(html)
        self._sum_up()

    # text

    def _text(self, raw: str) -> None:
        if raw and not self.stack[-1].out:
            text = html_lib.unescape(raw) if "&" in raw else raw
            self._run.append(text)
            if self._in_link:
                self._linked += len("".join(text.split()))

    def _end_block(self) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            if text:
                node = self.stack[-1]
                self.blocks.append((node, text, self._linked))
                self._pass_points(node, text)
            self._run, self._linked = [], 0

    def _pass_points(self, node: Node, text: str) -> None:
        node.chars += len(text) - text.count(" ")
        node.links += self._linked
        if node.tag in HEADINGS and node.up.heading is None:
            node.up.heading = frozenset(_name_words(text))
        if len(text) < MIN_PARAGRAPH:
            return
        points = 1.0 + len(_COMMAS.findall(text)) + min(len(text) / 100, 3.0)
        up = node.up if node.tag in PARAGRAPHS and node.up is not None and not node.named else node
        for share in range(1, POINTS_REACH + 1):
            up.points += points / share
            up = None if up.named else up.up
            if up is None:
                break

    def _sum_up(self) -> None:
        """Code points, links and forms of every element go to its container."""
        for node in reversed(self.nodes[1:]):
            up = node.up
            up.n_links += node.n_links
            up.form = up.form or node.form or node.tag == "form"
            if not node.named:
                up.chars += node.chars
                up.links += node.links

    # tags

    def _close_to(self, depth: int) -> None:
        """Closes open elements until ``depth`` are left."""
        self._end_block()
        while len(self.stack) > max(1, depth):
            self.open[self.stack.pop().tag].pop()
        self._in_link = False

    def _innermost(self, tags: frozenset) -> int:
        """Depth of the innermost open element of these tags, 0 if none is open."""
        return max((at[-1] for t in tags if (at := self.open.get(t))), default=0)

    def _close_any(self, tags: frozenset, scope: frozenset) -> None:
        k = self._innermost(tags)
        if k and k > self._innermost(scope):
            self._close_to(k)

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self._in_link = "href" in attributes.lower()
            self.stack[-1].n_links += 1
            return
        if tag in ("br", "hr"):
            self._text(" ")
        if tag not in BLOCKS or tag == "html" or tag == "label" and not _CONTROL.search(attributes):
            return
        if tag == "body":
            self._close_any(_words("head"), frozenset())
        if tag in ENDS_P:
            self._close_any(_words("p"), SCOPE)
        if tag in ENDS:
            self._close_any(ENDS[tag], _words("ul ol dl table") if tag in ("li", "dt", "dd") else _words("table"))
        self._end_block()
        self._in_link = False
        if attributes.rstrip().endswith("/") and tag in ("svg", "math"):
            return
        top = self.stack[-1]
        out, named = _in_frame(tag, attributes) if not top.out else (True, None)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Node(tag, top, out, named))
        self.nodes.append(self.stack[-1])

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._in_link = False
        elif tag in ("br", "p") and not self.open.get(tag):
            self._text(" ")
        elif tag in BLOCKS:
            k = self._innermost(HEADINGS if tag in HEADINGS else frozenset((tag,)))
            if k and (tag in TABLE or k > self._innermost(_CELLS)):
                self._close_to(k)

    def _parse(self, html: str) -> None:
        at = 0
        while m := _TOKEN.search(html, at):
            self._text(html[at:m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else len(html)
            else:
                self._start(tag, m[3])
        self._text(html[at:])
        self._close_to(1)

    # choice

    def _elements(self) -> list[Node]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if not node.out and not node.named:
                out.append(node)
                todo += reversed(node.kids)
        return out

    @staticmethod
    def _is_prose(node: Node) -> bool:
        """A named element inside the article that its text speaks for: a section
        whose id comes from its heading, or one of many points."""
        name = node.named
        if node.form or node.density() > LINKS_DENSITY:
            return False
        if name.head and (name.attribute != "id" or name.head in DISCUSSION or not node.heading or not name.words <= node.heading):
            return False
        section = name.attribute == "id" and (node.tag == "section" or node.heading is not None)
        return node.points >= (1.0 if section else NAMED_LEAST)

    def _frame_by_name(self, best: Node) -> list[Node]:
        """Named elements that stay out: those outside ``best``, and those inside
        that are no prose."""
        out, todo = [], [(self.root, self.root is best)]
        while todo:
            node, inside = todo.pop()
            if node.named and not (inside and self._is_prose(node)):
                out.append(node)
            else:
                todo += [(k, inside or k is best) for k in node.kids]
        return out

    def kept(self) -> tuple[list[Node], list[Node], list[Node]]:
        """(elements kept, elements inside them left out, containers that the article
        grew into, whose own text counts unless it is mostly links)."""
        nodes = self._elements()
        best = max(nodes, key=Node.score)
        if best.score() <= 0:
            whole = [n for n in nodes if n.tag in ("article", "main") and n.chars]
            whole = whole[:1] or [self.root]
            return whole, self._frame_by_name(whole[0]), []
        top: Node | None = best
        while top is not None:
            if top.tag == "article":
                best = top
            top = top.up
        if best.up is None:
            return [best], self._frame_by_name(best), []
        if best.tag != "article":
            top, left, above = self._grown(best)
            return top, left + self._frame_by_name(best), above
        need = max(SIBLING_LEAST, SIBLING_SHARE * best.score())
        out = []
        for node in best.up.kids:
            if node is best or not node.out and not node.named and (
                    node.score() >= need or node.tag == "p" and node.density() < 0.25 and node.chars > 80):
                out.append(node)
        return out, self._frame_by_name(best), []

    @staticmethod
    def _grown(best: Node) -> tuple[list[Node], list[Node], list[Node]]:
        left, above, top = [], [], best
        while top.up is not None:
            for node in top.up.kids:
                most = 1.0 if node.tag == "h1" else MENU_DENSITY if node.tag in PARAGRAPHS else LINKS_DENSITY
                if node is not top and node.density() > most:
                    left.append(node)
            top = top.up
            above.append(top)
        return [top], left, above

    def text(self) -> str:
        nodes, left, above = self.kept()
        kept, grown = {id(n) for n in nodes}, {id(n) for n in above}
        menus = {id(n) for n in self._elements() if n.tag in ("ul", "ol") and n.n_links >= 3 and n.density() > MENU_DENSITY}
        menus.update(map(id, left))
        # containers come before what they hold: 1 inside a kept element, -1 inside one left out
        state: dict[int, int] = {}
        for node in self.nodes:
            above_it = state[id(node.up)] if node.up is not None else 0
            state[id(node)] = -1 if above_it < 0 or id(node) in menus else 1 if above_it or id(node) in kept else 0
        return " ".join(text for node, text, linked in self.blocks if state[id(node)] > 0 and not (
            id(node) in grown and linked > LINKS_DENSITY * (len(text) - text.count(" "))))


def main_text(html: str) -> str:
    return Page(html).text()


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) for every row of ``pages``.  A narrow pass, no shuffle."""
    schema = T.StructType([field(pages, id_col), field(pages, url_col), T.StructField("text", T.StringType())])

    def run(batch: pa.RecordBatch) -> list:
        return [batch.column(0), batch.column(1), [main_text(h) for h in batch.column(2).to_pylist()]]

    return map_arrow(pages.select(id_col, url_col, text_or_empty(html_col).alias("html")), run, schema)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))
