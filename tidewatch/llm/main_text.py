"""Main text of a web page by composite text density.

A page is read into a tree of elements. Elements that are never part of an article by
their name or role (menus, headers, footers, asides, scripts, styles) and hidden ones are left
out as they are met. Forms, and elements whose class or id names a sidebar, notice, advert or
reader comments, are left out only while they hold little of the page: a whole word of the
class ('sidebar', or 'cookie-notice', all of whose parts say so) or a form up to HINT_SHARE of
the page's unlinked text, or HINT_CHARS if there is any other text; a part of a longer word
('has-sidebar') up to PART_SHARE and never around the core. Every remaining node gets

    density = C/T * log(C/LC * T/LT, base ln(C/(C-LC) * LC + LCb/Cb * C + e))

with C characters, T tags, LC and LT those inside links, b the body, and a zero divisor
counting as 1: link-adjusted characters per tag. The node whose children's densities sum
highest is the core of the article, and the threshold is the lowest density on the path from
the core to the body. From the body down, wherever an element's
density reaches the threshold, the element of the highest sum inside it is kept with all its
text, short paragraphs included; text between elements is measured as an element of its own.
Whatever is not kept so is left out: menus, link blocks, short lines.

An article (else main) element breaks ties in two ways. Where the core only encloses one that
holds most of its unlinked text, that one is the core, as the sum counts its text again. Where
the core lies in one, other parts of it are left out only if they are below the threshold and
mostly links. Without one, parts of the core that are below the threshold, mostly links and
hold more than one link are left out.

A null or empty page, or one without text, has the text ''. A tie of sums goes to the node
that comes first. Unclosed and misnested tags are closed as browsers do for the common
cases: a block start ends an open paragraph, an end tag ends everything inside of it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import map_slices

# fixed values: HTML's element kinds
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg math xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html"}
#: Start tags that end an open element of these names in the same list or table.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCE = {"ul", "ol", "dl", "table", "select", "menu"}
FORMATTING = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())

# what is no article
OUTSIDE = set("nav header footer aside button select dialog menu".split())
OUTSIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion"
    " comment comments disqus respond replies cookie cookies consent gdpr notice notices alert popup modal overlay"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget related recommended"
    " header masthead footer copyright share sharing social newsletter subscribe subscription signup login search toolbar skip".split()
)
ARTICLE_WORDS = {"article", "content", "post", "entry", "story", "main", "body"}
#: Largest share of a page's unlinked text in an element that is left out for a word, and for a part of a word.
HINT_SHARE, PART_SHARE = 0.75, 0.25
HINT_CHARS = 140
COMMENTS = {"comment", "comments", "disqus", "respond", "replies"}
COMMENT, WORD, PART = 3, 2, 1
#: Part of the core's worth from which on something outside the core, and outside the article, is main text too.
BESIDE_CORE = 0.25

_TAG_START = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_BALANCED = re.compile(r"""(?>[^"']+|"[^"]*"|'[^']*')*+""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?(?=[\s/"']|$)""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parent", "children", "parts", "order", "chars", "tags", "link_chars", "link_tags", "density", "total", "article", "hint", "own")

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.children: list[Node] = []
        self.parts: list[Node | str] = []  # children and texts in page order
        self.article = False
        self.hint = 0
        self.own: int | None = None  # characters of its own texts, once they are counted


def _outside(name: str, attributes: str) -> tuple[bool, bool, int]:
    """(never part of an article, named an article, hint that it is none: COMMENT, WORD, PART or 0)."""
    if name in OUTSIDE:
        return True, False, 0
    article = name in ("article", "main")
    hint = WORD if name == "form" else 0
    if not attributes:
        return False, article, hint
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return True, False, 0
        if key == "role":
            if value in OUTSIDE_ROLES:
                return True, False, 0
            if value == "form":
                hint = WORD
            article |= value in ("main", "article")
        if key in ("class", "id"):
            names, whole = set(_NAME.findall(value)), set(value.split())
            if names & OUTSIDE_WORDS and name not in ("body", "html", "main") and not (name == "article" and names & ARTICLE_WORDS and not whole & {"comment", "comments"}):
                telling = [parts for w in whole if (parts := _NAME.findall(w)) and OUTSIDE_WORDS.issuperset(parts)]
                hint = max(hint, COMMENT if any(not COMMENTS.isdisjoint(p) for p in telling) else WORD if telling else PART)
    return False, article, hint


class _Tags:
    """Tags of a page one after the other. Every search goes forward and what is not there is looked for once, so a page
    takes time in proportion to its length, whatever brackets and quotes it holds."""

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[str, int] = {}  # next place of a character, as last looked up
        self.tries = 1 << 10  # tags with quotes that stay open; beyond them such a tag ends at its first bracket

    def _next(self, what: str, at: int) -> int:
        known = self.ends.get(what)
        if known is None or (known != -1 and known < at):
            known = self.ends[what] = self.page.find(what, at)
        return known

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, whether an end tag, name or None for a comment, attributes) of the next tag."""
        while True:
            m = _TAG_START.search(self.page, at)
            if m is None:
                return None
            if m[1]:
                stop = self._next("-->", m.end())
                return m.start(), len(self.page) if stop < 0 else stop + 3, False, None, ""
            close = self._next(">", m.end())
            if close < 0:
                return None  # no bracket closes: all that follows is text
            if m[3] is None:
                return m.start(), close + 1, False, None, ""
            stop = self._tag_end(m.end(), close)
            return m.start(), stop + 1, bool(m[2]), m[3], self.page[m.end() : stop]

    def _tag_end(self, at: int, close: int) -> int:
        """The first closing bracket outside quotes; the first of all when there is none."""
        lo, stop = at, close
        attributes = self.page[at:close]
        if '"' not in attributes and "'" not in attributes:
            return close
        while True:
            lo = _BALANCED.match(self.page, lo, stop).end()
            if lo == stop:
                return stop
            if self.tries <= 0:
                return close
            quote = self._next(self.page[lo], stop)
            self.tries -= 1
            if quote < 0:
                return close
            lo, stop = quote + 1, self.page.find(">", quote + 1)
            if stop < 0:
                return close


def parse(page: str) -> Node:
    """Tree of the elements that may belong to an article."""
    root = Node("body", None)
    open_ = _Open([root])
    outside = _Open()  # names of open elements that are not kept, from the topmost one on
    at = 0

    def text(lo: int, hi: int) -> None:
        if hi > lo and not outside:
            open_[-1].parts.append(page[lo:hi])

    tags = _Tags(page)
    while True:
        found = tags.next(at)
        if found is None:
            text(at, len(page))
            break
        start, stop, end, name, attributes = found
        if start > at:
            text(at, start)
        at = stop
        if name is None:
            continue
        name = name.lower()
        if end:
            if outside:
                if outside.names[name]:
                    outside.cut(outside.last(name))
                elif name in ("body", "html"):
                    outside.cut(0)
                continue
            _close(open_, name)
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if close is None:
                at = len(page)
            else:
                stop = page.find(">", close.end())
                at = len(page) if stop < 0 else stop + 1
            continue
        if outside:
            if name not in VOID and not attributes.endswith("/"):
                if name in ENDS_PARAGRAPH and outside.names["p"] and outside.last("p"):
                    outside.cut(outside.last("p"))
                outside.push(name)
            continue
        if name in ("html", "body", "head"):
            continue
        if name == "br":
            open_[-1].parts.append(" ")
        if name in VOID:
            if name == "hr":
                open_[-1].parts.append(Node("hr", open_[-1]))
            continue
        if name in ENDS_PARAGRAPH:
            _close_paragraph(open_)
        if name in SIBLINGS:
            _close_sibling(open_, SIBLINGS[name])
        left_out, article, hint = _outside(name, attributes)
        if left_out and not (name == "header" and (open_.names["article"] or open_.names["main"])):  # an article's own header holds its title
            if name in BLOCK:
                open_[-1].parts.append(Node("hr", open_[-1]))  # a block that is gone still ends a line
            outside.push(name)
            continue
        node = Node(name, open_[-1])
        node.article, node.hint = article, hint
        open_[-1].children.append(node)
        open_[-1].parts.append(node)
        open_.push(node)
    return root


class _Open(list):
    """Open elements (nodes, or names) from the outside in, with how many there are of each name: what is not open is not looked for."""

    def __init__(self, items=()):
        super().__init__(items)
        self.names = Counter(map(_name, self))

    def push(self, item: Node | str) -> None:
        self.append(item)
        self.names[_name(item)] += 1

    def cut(self, k: int) -> None:
        self.names.subtract(map(_name, self[k:]))
        del self[k:]

    def last(self, name: str) -> int:
        return next(k for k in range(len(self) - 1, -1, -1) if _name(self[k]) == name)


def _name(item: Node | str) -> str:
    return item if isinstance(item, str) else item.name


def _close(open_: _Open, name: str) -> None:
    if not open_.names[name]:
        return
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].name == name:
            open_.cut(k)
            return
        if name in FORMATTING and open_[k].name in BLOCK:
            return  # an inline end tag does not end a block


def _close_paragraph(open_: _Open) -> None:
    if not open_.names["p"]:
        return
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].name == "p":
            open_.cut(k)
            return
        if open_[k].name in BLOCK:
            return


def _close_sibling(open_: _Open, names: set[str]) -> None:
    if not any(open_.names[n] for n in names):
        return
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].name in names:
            open_.cut(k)
            return
        if open_[k].name in FENCE:
            return


def _post_order(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.children)
    return order[::-1]


def measure(root: Node) -> list[Node]:
    """Sets counts and densities; nodes in post order."""
    nodes = _post_order(root)
    for node in nodes:
        if node.own is None:
            node.own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        chars, tags, link_chars, link_tags = node.own, 0, 0, 0
        for c in node.children:
            chars += c.chars
            tags += c.tags + 1
            link_chars += c.link_chars
            link_tags += c.link_tags
        node.chars, node.tags = chars, tags
        node.link_chars, node.link_tags = (chars, tags + 1) if node.name == "a" else (link_chars, link_tags)
    share = root.link_chars / root.chars if root.chars else 0.0
    for node in nodes:
        node.density = _density(node, share)
        node.total = sum(c.density for c in node.children)
    return nodes


def _density(node: Node, share: float) -> float:
    c, t, lc, lt = node.chars, node.tags or 1, node.link_chars, node.link_tags or 1
    if not c:
        return 0.0
    base = math.log(c / ((c - lc) or 1) * lc + share * c + math.e)
    value = c / (lc or 1) * t / lt
    return c / t * math.log(max(value, 1.0)) / math.log(base) if base > 1 else c / t * math.log(max(value, 1.0))


def core_of(nodes: list[Node]) -> Node:
    """The node whose children's densities sum highest; the first of equals. `nodes` in post order."""
    core = max(enumerate(nodes), key=lambda x: _worth(x[1], x[0]))[1]
    return core if core.total else nodes[-1]


def _worth(node: Node, order: int) -> tuple[float, float, int]:
    return node.total, node.density if not node.children else 0.0, -order


def _path(node: Node) -> list[Node]:
    path = [node]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def _named(nodes: list[Node]) -> Node | None:
    """The outermost article of a path or tree, else its outermost main; `nodes` from the inside out."""
    named = [n for n in nodes if n.article]
    return max(enumerate(named), key=lambda x: (x[1].name == "article", x[0]))[1] if named else None


def _linked(node: Node) -> bool:
    return 2 * node.link_chars > node.chars


def _runs(node: Node) -> list[tuple[list[int], Node]]:
    """Texts between the blocks of a node, inline elements among them: positions in parts, and their counts as one node."""
    found: list[tuple[list[int], Node]] = []
    at: list[int] = []
    for k, part in enumerate([*node.parts, None]):
        if part is not None and (isinstance(part, str) or part.name not in BLOCK):
            at.append(k)
            continue
        if any(isinstance(node.parts[i], str) and node.parts[i].strip() for i in at):
            run = Node("run", None)
            inside = [node.parts[i] for i in at if isinstance(node.parts[i], Node)]
            run.chars = sum(len("".join(node.parts[i].split())) for i in at if isinstance(node.parts[i], str)) + sum(n.chars for n in inside)
            run.tags = sum(n.tags + 1 for n in inside)
            run.link_chars, run.link_tags = sum(n.link_chars for n in inside), sum(n.link_tags for n in inside)
            found.append((at, run))
        at = []
    return found


def _drop(root: Node, leaves) -> bool:
    """Takes the topmost elements for which leaves() holds out of the tree; whether there were any."""
    any_left, stack = False, [root]
    while stack:
        node = stack.pop()
        gone = {id(c) for c in node.children if c.hint and leaves(c)}
        if gone:
            any_left = True
            node.children = [c for c in node.children if id(c) not in gone]
            node.parts = [part if id(part) not in gone else Node("hr", node) if part.name in BLOCK else "" for part in node.parts]
        stack.extend(node.children)
    return any_left


def without_hinted(root: Node) -> Node:
    """The tree without elements that are no main text by their class, id or being a form, unless they hold too much of it.

    Size protects no reader comments, and nothing beside an article: both go, however long, as long as there is other text.
    """
    nodes = measure(root)
    if not any(n.hint for n in nodes):
        return root
    around = set()  # what holds an article
    for n in nodes:
        if n.parent is not None and (id(n) in around or (n.article and n.hint != COMMENT)):
            around.add(id(n.parent))
    inside, below = {id(root): False}, {id(root): False}  # an article; reader comments
    for n in reversed(nodes[:-1]):
        inside[id(n)] = inside[id(n.parent)] or (n.parent.article and n.parent.hint != COMMENT)
        below[id(n)] = below[id(n.parent)] or n.parent.hint == COMMENT
    beside = {id(n) for n in nodes if around and not inside[id(n)] and id(n) not in around and not (n.article and n.hint != COMMENT)}
    comments = [n for n in nodes if n.hint == COMMENT and id(n) not in around and not below[id(n)]]
    if sum(n.chars - n.link_chars for n in comments) < root.chars - root.link_chars and _drop(root, lambda n: n.hint == COMMENT and id(n) not in around):
        nodes = measure(root)
    unlinked = root.chars - root.link_chars

    def little(chars):
        return chars <= HINT_SHARE * unlinked or (chars <= HINT_CHARS and chars < unlinked)

    if _drop(root, lambda n: n.hint in (WORD, COMMENT) and (id(n) in beside or little(n.chars - n.link_chars))):
        nodes = measure(root)
    path = {id(n) for n in _path(core_of(nodes))}
    _drop(root, lambda n: n.hint == PART and id(n) not in path and n.chars - n.link_chars <= PART_SHARE * unlinked)
    return root


def select(root: Node) -> Node:
    """The tree without the parts that are no main text."""
    nodes = measure(root)
    share = root.link_chars / root.chars if root.chars else 0.0
    core = core_of(nodes)
    inside = _named([n for n in _post_order(core) if n is not core])
    if inside is not None and _named(_path(core)) is None and 2 * (inside.chars - inside.link_chars) > core.chars - core.link_chars:
        core = inside
    path = _path(core)
    threshold = min(n.density for n in path)
    article = _named(path)
    enough = BESIDE_CORE * (core.total if core.children else core.density)

    best: dict[int, tuple[tuple[float, float, int], Node]] = {}  # of every subtree
    for k, node in enumerate(nodes):
        best[id(node)] = max([(_worth(node, k), node), *(best[id(c)] for c in node.children)], key=lambda x: x[0])
    on_path = {id(n) for n in path}
    kept = {id(core)}  # whole subtrees
    stack = [(root, False)]
    while stack:
        node, within = stack.pop()
        within |= node is article
        if id(node) in kept:
            continue
        if node.density >= threshold and id(node) not in on_path:
            top = best[id(node)][1]
            if within or (top.total if top.children else top.density) >= enough:
                kept.add(id(top))
                if id(node) in kept:
                    continue
        least = threshold if within else max(threshold, enough)
        whole = {k for at, run in _runs(node) if _density(run, share) >= least or (within and not _linked(run)) for k in at}
        parts: list[Node | str] = []
        for k, part in enumerate(node.parts):
            if k in whole or (isinstance(part, Node) and part.name == "hr"):
                parts.append(part)
            elif isinstance(part, str):
                parts.append(" ")
            elif within and part.density < threshold and not _linked(part) and id(part) not in on_path:
                parts.append(part)
            elif part.name == "h1" and part.density >= threshold and id(part) not in on_path:
                parts.append(part)  # a title may stand beside its text
            elif part.children or part.density >= threshold:
                parts.append(part)
                stack.append((part, within))
            else:
                parts.append(Node("hr", node) if part.name in BLOCK else " ")
        node.parts = parts
    if article is None:
        core.parts = [Node("hr", core) if _link_list(p, threshold) else p for p in core.parts]
    return root


def _link_list(part: Node | str, threshold: float) -> bool:
    return isinstance(part, Node) and part.name in BLOCK and part.name != "hr" and part.density < threshold and _linked(part) and part.link_tags > 1


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below node, in page order, white space normalised, empty ones left out."""
    found: list[str] = []
    run: list[str] = []

    def end() -> None:
        line = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if line:
            found.append(line)
        run.clear()

    stack: list = [iter([node])]
    leaving: list[bool] = []
    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if leaving and leaving.pop():
                end()
        elif isinstance(part, str):
            run.append(part)
        else:
            is_block = part.name in BLOCK
            if is_block:
                end()
            stack.append(iter(part.parts))
            leaving.append(is_block)
    end()
    return found


def main_text(page: str | None) -> str:
    return "\n".join(blocks(select(without_hinted(parse(page))))) if page else ""


def extract(pages: DataFrame, page: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The carried columns, text and n_chars (code points) of every page; other columns are left behind."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), "text string, n_chars bigint"])

    def work(rows, buf, at):
        texts = [main_text(x.as_py()) for x in rows.column(rows.schema.get_field_index(page))]
        kept = [rows.column(rows.schema.get_field_index(c)) for c in carry]
        return [*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return map_slices(pages.select(*carry, page), page, schema, work)
