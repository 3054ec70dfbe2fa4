"""HTML extraction by wrapper inference.

A page is read as a stream of tokens: block-level tags, and text with its inline markup. Streams of one
host and form (pages with text in an article or main element, and pages without) are aligned one after the other into a wrapper, a regular expression without unions: a text
that differs between pages becomes a slot, a run of like elements a repeated group, and elements
that only some pages have become optional groups. A page's texts are then read off by their slot.

A slot belongs to the main text unless its place says otherwise: elements for menus, headers, footers,
sidebars, forms, adverts, notices and comments (by tag, role, or a whole class or id name) are left out,
but not a generic container that holds the host's main elements or most of its varying text, nor a list of
other articles (``LISTED``) inside a main element that is text rather than links; where pages
have an article or main element only its inside counts; elsewhere the deepest container does
outside which all text is linked or left out, without the containers in it that hold links only;
and a text that all pages of a host and form share beside varying ones is template text, if there are
``TEMPLATE_PAGES`` pages that are no near copies of each other. Pages without text do not count.

Wrappers are inferred over all pages: each task aligns its pages into one wrapper per host and form, and those are
merged in rounds of ``FAN_IN`` tasks per group; a task that meets more than ``HOSTS`` of them passes several on. Extraction is a second narrow pass: wrappers are broadcast if their measured size is under
``BROADCAST_BYTES``, else joined by host, where adaptive execution splits a hot host.

Defined results: null and empty pages, and pages without text, have an empty text; a null url or
one without a host belongs to the host ""; repeated rows are rows of their own; markup that is never
closed ends with its parent; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import html as html_
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType

from cartlens.llm.common import byte_slices, fields, ship, strings, written

BATCH_BYTES = 1 << 20
FAN_IN = 16
#: Hosts whose wrappers a task holds before it passes them on.
HOSTS = 5_000
BROADCAST_BYTES = 8 << 20
#: Nested elements below this depth join their ancestor at it; their texts stay, and marked and main elements
#: among them are elements still, up to ``DEEPER`` more.
DEPTH = 100
DEEPER = 20
#: Largest table of an exact alignment of two child lists; longer lists are aligned greedily.
CELLS = 40_000
#: Pages, no two near copies, that a host must have before a text of all its pages counts as template text.
TEMPLATE_PAGES = 3
#: Pages are near copies from this similarity of their word pairs, estimated from so many smallest hashes.
COPY_LIKE = 0.3
COPY_HASHES = 32

# Element kinds.
RAW = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "svg", "math", "object"}
VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
DROPPED_TAGS = set("nav header footer aside form button select dialog menu head".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies dialog discussion disqus footer form gdpr header login masthead menu "
    "nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup "
    "promo promotion reactions recommended recommendations related replies respond responses search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
#: Words that beside dropped words do not change what a class or id names ("site-footer"); of these, OWN do so for a header.
OWN = set("article blog entry news post product story".split())
PLACES = OWN | set(
    "area bar block bottom box button buttons column container desktop facebook fixed floating global group icon icons inner "
    "item items js left level link links list lists local main mobile outer page panel primary right secondary section site "
    "sticky sub thread top user widgets wp wrap wrapper".split()
)
#: Names of comment lists, which are left out whatever they hold, and of lists beside the main text, which may hold articles.
COMMENTS = set("comment comments commentlist disqus reactions replies respond responses".split())
BESIDE = set(
    "ad ads advert adverts advertisement advertising adsense breadcrumb breadcrumbs menu nav navbar navigation promo promotion "
    "recommended recommendations related sidebar social sponsor sponsored teaser widget".split()
)
#: Of these, names of lists of other articles; inside a main element only those of linked text are left out.
LISTED = set("recommended recommendations related teaser".split())
#: Marks of elements that hold no main text: always; a header; unless they hold most of it; unless they hold it or a main element.
MARKS = "!^~?"
MAIN_TAGS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements in which main text may be looked for, and those that may be passed on the way to one.
CONTAINERS = {"html", "body", "div", "section", "form", "fieldset", "center", "td", "th"}
LAYOUT = {"table", "tbody", "tr"}
SCOPES = {"ul", "ol", "dl", "table", "tbody", "thead", "article", "section", "div", "body"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Za-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


class Node:
    """An element, or with the label "#" a text slot."""

    __slots__ = ("label", "kids", "many", "optional", "pages", "value", "chars", "linked", "blocks", "seen")

    def __init__(self, label: str):
        self.label, self.kids, self.many, self.optional, self.pages = label, [], False, False, 1
        self.value, self.chars, self.linked, self.blocks = None, 0, 0, []
        self.seen = []  #: of a root: sketches of pages that are no near copies, at most TEMPLATE_PAGES

    def dump(self) -> list:
        if self.label == "#":
            return ["#", self.many, self.optional, self.pages, self.value, self.chars, self.linked]
        return [self.label, self.many, self.optional, self.pages, [k.dump() for k in self.kids], *([self.seen] if self.seen else [])]

    @staticmethod
    def load(data: list) -> "Node":
        node = Node(data[0])
        node.many, node.optional, node.pages = data[1:4]
        if data[0] == "#":
            node.value, node.chars, node.linked = data[4:]
        else:
            node.kids = [Node.load(k) for k in data[4]]
            node.seen = data[5] if len(data) > 5 else []
        return node


def _mark(words: list[str]) -> str:
    """The mark of a class or id name: a name is one of an excluded kind as a whole, not by one of its words."""
    words = [w for w in words if len(w) > 1]
    dropped = DROPPED_WORDS.intersection(words)
    if not dropped or not (DROPPED_WORDS | PLACES).issuperset(words) or dropped == {"header"} and not OWN.isdisjoint(words):
        return ""
    return "!" if dropped & COMMENTS else "~" if dropped & BESIDE else "?"


def _label(tag: str, attributes: str) -> str:
    """Tag and the words of class, id and role, after a mark if the element is of a kind that holds no main text."""
    marks, words = {"^" if tag == "header" else "?" if tag == "form" else "!"} if tag in DROPPED_TAGS else set(), []
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
                marks.add("!")
            elif name == "role":
                if value.lower() in DROPPED_ROLES:
                    marks.add("?" if value.lower() == "form" else "!")
                words += ["main"] if value.lower() == "main" else []
            elif name in ("class", "id"):
                for part in value.split():
                    found = [w.lower() for w in _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", part))]
                    if not (tag == "header" and DROPPED_WORDS.intersection(found) == {"header"}):
                        marks.add("!" if tag == "header" and _mark(found) else _mark(found))
                    if not any(ch.isdigit() for ch in part):
                        words.append("-".join(found))
    name = ".".join([tag, *sorted(set(words))])
    mark = next((m for m in MARKS if m in marks), "")
    return name if tag in ("html", "body", *MAIN_TAGS) else mark + name


def _tag(label: str) -> str:
    return label.lstrip(MARKS).split(".", 1)[0]


def _is_listed(label: str) -> bool:
    named = DROPPED_WORDS.intersection(re.split("[.-]", label.lstrip(MARKS)))
    return bool(named) and named <= LISTED


def _is_main(label: str) -> bool:
    parts = label.lstrip(MARKS).split(".")
    return parts[0] in MAIN_TAGS or "main" in parts[1:] and parts[0] == "div"


def read(page: str) -> tuple[Node, list[str]]:
    """Element tree of block-level tags with text slots, and the texts in page order."""
    root = Node("")
    # open tags of every depth: tag, the element that takes the texts, its depth, whether it is left out for good
    stack, blocks, parts = [("", root, 0, False)], [], []
    opened: Counter[str] = Counter()
    linked, in_link, at, size = 0, False, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_.unescape("".join(parts)).split())
            if text:
                slot = Node("#")
                slot.value, slot.chars, slot.linked = zlib.crc32(text.encode("utf-8", "replace")), len(text), min(linked, len(text))
                slot.blocks = [len(blocks)]
                blocks.append(text)
                stack[-1][1].kids.append(slot)
            parts.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if in_link:
            linked += len(piece)

    def close(names: set[str], scopes: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                opened.subtract(e[0] for e in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in scopes:
                return

    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            text(page[at:])
            break
        if mark > at:
            text(page[at:mark])
        token = _TOKEN.match(page, mark)
        if not token:
            text("<")
            at = mark + 1
            continue
        at = token.end()
        if token[2] is None:  # comment or declaration
            continue
        closing, tag = token[1] == "/", token[2].lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW:
            if not closing and not token[0].endswith("/>"):
                end = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
                at = end.end() if end else size
            parts.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        in_link = False
        if closing:
            close({tag}, set())
            continue
        close({"p", *HEADINGS} if tag not in HEADINGS else {"p"}, SCOPES | {"li", "td", "th", "dd", "dt"})
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag], {"ul", "ol", "dl", "table"})
        node = Node(_label(tag, token[3]))
        _, above, depth, lost = stack[-1]
        kind = node.label[0] in MARKS or _is_main(node.label) or tag in HEADINGS and above.label[:1] == "^"
        if depth < DEPTH - 1 or kind and not lost and depth < DEPTH + DEEPER:
            above.kids.append(node)
            lost |= node.label[0] == "!"
            above, depth = node, depth + 1
        stack.append((tag, above, depth, lost))
        opened[tag] += 1
    flush()
    if not blocks:
        root.kids = []
    return root, blocks


def _alike(a: Node, b: Node) -> bool:
    """Whether two elements of one label may be the same place: they share a kind of child, or one is empty."""
    if not a.kids or not b.kids:
        return True
    return not {k.label for k in a.kids}.isdisjoint(k.label for k in b.kids)


def _pairs(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """Longest common order of like elements of two child lists (greedy, by label, for very long lists)."""
    x, y = [k.label for k in a], [k.label for k in b]
    if x == y and all(map(_alike, a, b)):
        return [(i, i) for i in range(len(x))]
    if len(x) * len(y) > CELLS:
        found, at = [], 0
        for i, label in enumerate(x):
            if label in y[at : at + 200]:
                at = y.index(label, at)
                found.append((i, at))
                at += 1
        return found
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            if x[i] == y[j] and _alike(a[i], b[j]):
                row[j] = below[j + 1] + 1
            else:
                row[j] = max(below[j], row[j + 1])
    found, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j] and best[i][j] == best[i + 1][j + 1] + 1 and _alike(a[i], b[j]):
            found.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return found


def align(a: Node, b: Node, same_page: bool = False) -> Node:
    """The expression of two nodes of one label: of two pages, or of neighbours in one page."""
    if not a.label and not (a.kids and b.kids):  # a page without text
        return a if a.kids else b
    out = Node(a.label)
    out.seen = _distinct(a.seen + b.seen) if a.seen and b.seen else a.seen or b.seen
    out.many, out.optional = a.many or b.many or same_page, a.optional or b.optional
    out.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    if a.label == "#":
        out.value = a.value if a.value == b.value else None
        out.chars, out.linked, out.blocks = a.chars + b.chars, a.linked + b.linked, a.blocks + b.blocks
        return out
    i = j = 0
    kids: list[Node] = []
    for p, q in [*_pairs(a.kids, b.kids), (len(a.kids), len(b.kids))]:
        for kid in [*a.kids[i:p], *b.kids[j:q]]:
            kid.optional = True
            kids.append(kid)
        if p < len(a.kids) and q < len(b.kids):
            kids.append(align(a.kids[p], b.kids[q], same_page))
        i, j = p + 1, q + 1
    out.kids = _folded(kids)
    return out


def _folded(kids: list[Node]) -> list[Node]:
    """Neighbours that are alike become one repeated group."""
    out: list[Node] = []
    for kid in kids:
        if out and out[-1].label == kid.label and _alike(out[-1], kid):
            out[-1] = align(out[-1], kid, same_page=True)
        else:
            out.append(kid)
    return out


def fold(node: Node) -> Node:
    node.kids = _folded([fold(k) if k.label != "#" else k for k in node.kids])
    return node


def _sketch(texts: list[str]) -> list[int]:
    """The smallest hashes of a page's word pairs."""
    found: set[int] = set()
    limit = 1 << 32
    for text in texts:
        words = text.split()
        for pair in zip(words, words[1:] or [""]):
            code = zlib.crc32(" ".join(pair).encode("utf-8", "replace"))
            if code < limit:
                found.add(code)
                if len(found) > 64 * COPY_HASHES:
                    found = set(sorted(found)[:COPY_HASHES])
                    limit = max(found)
    return sorted(found)[:COPY_HASHES]


def _distinct(sketches: list[list[int]]) -> list[list[int]]:
    """The first sketches that are no near copies of each other."""
    found: list[list[int]] = []
    for own in sketches:
        for other in found:
            whole = sorted({*own, *other})[:COPY_HASHES]
            if len({*whole}.intersection(own).intersection(other)) >= COPY_LIKE * len(whole):
                break
        else:
            found.append(own)
        if len(found) == TEMPLATE_PAGES:
            break
    return found


def page_form(page: str, sketched: bool = True) -> tuple[Node, list[str]]:
    """The folded tree of a page, with a sketch of its text if wanted, and its texts."""
    root, blocks = read(page)
    if sketched:
        _seen(root, blocks)
    return fold(root), blocks


def _seen(root: Node, blocks: list[str]) -> None:
    """Give an unfolded page with text its sketch."""
    if blocks:
        slots = list(_slots(root))
        has_main = any(inside and not out for _, out, inside in slots)
        own = [blocks[i] for s, out, inside in slots if not out and (inside or not has_main) for i in s.blocks]
        root.seen = [_sketch(own or blocks)]


def _slots(node: Node, pardoned: set[int] = frozenset(), above: bool = False, inside: bool = False) -> Iterator[tuple[Node, bool, bool]]:
    """Text slots with whether an ancestor is left out and whether one is an article or main element.

    ``pardoned`` are the marked elements (their ids) that are not left out; ``above`` is whether the node is in a left-out one.
    """
    own = above or node.label[:1] in (*MARKS,) and id(node) not in pardoned
    for kid in node.kids:
        if kid.label == "#":
            yield kid, own, inside
        else:  # the heading of an article may be in a header
            title = inside and node.label[:1] == "^" and _tag(kid.label) in HEADINGS
            yield from _slots(kid, pardoned, above if title else own, inside or _is_main(kid.label))


def has_article(node: Node, inside: bool = False) -> bool:
    """The form of a page: whether it has text in an article or main element outside headers, comments and lists beside the main text."""
    inside = inside or _is_main(node.label)
    return any(inside if k.label == "#" else k.label[0] not in "!^~" and has_article(k, inside) for k in node.kids)


class Wrapper:
    """The expression of a host's pages of one form, with what it says about slots."""

    def __init__(self, root: Node):
        self.root = root
        #: whether the host has enough pages, no near copies, for template text
        self.known = len(root.seen) >= TEMPLATE_PAGES
        self.pardoned = self._pardoned()
        self.pardoned_labels = {n.label for n in self._marked(root) if id(n) in self.pardoned}
        slots = list(_slots(root, self.pardoned))
        self.has_main = any(inside and not out for _, out, inside in slots)
        kept = [s for s, out, inside in slots if not out and (inside or not self.has_main)]
        varying = any(s.value is None for s in kept)
        #: slots of text that every page shares, although other main texts differ
        self.template = {
            id(s) for s in kept if varying and self._shared(s) and not s.many
        }
        self.kept = {id(s) for s in kept} - self.template
        if not self.has_main:
            self.kept &= {id(s) for s in self._dense(kept)}

    def _shared(self, slot: Node) -> bool:
        """Whether all pages of a host of several texts have the slot, with the same text."""
        return self.known and slot.value is not None and not slot.optional and slot.pages >= self.root.pages

    @classmethod
    def _marked(cls, node: Node) -> Iterator[Node]:
        """Marked elements that are not left out for good, nor inside one that is."""
        for kid in node.kids:
            if kid.label[0] in "~?":
                yield kid
            if kid.label[0] not in "#!^":
                yield from cls._marked(kid)

    def _pardoned(self) -> set[int]:
        """Marked generic containers that hold the host's main elements or most of its varying, unlinked text."""
        root = self.root
        marked = list(self._marked(root))
        if not marked:
            return set()
        every = {id(n) for n in marked}
        open_ = {id(s): inside for s, out, inside in _slots(root, every) if not out}
        kept_main = max((s.pages for s, out, inside in _slots(root) if inside and not out), default=0)

        def weight(node: Node, inside: bool) -> int:
            return sum(
                max(0, s.chars - 2 * s.linked)
                for s, _, _ in _slots(node)
                if open_.get(id(s)) in (True, inside) and not self._shared(s)
            )

        total = {inside: weight(root, inside) for inside in (False, True)}
        found: set[int] = set()

        def walk(node: Node, inside: bool) -> None:
            for kid in node.kids:
                if kid.label[0] in "#!^":
                    continue
                if kid.label[0] in "~?" and (inside or kept_main + kid.pages <= root.pages):
                    main = kid.label[0] == "?" and not inside and (_is_main(kid.label) or holds_main(kid))
                    told = inside and _is_listed(kid.label) and unlinked(kid)
                    if main or told or 2 * weight(kid, inside) > total[inside]:
                        found.add(id(kid))
                walk(kid, inside or _is_main(kid.label))

        def unlinked(node: Node) -> bool:
            slots = [s for s, _, _ in _slots(node)]
            return sum(s.chars for s in slots) > 2 * sum(s.linked for s in slots)

        def holds_main(node: Node) -> bool:
            return any(_is_main(k.label) or holds_main(k) for k in node.kids if k.label[0] not in "#!^~")

        walk(root, False)
        return found

    def _dense(self, kept: list[Node]) -> list[Node]:
        """Slots of the deepest container outside which all text is linked or left out, without its linked containers."""
        own = {id(s) for s in kept if id(s) in self.kept}

        def linked(node: Node) -> bool:
            """Whether a child's text is linked or left out."""
            slots = [node] if node.label == "#" else [s for s, _, _ in _slots(node)]
            return all(2 * s.linked > s.chars for s in slots if id(s) in own)

        node = last = self.root
        while True:
            heavy = [k for k in node.kids if not linked(k)]
            if len(heavy) != 1 or heavy[0].many or _tag(heavy[0].label) not in CONTAINERS | LAYOUT:
                break
            node = heavy[0]
            last = node if _tag(node.label) in CONTAINERS else last
        every = last is self.root and linked(last)  # a host of links only
        aside = [k for k in last.kids if not every and _tag(k.label) in CONTAINERS | LAYOUT and linked(k)]
        beside = {id(s) for k in aside for s, _, _ in _slots(k)}
        return [s for s, _, _ in _slots(last) if id(s) not in beside]

    def blocks(self, page: Node) -> list[int]:
        """Numbers of the page's texts that are main text."""
        found: list[int] = []
        matched: set[int] = set()
        pardoned: set[int] = set()
        work = [(self.root, page)]
        while work:
            own, other = work.pop()
            for i, j in _pairs(own.kids, other.kids):
                a, b = own.kids[i], other.kids[j]
                if a.label == "#":
                    matched.add(id(b))
                    if id(a) in self.kept:
                        found += b.blocks
                else:
                    matched.add(id(b))
                    if id(a) in self.pardoned:
                        pardoned.add(id(b))
                    work.append((a, b))
        if self.pardoned:
            pardoned |= {id(n) for n in Wrapper._marked(page) if id(n) not in matched and n.label in self.pardoned_labels}
        for slot, out, inside in _slots(page, pardoned):  # texts the alignment left over are judged by their place
            if id(slot) not in matched and not out and (inside or not self.has_main):
                found += slot.blocks
        return sorted(found)


def host_of(url):
    """Lower-case host of an address column, "" where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host: ``_host`` and ``_wrappers``, a map from the form (see ``has_article``) to JSON, inferred over all its pages."""
    ship(pages.sparkSession)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            for run in byte_slices(batch, "_html", BATCH_BYTES):
                for host, page in zip(run.column("_host").to_pylist(), strings(run, "_html")):
                    form, blocks = read(page)
                    key = host, has_article(form)
                    if key not in held or len(held[key].seen) < TEMPLATE_PAGES:
                        _seen(form, blocks)
                    form = fold(form)
                    _forget(form)
                    held[key] = align(held[key], form) if key in held else form
                if len(held) > HOSTS:
                    yield dumped(held, part)
                    held = {}
        if held:
            yield dumped(held, part)

    def dumped(held: dict[tuple[str, bool], Node], part: int) -> pa.RecordBatch:
        texts = [json.dumps(n.dump(), separators=(",", ":")) for n in held.values()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _ in held], pa.string()),
                pa.array([f for _, f in held], pa.bool_()),
                pa.array([part] * len(held), pa.int32()),
                pa.array(texts, pa.string()),
            ],
            names=["_host", "_form", "_part", "_wrapper"],
        )

    def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        forms = [Node.load(json.loads(w)) for w in sorted(rows["_wrapper"])]
        whole = forms[0]
        for form in forms[1:]:
            whole = align(whole, form)
        text = json.dumps(whole.dump(), separators=(",", ":"))
        return pd.DataFrame({"_host": [key[0]], "_form": [key[1]], "_part": [key[2]], "_wrapper": [text]})

    source = pages.select(host_of(F.col(url_col)).alias("_host"), F.col(html_col).alias("_html"))
    kind = "_host string, _form boolean, _part int, _wrapper string"
    keys = ["_host", "_form", "_part"]
    found = written(source.mapInArrow(own, kind), "wrappers")
    parts = (found.agg(F.max("_part")).first()[0] or 0) + 1
    while parts > 1:
        parts = -(-parts // FAN_IN)
        group = F.floor(F.col("_part") / FAN_IN).cast("int")
        found = found.withColumn("_part", group).groupBy(*keys).applyInPandas(merged, kind)
    # several rows of a host from one task
    found = found.withColumn("_part", F.lit(0)).groupBy(*keys).applyInPandas(merged, kind)
    # at most two forms of a host
    forms = F.map_from_entries(F.collect_list(F.struct("_form", "_wrapper")))
    return written(found.groupBy("_host").agg(forms.alias("_wrappers")), "hosts")


def _forget(node: Node) -> None:
    for slot, _, _ in _slots(node):
        slot.blocks = []


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, main ``text`` and ``n_chars``."""
    wrappers = infer_wrappers(pages, url_col, html_col)
    sizes = F.aggregate(F.map_values("_wrappers"), F.lit(0).cast("long"), lambda total, w: total + F.octet_length(w))
    small = (wrappers.agg(F.sum(sizes)).first()[0] or 0) <= BROADCAST_BYTES
    sized = pages.select(id_col, url_col, F.col(html_col).alias("_html"), host_of(F.col(url_col)).alias("_host"))
    joined = sized.join(F.broadcast(wrappers) if small else wrappers, "_host", "left")
    schema = fields(joined, [id_col, url_col], [("text", StringType()), ("n_chars", LongType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            for run in byte_slices(batch, "_html", BATCH_BYTES):
                out = []
                for page, forms in zip(strings(run, "_html"), run.column("_wrappers").to_pylist()):
                    own, blocks = page_form(page, sketched=False)
                    form = dict(forms)[has_article(own)]
                    if form not in known:
                        if len(known) > HOSTS:
                            known = {}
                        known[form] = Wrapper(Node.load(json.loads(form)))
                    out.append(" ".join(blocks[i] for i in known[form].blocks(own)))
                yield pa.RecordBatch.from_arrays(
                    [run.column(id_col), run.column(url_col), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                    names=schema.names,
                )

    return joined.select(id_col, url_col, "_html", "_wrappers").mapInArrow(texts, schema)
