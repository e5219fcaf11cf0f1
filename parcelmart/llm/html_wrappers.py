"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of block tags (name, class, id and role without digits) and
text slots; inline tags stay inside their block's text. The streams of a host are
aligned one after the other into one union-free regular expression, its
wrapper: equal tags are matched in order, a tag that only one side has becomes
optional, siblings or groups of siblings that follow each other become a
repeated group, and texts that differ become a slot. Wrappers of parts of
a host are aligned the same way, so a host is inferred where its pages lie, then
part by part; only wrappers travel, whose sequences hold at most MAX_SIBLINGS
siblings and whose texts are short or a digest. A page's elements are read to any depth; below MAX_DEPTH
the wrapper keeps of each only whether it is dropped, main text or neither.

Every slot counts its characters, those inside links, its pages, and the texts all of
these have in common. Slots are then told apart once per host, by the same rules for any number of pages. Where tags
speak for main text, a text in common is left out only if it is short and a word of it speaks against it too, such as
`share` or `subscribe`, and never in headings; an article's sentence that all pages of the host have stays. Where none
do, slots that never change are left out before the first and after the last slot that varies.
Alike siblings in a row share one slot, so a text is common there if every page's run has it. A slot of
links is no main text unless tags speak for it. Tags and names are evidence on slots: those below menus,
headers, footers, sidebars, notices, adverts, forms or comments are dropped. A class word alone drops
no element that holds most of the host's varying text and the best tags, unless it
names comments; words after `has`, `with` and the like say what else is on the page and drop nothing. Of the
others those below an article come first, then those below a main
element, then those below an element named like one, then any other.

A page is read by aligning it with its host's wrapper, level by level: siblings go to
the positions of the expression in an order it accepts, and where several ways are
left, to those whose constants and members agree best. The main text is what
lies in the page's best slots, less the template's texts.

Defined results: a null or empty page, or one without main text, has the empty
text; a null or odd url belongs to the empty host; unclosed and stray tags are repaired
as browsers do; repeated rows are separate pages; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import parallelism, stage

# Siblings a wrapper lists in order; longer sequences become one repeated group of optional members.
MAX_SIBLINGS = 24
# Elements nested deeper are stored below the innermost one above, side by side and by what they are evidence of.
MAX_DEPTH = 100
# Longer constant texts are kept as a digest.
TEXT_KEPT = 60
# Wrappers a task holds before it hands them on.
HELD_HOSTS = 2000
# Parts a host's wrappers are first merged in.
HOST_PARTS = 32
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "dt", "th", "caption", "legend", "figcaption"}

# Elements of HTML.
BLOCKS = set(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript"
    " ol optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul".split()
)
BREAKS = {"br", "hr", "wbr"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "svg", "math"}
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
KEEPS_P = {"button", "canvas", "option", "optgroup", "noscript", "template", "body", "html", "head"}
DROPPED_TAGS = set("head nav footer aside form button select dialog menu noscript template fieldset search".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DROPPED_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising adbox sponsor sponsored promo promotion promotions banner menu menus nav"
    " navbar navigation navi breadcrumb breadcrumbs sidebar side aside footer foot masthead topbar cookie cookies consent gdpr notice"
    " notices notification alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus reply"
    " replies respond discussion share sharing social related recommended recommendations widget widgets toolbar pager pagination search skip"
    " copyright legal disclaimer teaser teasers".split()
)
# Words that drop an element whatever it holds.
COMMENT_WORDS = set("comment comments disqus reply replies respond discussion".split())
# The next word names what an element has or lacks, not what it is.
LAYOUT_WORDS = {"has", "have", "with", "without", "no", "not", "hide", "hides", "show", "shows"}
# Words that drop an element outside of the main text only.
HEAD_WORDS = {"header", "head", "top"}
MAIN_WORDS = {"article", "content", "main", "post", "entry", "story"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</(?P<end>[a-zA-Z][^\s>/]*+)[^>]*+>"
    r"|<(?P<tag>[a-zA-Z][^\s>/]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(?P<odd>[a-zA-Z][^\s>/]*+)(?P<rest>[^>]*+)>",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([a-zA-Z-]+)")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGEST = re.compile("[0-9a-f]{40}")


def host(url: str = "url") -> Column:
    """The lower-case host of a column of urls."""
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def _signature(tag: str, attrs: str) -> str:
    """tag, then class, id and role words (digits dropped), and `!` if the element is not shown."""
    if not attrs.strip():
        return tag
    found = {}
    for name, *values, bare in _ATTR.findall(attrs):
        found.setdefault((name or bare).lower(), entities.unescape("".join(values)))
    named = [w for key in ("class", "id") for w in re.sub(r"\d+", "", found.get(key, "")).split()]
    role = found.get("role", "").strip().lower()
    unseen = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    clean = [re.sub(r"[/.@!#\s]", "-", w) for w in named]
    return tag + "".join(f".{w}" for w in sorted(set(clean))) + (f"@{role}" if role else "") + "!" * unseen


class Deeper:
    """What the elements below MAX_DEPTH down to one are evidence of."""

    def __init__(self, above: Deeper | None, tag: str, signature: str):
        inside, outside = standing(2, signature), standing(1, signature)
        kind, words = (above.kind, above.words) if above else (0, frozenset())
        self.dropped = not inside or bool(above and above.dropped)
        # Dropped unless an element above MAX_DEPTH is main text.
        self.head = bool(above and above.head) or not (outside or kind)
        self.kind = max(kind, inside if inside > 2 else 2 if outside == 2 else 0)
        self.words = words | dropping_words(signature)
        self.tag = "div" if tag in ("article", "main", "header", "html", "body") else tag

    def signature(self) -> str:
        """One element that is evidence of the same."""
        if self.dropped:
            return "nav"
        classes = sorted(self.words | ({"content"} if self.kind == 2 else set()))
        role = {3: "@main", 4: "@article"}.get(self.kind, "")
        return ("header" if self.head else self.tag) + "".join(f".{w}" for w in classes) + role


class Page:
    """The tree of blocks: [signature, children], texts as ["#", text or digest, text, characters inside links]."""

    def __init__(self, source: str | None):
        self.tree: list = ["", []]
        # Open elements: name, node and, below MAX_DEPTH, their evidence.
        self.open: list[tuple[str, list, Deeper | None]] = [("", self.tree, None)]
        # Places of the open elements by name.
        self.places: dict[str, list[int]] = {}
        self.text: list[str] = []
        self.links, self.linked = 0, 0
        self._read(source or "")

    def _read(self, source: str) -> None:
        at = 0
        while found := _TOKEN.search(source, at):
            self._words(source[at : found.start()])
            at = found.end()
            tag = (found["tag"] or found["odd"] or "").lower()
            if tag:
                self._start(tag, found["attrs"] or found["rest"] or "")
                if tag in RAW and not (tag in ("svg", "math") and found[0].endswith("/>")):
                    closing = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                    at = closing.start() if closing else len(source)
            elif found["end"]:
                self._end(found["end"].lower())
        self._words(source[at:])
        self._flush()

    def _words(self, raw: str) -> None:
        if raw:
            text = entities.unescape(raw)
            self.text.append(text)
            if self.links:
                self.linked += len("".join(text.split()))

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            kept = text if len(text) <= TEXT_KEPT else hashlib.sha1(text.encode("utf-8", "surrogatepass")).hexdigest()
            _, node, deeper = self.open[-1]
            if deeper:
                shared = self.open[MAX_DEPTH - 1][1][1]
                if not shared or shared[-1] is not node:
                    # Text after an inner element begins a new node, so texts keep their order.
                    node = [deeper.signature(), []]
                    shared.append(node)
                    self.open[-1] = (self.open[-1][0], node, deeper)
            node[1].append(["#", kept, text, self.linked])
        self.text, self.linked = [], 0

    def _pop(self, upto: int) -> None:
        self._flush()
        for name, _, _ in reversed(self.open[upto:]):
            self.places[name].pop()
        del self.open[upto:]

    def _last(self, names) -> int:
        """The place of the innermost open element with one of the names, or 0."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def _start(self, tag: str, attrs: str) -> None:
        if tag in BREAKS:
            self.text.append(" ")
            return
        if tag == "a":
            self.links = 1
        if tag not in BLOCKS:
            return
        if tag in ("html", "body") and self._last((tag,)):
            return
        if tag in CLOSED_BY:
            closing, until = CLOSED_BY[tag]
            floor = self._last(until)
            lists = [self.places.get(n, []) for n in closing]
            same = [at[k] for at in lists if (k := bisect_right(at, floor)) < len(at)]
            if same:
                self._pop(min(same))
        elif tag not in KEEPS_P:
            open_p = self._last(("p",))
            if open_p > self._last(("button", "td", "th", "caption", "table")):
                self._pop(open_p)
        self._flush()
        signature = _signature(tag, attrs)
        node: list = [signature, []]
        deeper = Deeper(self.open[-1][2], tag, signature) if len(self.open) >= MAX_DEPTH else None
        if not deeper:
            self.open[-1][1][1].append(node)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, node, deeper))

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        elif tag in BLOCKS and tag not in ("html", "body"):
            at = self._last((tag,))
            if at:
                self._pop(at)
        elif tag == "br":
            self.text.append(" ")


# A wrapper's node is [signature, quantifier, children]: quantifier "", "?", "+" or "*", signature "()" for a
# repeated group. A text is ["#", quantifier, its content or null if it varies, [characters, characters in links,
# pages], texts that all of these pages have here].


def of_page(node: list) -> list:
    """The wrapper that accepts one page."""
    if node[0] == "#":
        return ["#", "", node[1], [len(node[2]), node[3], 1], [node[1]]]
    return [node[0], "", _reduced([of_page(child) for child in node[1]])]


def _key(node: list) -> str:
    """What makes nodes alike: the signature, for groups those of their members."""
    return "(" + " ".join(_key(child) for child in node[2]) + ")" if node[0] == "()" else node[0]


def _often(a: str, b: str, repeated: bool = False) -> str:
    optional = "?" in a + b or "*" in a + b
    many = repeated or "+" in a + b or "*" in a + b
    return ("*" if many else "?") if optional else ("+" if many else "")


def merged(a: list, b: list, repeated: bool = False, same: bool = False) -> list:
    """The wrapper that accepts what either of two alike nodes does, or both in a row; `same` if both are of the same pages."""
    often = _often(a[1], b[1], repeated)
    if a[0] != "#":
        return [a[0], often, aligned(a[2], b[2], same)]
    (chars, linked, pages), (more, more_linked, others) = a[3], b[3]
    if same:
        # What only the rarer one has is not on all pages.
        common = {t for node in (a, b) if node[3][2] == max(pages, others) for t in node[4]}
    else:
        common = set(a[4]) & set(b[4])
    counts = [chars + more, linked + more_linked, max(pages, others) if same else pages + others]
    return ["#", often, a[2] if a[2] == b[2] else None, counts, sorted(common)]


def aligned(xs: list, ys: list, same: bool = False) -> list:
    """Match alike nodes in order as often as possible; the others become optional."""
    kx, ky = [_key(x) for x in xs], [_key(y) for y in ys]
    if kx == ky:
        return [merged(x, y, same=same) for x, y in zip(xs, ys, strict=True)]
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs) - 1, -1, -1):
        for j in range(len(ys) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if kx[i] == ky[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    maybe = lambda node: [node[0], _often(node[1], "?"), *node[2:]]
    while i < len(xs) or j < len(ys):
        if i < len(xs) and j < len(ys) and kx[i] == ky[j]:
            out.append(merged(xs[i], ys[j], same=same))
            i, j = i + 1, j + 1
        elif j == len(ys) or (i < len(xs) and best[i + 1][j] >= best[i][j + 1]):
            out.append(maybe(xs[i]))
            i += 1
        else:
            out.append(maybe(ys[j]))
            j += 1
    return _reduced(out)


def _reduced(nodes: list) -> list:
    """Fold what repeats in a row; a sequence that stays too long becomes a group of optional members."""
    for size in range(1, 5):
        at = 0
        while at + 2 * size <= len(nodes):
            first, second = nodes[at : at + size], nodes[at + size : at + 2 * size]
            if [_key(x) for x in first] != [_key(x) for x in second]:
                at += 1
                continue
            if size == 1:
                nodes = [*nodes[:at], merged(first[0], second[0], True, True), *nodes[at + 2 :]]
            else:
                group = ["()", "+", [merged(x, y, same=True) for x, y in zip(first, second, strict=True)]]
                while [_key(x) for x in nodes[at + 2 * size : at + 3 * size]] == [_key(x) for x in first]:
                    group[2] = [merged(x, y, same=True) for x, y in zip(group[2], nodes[at + 2 * size : at + 3 * size], strict=True)]
                    del nodes[at + 2 * size : at + 3 * size]
                nodes = [*nodes[:at], group, *nodes[at + 2 * size :]]
    if len(nodes) > MAX_SIBLINGS:
        members: dict[str, list] = {}
        for node in _flat(nodes):
            members[node[0]] = merged(members[node[0]], node, same=True) if node[0] in members else node
        nodes = [["()", "+", [[n[0], _often(n[1], "?"), *n[2:]] for _, n in sorted(members.items())]]]
    return nodes


def _flat(nodes: list) -> Iterator[list]:
    for node in nodes:
        if node[0] == "()":
            yield from _flat(node[2])
        else:
            yield node


def as_text(node: list) -> str:
    """The wrapper as a regular expression over tags, texts and slots."""
    signature, often, inside = node[:3]
    if signature == "#":
        return ("#" if inside is None else json.dumps(inside, ensure_ascii=False)) + often
    inner = " ".join(as_text(child) for child in inside)
    if signature == "()":
        return f"({inner}){often}"
    return f"{signature}[{inner}]{often}" if signature else inner


class Wrapper:
    """A host's wrapper and the number of its pages."""

    def __init__(self, pages: int = 0, tree: list | None = None):
        self.pages, self.tree = pages, tree

    def add(self, other: Wrapper) -> None:
        self.pages += other.pages
        self.tree = other.tree if self.tree is None else merged(self.tree, other.tree)

    @classmethod
    def of(cls, page: Page) -> Wrapper:
        return cls(1, of_page(page.tree))

    def dumps(self) -> str:
        return json.dumps([self.pages, self.tree], ensure_ascii=False)

    @classmethod
    def loads(cls, text: str) -> Wrapper:
        return cls(*json.loads(text))

    def main_paths(self) -> list:
        """The wrapper with ["#", quantifier, content or null, rank, the template's texts] for texts.

        Ranks are 4 article, 3 main, 2 named so, 1 any other slot, 0 what is left out.
        """
        ranks: dict[int, int] = {}
        slots: list[tuple[list, str]] = []
        # Per slot the elements around it that a word would drop, from the outermost on.
        doubted: dict[int, tuple[int, ...]] = {}
        elements: dict[int, str] = {}

        def walk(node: list, rank: int, holder: str, around: tuple[int, ...]) -> None:
            for child in node[2]:
                if child[0] == "#":
                    slots.append((child, holder))
                    ranks[id(child)], doubted[id(child)] = rank, around
                elif child[0] == "()":
                    walk(child, rank, holder, around)
                else:
                    within = (*around, id(child)) if dropping_words(child[0]) else around
                    if within != around:
                        elements[id(child)] = child[0]
                    walk(child, standing(rank, child[0]), re.split("[.@!]", child[0])[0], within)

        walk(self.tree, 1, "", ())
        varies = any(slot[2] is None for slot, _ in slots)
        for slot in self._dropped([slot for slot, _ in slots], ranks, doubted, elements, varies):
            ranks[slot] = 0
        for slot, _ in slots:
            if ranks[id(slot)] == 1 and slot[3][1] * 2 > slot[3][0]:
                ranks[id(slot)] = 0
        most = max((slot[3][2] for slot, _ in slots if ranks[id(slot)] > 1), default=0)
        varying = [k for k, (slot, _) in enumerate(slots) if ranks[id(slot)] == 1 and slot[2] is None]
        decided = {}
        for k, (slot, holder) in enumerate(slots):
            rank, template = ranks[id(slot)], []
            # What one page says again and again is no template.
            if rank == 1 and self.pages > 1 and varying and not varying[0] <= k <= varying[-1]:
                rank = 0
            if rank > 1 and self.pages > 1 and varies and slot[3][2] == most and holder not in HEADINGS:
                template = [text for text in slot[4] if not _DIGEST.fullmatch(text) and {w.lower() for w in _WORD.findall(text)} & DROPPED_WORDS]
            decided[id(slot)] = [rank, template]

        def rewritten(node: list) -> list:
            if node[0] == "#":
                return [*node[:3], *decided[id(node)]]
            return [node[0], node[1], [rewritten(child) for child in node[2]]]

        return _slim(rewritten(self.tree))

    @staticmethod
    def _dropped(slots: list, ranks: dict, doubted: dict, elements: dict, varies: bool) -> list[int]:
        """The slots inside elements that a class word drops."""
        text = {id(s): (s[3][0] - s[3][1]) * (s[2] is None or not varies) for s in slots if ranks[id(s)]}
        inside: dict[int, int] = dict.fromkeys(elements, 0)
        for slot, chars in text.items():
            for element in doubted[slot]:
                inside[element] += chars
        # Elements from the outermost on, so at most a chain of them holds most of the text.
        whole = sum(text.values())
        large = [e for e, chars in inside.items() if chars * 2 > whole and not dropping_words(elements[e]) & COMMENT_WORDS]
        kept: set[int] = set()
        for element in large:
            best, others = 0, 0
            for slot, chars in text.items():
                if chars and element in doubted[slot] and not set(doubted[slot]) - set(large):
                    best = max(best, ranks[slot])
                elif chars and element not in doubted[slot] and not set(doubted[slot]) - kept:
                    others = max(others, ranks[slot])
            if best > others or best == others == 1:
                kept.add(element)
        return [id(slot) for slot in slots if set(doubted[id(slot)]) - kept]


def _slim(node: list) -> list:
    """Without members of elements that hold no main text and that their signature alone tells from their siblings."""
    if node[0] == "#":
        return node
    times = Counter(child[0] for child in _flat(node[2]))

    def cut(child: list) -> list:
        if child[0] == "()":
            return ["()", child[1], [cut(x) for x in child[2]]]
        child = _slim(child)
        return child if child[0] == "#" or times[child[0]] > 1 or _holds(child) else [*child[:2], []]

    return [node[0], node[1], [cut(child) for child in node[2]]]


def _holds(node: list) -> bool:
    return node[3] > 0 if node[0] == "#" else any(_holds(child) for child in node[2])


def standing(rank: int, signature: str) -> int:
    """The rank below an element: 0 for what is not main text, 4 article, 3 main, 2 named like one, else as above it."""
    if not rank:
        return 0
    named, _, role = signature.rstrip("!").partition("@")
    tag, *classes = named.split(".")
    words = {w.lower() for name in classes for w in _WORD.findall(name)}
    if signature.endswith("!") or tag in DROPPED_TAGS or role in DROPPED_ROLES:
        return 0
    if rank == 1 and (tag == "header" or tag not in ("html", "body", "main", "article") and words & HEAD_WORDS and not words & MAIN_WORDS):
        return 0
    if tag == "article" or role == "article":
        return 4
    if tag == "main" or role == "main":
        return max(rank, 3)
    return max(rank, 2) if words & MAIN_WORDS and tag not in ("html", "body") else rank


def dropping_words(signature: str) -> set[str]:
    """Words of an element's class and id that speak against main text."""
    tag, *classes = signature.rstrip("!").partition("@")[0].split(".")
    if tag in ("html", "body", "main"):
        return set()
    out = set()
    for name in classes:
        words = [w.lower() for w in _WORD.findall(name)]
        out |= {w for before, w in zip(["", *words], words, strict=False) if w in DROPPED_WORDS and before not in LAYOUT_WORDS}
    return out


class Expression:
    """The sequence of a wrapper's element, to give each child of a page's element its position."""

    REFUSED = 1e6

    def __init__(self, nodes: list):
        # Positions: the node, and (sequence, place in it) from the outermost sequence to the group that holds it.
        self.nodes: list[list] = []
        self.paths: list[tuple[tuple[int, int], ...]] = []
        # Per sequence how many members before each place must occur, and whether it is a group that repeats.
        self.needed: list[list[int]] = []
        self.loops: list[bool] = []
        self._number(nodes, (), False)
        self.at: dict[str, list[int]] = {}
        for k, node in enumerate(self.nodes):
            self.at.setdefault(node[0], []).append(k)
        self.plain = len(self.at) == len(self.nodes)
        self.inner = [None if node[0] == "#" else Expression(node[2]) for node in self.nodes]
        self.musts = {node[0] for node in self.nodes if node[1] in ("", "+")} if all(len(p) == 1 for p in self.paths) else set()
        self.steps: dict[tuple[int, int], bool] = {}

    def _number(self, nodes: list, path: tuple, loops: bool) -> bool:
        """Whether the sequence can be empty."""
        own = len(self.needed)
        self.needed.append([0])
        self.loops.append(loops)
        for k, node in enumerate(nodes):
            here, may_lack = (*path, (own, k)), node[1] in ("?", "*")
            if node[0] == "()":
                may_lack |= self._number(node[2], here, node[1] in ("+", "*"))
            else:
                self.nodes.append(node)
                self.paths.append(here)
            self.needed[own].append(self.needed[own][-1] + (not may_lack))
        return not self.needed[own][-1]

    def _open(self, path: tuple) -> bool:
        """Whether a match can begin with the end of the path."""
        return all(self.needed[s][k] == 0 for s, k in path)

    def _shut(self, path: tuple) -> bool:
        """Whether a match can stop with the end of the path."""
        return all(self.needed[s][-1] == self.needed[s][k + 1] for s, k in path)

    def _follows(self, p: int, q: int) -> bool:
        known = self.steps.get((p, q))
        if known is None:
            known = self.steps[p, q] = self._can_follow(p, q)
        return known

    def _can_follow(self, p: int, q: int) -> bool:
        one, two = self.paths[p], self.paths[q]
        same = next((d for d, (a, b) in enumerate(zip(one, two, strict=False)) if a != b), len(one))
        if p == q and self.nodes[p][1] in ("+", "*"):
            return True
        if p != q:
            (s, i), (_, j) = one[same], two[same]
            between = self.needed[s][j] - self.needed[s][i + 1] if i < j else 1
            if not between and self._shut(one[same + 1 :]) and self._open(two[same + 1 :]):
                return True
        return any(self.loops[one[d][0]] and self._shut(one[d:]) and self._open(two[d:]) for d in range(1, min(same, len(one) - 1) + 1))

    def _fit(self, k: int, child: list) -> float:
        node = self.nodes[k]
        if node[0] == "#":
            return 0 if node[2] is None else 1 if node[2] == child[1] else -100
        has = {x[0] for x in child[1]}
        return -100 * len(has - self.inner[k].at.keys()) - 10 * len(self.inner[k].musts - has)

    def positions(self, children: list) -> list[int | None]:
        if self.plain:
            return [self.at.get(child[0], [None])[0] for child in children]
        # The best way up to each position that the last child can have.
        ways: dict[int, float] = {}
        back: list[dict[int, int | None]] = []
        for child in children:
            known = self.at.get(child[0])
            if not known:
                back.append({})
                continue
            now, came = {}, {}
            for q in known:
                if ways:
                    score, came[q] = max((w - self.REFUSED * (not self._follows(p, q)), -p) for p, w in ways.items())
                    came[q] = -came[q]
                else:
                    score, came[q] = -self.REFUSED * (not self._open(self.paths[q])), None
                now[q] = score + self._fit(q, child)
            ways = now
            back.append(came)
        out: list[int | None] = []
        last = max(((w - self.REFUSED * (not self._shut(self.paths[p])), -p) for p, w in ways.items()), default=None)
        at = None if last is None else -last[1]
        for came in reversed(back):
            out.append(at if came else None)
            at = came[at] if came else at
        return out[::-1]

    def slots(self, children: list) -> Iterator[tuple[int, str]]:
        """Rank and text of what the page's children say, less the template's texts."""
        for child, k in zip(children, self.positions(children), strict=True):
            if k is None:
                continue
            if child[0] != "#":
                yield from self.inner[k].slots(child[1])
            elif child[1] not in self.nodes[k][4]:
                yield self.nodes[k][3], child[2]


def main_text(page: Page, decided: list | Expression) -> str:
    known = decided if isinstance(decided, Expression) else Expression(decided[2])
    found = list(known.slots(page.tree[1]))
    best = max((rank for rank, _ in found), default=0)
    return " ".join(text for rank, text in found if best and rank == best)


HOSTS = "host string, part int, wrapper string"


def wrappers(pages: DataFrame) -> DataFrame:
    """One row (host, wrapper) per host of pages (url, html)."""

    def out(rows):
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        kinds = [pa.string(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "part", "wrapper"])

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % HOST_PARTS
        held: dict[str, Wrapper] = {}
        for batch in batches:
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                held.setdefault(name, Wrapper()).add(Wrapper.of(Page(source)))
                if len(held) > HELD_HOSTS:
                    yield out([(h, part, w.dumps()) for h, w in held.items()])
                    held = {}
        yield out([(h, part, w.dumps()) for h, w in held.items()])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, wrapper = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["host"], row["part"]) != last:
                    if last is not None:
                        yield out([(*last, wrapper.dumps())])
                    last, wrapper = (row["host"], row["part"]), Wrapper()
                wrapper.add(Wrapper.loads(row["wrapper"]))
        if last is not None:
            yield out([(*last, wrapper.dumps())])

    found = pages.select(host().alias("host"), "html").mapInArrow(infer, HOSTS)
    spread = parallelism(pages.sparkSession)
    # Equal wrappers need no order, and any order of different ones accepts the same pages.
    by_part = found.repartition(spread, "host", "part").sortWithinPartitions("host", "part", "wrapper").mapInArrow(join, HOSTS)
    whole = by_part.withColumn("part", F.lit(0)).repartition(spread, "host").sortWithinPartitions("host", "wrapper")
    return whole.mapInArrow(join, HOSTS).select("host", "wrapper")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""
    known = stage(wrappers(pages), "wrappers")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [json.dumps(Wrapper.loads(w).main_paths(), ensure_ascii=False) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], names=["host", "paths"])

    decided = stage(known.mapInArrow(decide, "host string, paths string"), "main-paths")
    slim = pages.select("page_id", "url", "html", host().alias("host"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[str, Expression] = {}
        for batch in batches:
            texts = []
            for source, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True):
                if paths not in loaded:
                    if len(loaded) > HELD_HOSTS:
                        loaded.clear()
                    loaded[paths] = Expression(json.loads(paths)[2])
                texts.append(main_text(Page(source), loaded[paths]))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    id_type = dict(pages.dtypes)["page_id"]
    joined = slim.join(decided, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(read, f"page_id {id_type}, url string, text string, n_chars long")
