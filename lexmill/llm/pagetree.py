"""A page as a tree: which elements it has, what text they hold, and which of them are part of its article.

The reader follows the standard's rules for optional tags as far as text depends
on them. It never recurses and reads every character a bounded number of times,
so that neither deep nor long pages cost more than their length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*+)|[!?/])")
_ATTRIBUTES = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^\W\d_]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open paragraph.
ENDS_P = BLOCKS - frozenset("html body caption tbody td tfoot th thead tr".split())
#: Nothing inside one of these closes what is open outside it.
BOUNDS = ("table", "td", "th", "caption", "button", "object", "template")
#: What a new element of the name ends, if it is open within the nearest of the bounds.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr",), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "thead": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
TABLE_PARTS = frozenset("tbody thead tfoot tr td th caption".split())
HEAD = frozenset("head base link meta noscript script style template title".split())

#: Elements that never hold text of an article.
NO_TEXT = frozenset("head script style title noscript template svg iframe noembed noframes object canvas audio video map button select textarea option datalist input".split())
#: Elements beside the article, unless it is inside them.
BESIDE = frozenset("nav aside footer menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of a class or id that name what is no part of an article.
MARKS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertisements advertising adsense alert banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookiebanner cookiebar cookies disclaimer discussion disqus footer gdpr login "
    "masthead mainnav menu menubar modal nav navbar navigation newsletter notice notices notification notifications overlay pager pagination popup promo promotion recommendation recommendations recommended related replies respond search share sharing "
    "sidebar sidenav signup skip social sponsor sponsored submenu subnav subscribe subscription teaser teasers toolbar topbar topnav widget widgets".split()
)
HEADER_NAMES = frozenset("header site-header page-header global-header main-header top-header".split())
#: Marks by which an article is none: a comment, a teaser.
NO_ARTICLE = frozenset("ad ads advert advertisement comment comments promo related recommended sponsored teaser".split())
#: Elements that a template is made of. Plain paragraphs, headings and inline elements are no parts of their own: they go with what holds them.
CONTAINERS = frozenset("div section aside header footer nav form ul ol dl menu table figure center details fieldset dialog main search td".split())
#: Of those, the ones that an article uses for its own text; inside one they count only with a class, an id or a role.
LISTS = frozenset("ul ol dl table td figure details".split())


@dataclass
class Tree:
    """Elements in page order, parents first; the first is the page itself. Few have a class, an id or a role."""

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    digest: list[int] = field(default_factory=lambda: [0])
    marks: dict[int, frozenset[str]] = field(default_factory=dict)
    role: dict[int, str] = field(default_factory=dict)
    #: In page order: an element and a text in it, or None at a block's edge and at a rule.
    events: list[tuple[int, str | None]] = field(default_factory=list)


def _described(attributes: str) -> tuple[frozenset[str], str]:
    """Words of classes and ids with the whole names, and the role."""
    found: set[str] = set()
    role = ""
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if key.lower() == "role":
            role = value.strip().lower()
        elif key.lower() == "itemprop":
            role = "main" if value == "articleBody" else role
        else:
            for name in value.split():
                found.add(name.lower())
                found.update(p.lower() for p in _PARTS.findall(name))
    return frozenset(found), role


def _digest(parts: list[bytes]) -> int:
    return int.from_bytes(blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)


class _Builder:
    """Takes tags and texts in page order. Elements that are open form a stack; beside it stand the places of each name, of blocks and of bounds."""

    def __init__(self, hashed: bool):
        self.t, self.hashed = Tree(), hashed
        self.stack: list[int] = [0]
        self.parts: list[list[bytes]] = [[]]
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.bounds: list[int] = []

    def top(self, names: tuple[str, ...]) -> int:
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)

    def put(self, text: str) -> None:
        t, owner = self.t, self.stack[-1]
        t.events.append((owner, text))
        if not text.isspace():
            t.size[owner] += len(text)
            if self.hashed:
                self.parts[-1].append(b"\0" + " ".join(text.split()).encode("utf-8", "surrogatepass"))

    def leave(self, place: int) -> None:
        """Close all elements from this place of the stack on."""
        t, stack, parts = self.t, self.stack, self.parts
        while len(stack) > place:
            node = stack.pop()
            tag = t.tag[node]
            own = parts.pop() if self.hashed else None
            if t.size[node] and tag not in NO_TEXT:
                if own:
                    digest = t.digest[node] = _digest(own)
                    parts[-1].append(b"\1%d" % digest)
                t.size[t.parent[node]] += t.size[node]
            self.at[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
                t.events.append((node, None))
            if tag in BOUNDS:
                self.bounds.pop()

    def enter(self, name: str, attributes: str) -> None:
        t, stack = self.t, self.stack
        node, place = len(t.tag), len(stack)
        t.tag.append(name)
        t.parent.append(stack[-1])
        t.size.append(0)
        t.digest.append(0)
        head = name
        if len(attributes) > 1:
            marks, role = _described(attributes)
            if marks:
                t.marks[node] = marks
            if role:
                t.role[node] = role
            head = f"{name} {' '.join(sorted(marks))} {role}"
        if self.hashed:
            self.parts.append([head.encode("utf-8", "surrogatepass")])
        stack.append(node)
        self.at.setdefault(name, []).append(place)
        if name in BLOCKS:
            self.blocks.append(place)
            t.events.append((node, None))
        if name in BOUNDS:
            self.bounds.append(place)

    def begin(self, name: str, attributes: str) -> None:
        t, at = self.t, self.at
        if at.get("head") and name not in HEAD:
            self.leave(at["head"][-1])
        if name in ENDS_P and (p := at.get("p")) and p[-1] > (self.bounds[-1] if self.bounds else -1):
            self.leave(p[-1])
        if name in HEADINGS and t.tag[self.stack[-1]] in HEADINGS:
            self.leave(len(self.stack) - 1)
        if name in SIBLINGS:
            siblings, bounds = SIBLINGS[name]
            bound = self.top(bounds)
            outermost = min((at[s][-1] for s in siblings if at.get(s) and at[s][-1] > bound), default=-1)
            if outermost > 0:
                self.leave(outermost)
        if name in ("html", "body") and at.get(name):
            return
        if name in VOID:
            if name in ("br", "hr"):
                t.events.append((self.stack[-1], "\n" if name == "br" else None))
            return
        self.enter(name, attributes)
        if attributes.endswith("/>") and (at.get("svg") or at.get("math")):
            self.leave(len(self.stack) - 1)

    def end(self, name: str) -> None:
        places = self.at.get(name)
        if not places or name in ("html", "body"):
            return
        place = places[-1]
        if name not in BLOCKS:
            crossed = bool(self.blocks) and self.blocks[-1] > place
        elif name in TABLE_PARTS:
            crossed = self.top(("table",)) > place
        else:
            crossed = name != "table" and bool(self.bounds) and self.bounds[-1] > place
        if not crossed:
            self.leave(place)


def _lowered(html: str) -> str:
    """In lower case, at the same places."""
    low = html.lower()
    return low if len(low) == len(html) else re.sub("[A-Z]+", lambda m: m.group().lower(), html)


def tree(html: str, hashed: bool = True) -> Tree:
    """Read a page; hashed: with digests of its elements."""
    b = _Builder(hashed)
    place, done, length = 0, 0, len(html)
    lowered: str | None = None
    while (place := html.find("<", place)) >= 0:
        found = _TAG.match(html, place)
        if not found:
            place += 1
            continue
        if place > done:
            b.put(unescape(html[done:place]))
        slash, name = found.groups()
        if name is None:
            comment = found.group() == "<!--"
            stop = html.find("-->" if comment else ">", found.end() - (2 if comment else 1))
            done = place = length if stop < 0 else stop + (3 if comment else 1)
            continue
        rest = _ATTRIBUTES.match(html, found.end())
        if not rest:
            done = length
            break
        done = place = rest.end()
        name = name.lower()
        if slash:
            b.end(name)
            continue
        b.begin(name, rest.group())
        if name in RAW:
            lowered = _lowered(html) if lowered is None else lowered
            stop = lowered.find(f"</{name}", done)
            if stop > done:
                b.put(html[done:stop])
            done = place = length if stop < 0 else stop
    if done < length:
        b.put(unescape(html[done:]))
    b.leave(1)
    b.t.digest[0] = _digest(b.parts[0]) if hashed else 0
    return b.t


@dataclass(frozen=True)
class Places:
    """What the elements of a tree are, by their places."""

    holds_article: list[bool]
    in_article: list[bool]
    article: list[bool]
    #: The outermost article that an element is in, or the page.
    home: list[int]


def places(t: Tree) -> Places:
    """Which elements declare themselves the page's article, hold one, or are inside one."""
    n, whole = len(t.tag), t.size[0]
    aside = [False] * n
    article = [False] * n
    for i in range(1, n):
        up = t.parent[i]
        aside[i] = aside[up] or t.tag[i] in BESIDE or t.tag[i] in NO_TEXT or i in t.marks and bool(t.marks[i] & NO_ARTICLE) and 2 * t.size[i] <= whole
        declared = t.tag[i] in ("article", "main") or t.role.get(i) in ("main", "article")
        article[i] = declared and not aside[i] and t.size[i] > 0
    holds = article[:]
    for i in range(n - 1, 0, -1):
        if holds[i]:
            holds[t.parent[i]] = True
    inside, home = [False] * n, [0] * n
    for i in range(1, n):
        up = t.parent[i]
        inside[i] = inside[up] or article[i]
        home[i] = home[up] or (i if article[i] else 0)
    return Places(holds, inside, article, home)


_NONE: frozenset[str] = frozenset()


def _may_go(t: Tree, p: Places, i: int) -> bool:
    """Whether an element may be taken for a part of the template: no article is in it, nor most of the page's text."""
    if t.tag[i] not in CONTAINERS and "-" not in t.tag[i] or p.holds_article[i] or not t.size[i] or 2 * t.size[i] > t.size[0]:
        return False
    return not p.in_article[i] or i in t.marks or i in t.role or t.tag[i] not in LISTS and t.tag[i] != "div"


def outline(html: str) -> tuple[int, list[int]]:
    """The page's digest and those of the elements that may be template, each once."""
    t = tree(html)
    p = places(t)
    return t.digest[0], sorted({t.digest[i] for i in range(1, len(t.tag)) if _may_go(t, p, i)})


def _beside(t: Tree, p: Places, i: int) -> bool:
    """Whether an element says that it is no part of the article."""
    tag, marks = t.tag[i], t.marks.get(i, _NONE)
    if tag in NO_TEXT:
        return True
    if p.holds_article[i] and not (tag == "article" and p.in_article[t.parent[i]]):
        return False
    if tag in BESIDE or t.role.get(i) in ROLES or tag == "header" and not p.in_article[i]:
        return True
    # a name tells nothing of what holds nearly all of an article, or of a page without one most of it: that is no part beside it
    whole = t.size[p.home[i]]
    if tag in ("html", "body") or (10 * t.size[i] > 9 * whole if p.home[i] or marks & NO_ARTICLE else 2 * t.size[i] > whole):
        return False
    return tag == "form" or bool(marks & MARKS) or tag not in HEADINGS and bool(marks & HEADER_NAMES) and not p.in_article[i]


def main_text(html: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """Blocks of the article, two line feeds apart, without elements whose digest is in ``template``."""
    t = tree(html, bool(template))
    p = places(t)
    n = len(t.tag)
    # an article inside another one is a comment on it, or its teaser
    inner = [False] * n
    outer = [""] * n
    for i in range(1, n):
        up = t.parent[i]
        inner[i] = t.tag[i] == "article" and outer[up] == "article"
        outer[i] = "article" if outer[up] == "article" or p.article[i] and t.tag[i] == "article" else "main" if outer[up] or p.article[i] else ""
    gone = [False] * n
    heading = [0] * n  # 1 in a header of the article, 2 in a heading there
    for i in range(1, n):
        up = t.parent[i]
        gone[i] = gone[up] or inner[i] or _beside(t, p, i) or bool(template) and t.digest[i] in template and _may_go(t, p, i)
        heading[i] = 1 if t.tag[i] == "header" and p.in_article[i] else 2 if heading[up] and t.tag[i] in HEADINGS else heading[up]
    held = {"": 0, "main": 0, "article": 0}
    for i, text in t.events:
        if text and not gone[i] and heading[i] != 1:
            held[outer[i]] += len(text)
    wanted = ("article",) if held["article"] and held["article"] >= held["main"] else ("article", "main") if held["main"] else ("", "main", "article")
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        block = " ".join("".join(line).split())
        if block:
            blocks.append(block)
        line.clear()

    for i, text in t.events:
        if text is None:
            flush()
        elif not gone[i] and heading[i] != 1 and outer[i] in wanted:
            line.append(text)
    flush()
    return "\n\n".join(blocks)
