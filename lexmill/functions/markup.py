"""Markup: native stripping where a pattern says it all, Arrow-batched parsers elsewhere."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import wikimath

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(("script", "style", "template", "noscript"))


def strip_tags(text: Column) -> Column:
    """Remove what looks like a tag; a < before a space is text."""
    return F.regexp_replace(text, r"<[^ >][^>]*?>", "")


def strip_angles(text: Column) -> Column:
    """Remove everything between angle brackets of a line."""
    return F.regexp_replace(text, "<.+?>", "")


class Node:
    """An element of a parsed page: tag, attributes, children (nodes and strings)."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, joint: str = "", breaks: bool = False) -> str:
        parts, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                parts.append(node)
            elif breaks and node.tag == "br":
                parts.append("\n")
            elif node.tag not in HIDDEN:
                stack += reversed(node.children)
        return joint.join(parts)

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def find(self, tag: str | None = None, cls: str | None = None, **attrs: str) -> Iterator[Node]:
        for node in self.walk():
            if (tag is None or node.tag == tag) and (cls is None or node.has_class(cls)) and all(node.attrs.get(k) == v for k, v in attrs.items()):
                yield node

    def first(self, tag: str | None = None, cls: str | None = None, **attrs: str) -> Node | None:
        return next(self.find(tag, cls, **attrs), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(page: str) -> Node:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def _each(f: Callable[[str], object], kind: str) -> Callable[[Column], Column]:
    """A null-safe Arrow-batched function of one text."""

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else f(t) for t in texts], dtype=object)

    return run


def _text_or_same(page: str) -> str:
    try:
        return parse(page).text()
    except (AssertionError, ValueError):  # declarations that can't be parsed
        return page


def page_text(page: Column) -> Column:
    """Text of a page without scripts and styles; what can't be parsed stays."""
    return _each(_text_or_same, "string")(page)


def unescape(text: Column) -> Column:
    """Entities as characters."""
    return _each(html.unescape, "string")(text)


def preformatted(page: Column) -> Column:
    """What the first <pre> holds, entities resolved; null without one."""
    return unescape(F.nullif(F.regexp_extract(page, r"(?is)<pre[^>]*>(.*?)</pre>", 1), F.lit("")))


#: Elements that start and end a block of text, and those whose blocks never are main content.
BLOCKS = frozenset("address article aside blockquote body caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
BESIDE = frozenset("aside button footer form head nav select title".split())


def _blocks(root: Node) -> list[tuple[str, float, bool, bool]]:
    """Blocks in page order: text, share of it in links, whether they stand beside the content, and whether they are paragraphs or headings. No recursion: pages may be deep."""
    found: list[tuple[str, float, bool, bool]] = []
    own: list[str] = []
    linked = 0

    def flush(beside: bool, tag: str) -> None:
        nonlocal linked
        text = " ".join("".join(own).split())
        if text:
            found.append((text, linked / sum(map(len, own)), beside, tag in PROSE))
        own.clear()
        linked = 0

    # what is inside an element, and the block that it is in
    todo: list = [(root, False, False, "")]
    while todo:
        node, link, beside, block = todo.pop()
        if node is None:
            flush(beside, block)
        elif isinstance(node, str):
            own.append(node)
            linked += len(node) * link
        elif node.tag == "br":
            own.append(" ")
        elif node.tag not in HIDDEN:
            inner = beside or node.tag in BESIDE
            if node.tag in BLOCKS:
                flush(beside, block)
                block = node.tag
                todo.append((None, False, inner, block))
            todo.extend((c, link or node.tag == "a", inner, block) for c in reversed(node.children))
    flush(False, "")
    return found


def _main_text(page: str) -> str:
    """The run of blocks whose density is most above the cut.

    A block's density is the log of its words, less what is in links, smoothed over
    its neighbours; the cut is a little less than half the mean over words of text. The run
    with the largest sum of what is above it is the content, with its short blocks;
    blocks of links go, and thin ones at its ends that are no paragraphs or headings.
    """
    blocks = _blocks(parse(page))
    words = [len(text.split()) for text, *_ in blocks]
    own = [0.0 if beside else math.log1p(n) * (1 - link) ** 2 for n, (_, link, beside, _) in zip(words, blocks)]
    around = [0.0, *own, 0.0]
    smooth = [0.0 if blocks[k][2] else (around[k] + 2 * around[k + 1] + around[k + 2]) / 4 for k in range(len(own))]
    cut = sum(n * d for n, d in zip(words, own)) * 0.45 / max(1, sum(n for n, d in zip(words, own) if d))
    best = (0.0, 0, 0)
    total, start = 0.0, 0
    for k, d in enumerate(smooth):
        if total <= 0:
            total, start = 0.0, k
        total += d - cut
        best = max(best, (total, start, k + 1), key=lambda x: x[0])
    _, low, high = best
    thin = lambda k: own[k] < cut and not blocks[k][3]
    while low < high and thin(low):
        low += 1
    while low < high and thin(high - 1):
        high -= 1
    return "\n".join(text for text, link, beside, _ in blocks[low:high] if link <= 0.5 and not beside)


def main_content(page: Column) -> Column:
    """Main text by density of text and links: the default where no other extractor is plugged in."""
    return _each(_main_text, "string")(page)


_WIKI_TAG = re.compile(r"<(?:[a-zA-Z/]|\\/|\?xml|\?php|!--)[^>]{0,500}>", re.S)


def _wiki_strip(text: str, most: int) -> str:
    closed = set(re.findall(r"</([A-Za-z][A-Za-z0-9]*)>", text))
    text = _WIKI_TAG.sub("", text, count=most)
    for tag in sorted(closed):
        text = re.sub(rf"</?{tag}\b[^>]{{0,500}}>", "", text, count=most)
    return text


def strip_wiki_tags(text: Column, max_removals: int | None = None) -> Column:
    """Remove tags from wikitext, then what is left of tags that were closed somewhere; no more than max_removals of each where given."""
    most = max_removals or 0
    return _each(lambda t: _wiki_strip(t, most), "string")(text)


def math_to_tex(text: Column) -> Column:
    """:func:`.wikimath.math_tags` of each text."""
    return _each(wikimath.math_tags, "string")(text)


def _scope_end(text: str, at: int, opening: str, closing: str) -> int:
    """Index after the bracket that closes the one before ``at``; -1 without it."""
    depth = 1
    while at < len(text):
        if text.startswith(opening, at):
            depth, at = depth + 1, at + len(opening)
        elif text.startswith(closing, at):
            depth, at = depth - 1, at + len(closing)
            if not depth:
                return at
        else:
            at += 1
    return -1


def find_templates(text: str, names: tuple[str, ...] = ()) -> list[tuple[int, int]]:
    """Spans of outermost {{...}}, or of those with one of the names."""
    out, at = [], 0
    while (at := text.find("{{", at)) >= 0:
        end = _scope_end(text, at + 2, "{{", "}}")
        if end < 0:
            break
        name = re.split(r"[|}\n]", text[at + 2 : end], maxsplit=1)[0].strip().lower()
        if not names or name in names:
            out.append((at, end))
            at = end
        else:
            at += 2
    return out


def _without_templates(text: str) -> str:
    out, at = [], 0
    for start, end in find_templates(text):
        out.append(text[at:start])
        at = end
    return "".join(out) + text[at:]


def strip_templates(text: Column) -> Column:
    return _each(_without_templates, "string")(text)


def template_names(text: Column) -> Column:
    """Name of every {{template}}, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\{\{\s*([^|{}\n]+?)\s*[|}\n]"), F.lit(1)), F.lower)


def wiki_math(text: Column) -> Column:
    """Math templates and symbols of wikitext as TeX; other templates stay."""
    return _each(wikimath.to_tex, "string")(text)


def wiki_sections(text: Column) -> Column:
    """Sections (title, text) by == headings ==, the lead first with an empty title."""
    cut = F.split(F.concat(F.lit("== ==\n"), text), r"(?m)^(?===+[^=\n][^\n]*==+\s*$)")
    title = lambda x: F.trim(F.regexp_extract(x, r"^==+\s*([^=\n]*?)\s*==+", 1))
    body = lambda x: F.regexp_replace(x, r"^==+[^\n]*==+[ \t]*\n?", "")
    return F.transform(F.filter(cut, lambda x: x != ""), lambda x: F.struct(title(x).alias("title"), body(x).alias("text")))


def page_fields(spec: dict[str, dict]) -> Callable[[Column], Column]:
    """A parser of templated pages. Each field names a ``tag``, ``cls`` or attributes, and may take ``attr``, ``all`` matches or text with ``breaks``."""

    def read(page: str) -> dict:
        root = parse(page)
        out = {}
        for name, rule in spec.items():
            rule = dict(rule)
            attr, every, breaks = rule.pop("attr", None), rule.pop("all", False), rule.pop("breaks", False)
            value = lambda n: n.attrs.get(attr) if attr else n.text(breaks=breaks).strip()
            found = [value(n) for n in root.find(**rule)]
            out[name] = found if every else (found[0] if found else None)
        return out

    kind = ", ".join(f"{n}: {'array<string>' if r.get('all') else 'string'}" for n, r in spec.items())

    def parser(page: Column) -> Column:
        @F.pandas_udf(f"struct<{kind}>")
        def run(pages: pd.Series) -> pd.DataFrame:
            rows = [{n: None for n in spec} if p is None else read(p) for p in pages]
            return pd.DataFrame(rows, columns=list(spec), dtype=object)

        return run(page)

    return parser


#: Page templates of some sites: fields and where they stand.
RECIPE_PAGE = page_fields({"title": {"tag": "h1"}, "author": {"cls": "username"}, "date": {"tag": "time", "attr": "datetime"}, "body": {"cls": "field-item", "all": True}, "comments": {"cls": "comment-content", "all": True}})
NEWS_PAGE = page_fields({"title": {"tag": "title"}, "byline": {"cls": "byline"}, "date": {"tag": "time", "attr": "datetime"}, "paragraphs": {"tag": "p", "all": True, "breaks": True}})
ESSAY_PAGE = page_fields({"title": {"tag": "h1"}, "author": {"cls": "author"}, "date": {"cls": "date"}, "paragraphs": {"tag": "p", "all": True}})


def definitions(page: Column) -> Column:
    """Terms of definition lists with what follows each: a map, the first of equal terms."""

    @F.pandas_udf("map<string,string>")
    def run(pages: pd.Series) -> pd.Series:
        out = []
        for p in pages:
            found: dict[str, str] = {}
            if p is not None:
                terms = [n for n in parse(p).walk() if n.tag in ("dt", "dd")]
                for a, b in zip(terms, terms[1:]):
                    if a.tag == "dt" and b.tag == "dd":
                        found.setdefault(a.text().strip().rstrip(":"), b.text().strip())
            out.append(None if p is None else found)
        return pd.Series(out, dtype=object)

    return run(page)


def valid_paragraphs(paragraphs: Column) -> Column:
    """Without empty ones and notices of a web server."""
    return F.filter(paragraphs, lambda p: (F.trim(p) != "") & ~p.contains("Cloudflare") & ~p.contains("403 Forbidden"))


def debate_text(xml: Column) -> Column:
    """Headings and speeches of a debate in order, as "speaker: text"; speeches that hold a table directly are left out."""

    def read(page: str) -> str:
        rows = []
        for node in parse(page).walk():
            if node.tag.endswith("-heading"):
                rows.append(node.text().strip())
            elif node.tag == "speech" and not any(isinstance(c, Node) and c.tag == "table" for c in node.children):
                said = node.text().replace("    ", "").replace("\xa0", " ").strip()
                rows.append(f"{node.attrs['speakername']}: {said}" if node.attrs.get("speakername") else said)
        return "\n".join(r for r in rows if r)

    return _each(read, "string")(xml)
