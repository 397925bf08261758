"""Mixing: declarative filters over attributes and rewriting of spans, compiled to one plan.

A spec has exclusions, inclusions and replacements. A row goes when an
exclusion holds; with inclusions, one of them must hold. An attribute that is
missing satisfies no condition. All conditions see the original text, and all
replacements are applied at once on its offsets.

Conditions are written as in JSONPath filters (``$.attributes[?(@.name &&
@.name[0][2] <= 0.5)]``, ``$.metadata[?(@.key == "x")]``) or as jq predicates
(``.attributes.name[0][2] <= 0.5``, ``.metadata.title | startswith("x")``); they
become columns, nothing is evaluated.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .taggers import tagger

_COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
}


class SpecError(ValueError):
    """A spec that can't be read; the message says where."""


@dataclass(frozen=True)
class Condition:
    """``place`` (attributes, metadata or a column), its key, an operator and a value."""

    place: str
    key: str
    op: str
    value: object

    def column(self, attributes: Callable[[str], Column], metadata: Callable[[str], Column]) -> Column:
        if self.place == "attributes":
            left = S.first_score(attributes(self.key))
        else:
            left = metadata(self.key) if self.place == "metadata" else F.col(self.key)
        if self.op == "startswith":
            return left.startswith(self.value)
        if self.op == "in":
            return left.isin(*self.value)
        return _COMPARE[self.op](left, self.value)


@dataclass(frozen=True)
class Replacement:
    span: str
    text: str
    min_score: float | None = None
    max_score: float | None = None


@dataclass(frozen=True)
class MixSpec:
    name: str
    exclude: tuple[Condition, ...] = ()
    include: tuple[Condition, ...] = ()
    replace: tuple[Replacement, ...] = ()
    documents: tuple[str, ...] = ()
    output: str | None = None
    max_size: int = 1_000_000_000

    def needed(self) -> list[str]:
        keys = [c.key for c in (*self.exclude, *self.include) if c.place == "attributes"] + [r.span for r in self.replace]
        return list(dict.fromkeys(keys))


_VALUE = r"""(?P<value>\[[^\]]*\]|"[^"]*"|'[^']*'|-?[0-9.]+(?:[eE]-?[0-9]+)?|true|false|null)"""
_PATH = re.compile(r"^\$?@?\.?(?P<place>attributes|metadata)\.?\[\?\(\s*(?:@\.[\w$.\-]+(?:\[0\])?(?:\s*!=\s*null)?\s*&&\s*)*@\.(?P<key>[\w$\-]+)(?:\[0\]\[2\])?\s*(?P<op><=|>=|==|!=|<|>|in)\s*" + _VALUE + r"\s*\)\]$")
_JQ = re.compile(r"^\s*(?:\.[\w.\-\[\]0-9]+\s*!=\s*null\s+and\s+)?\.(?P<place>attributes|metadata)\.(?P<key>[\w\-]+)(?:\[0\]\[2\])?\s*(?P<op><=|>=|==|!=|<|>)\s*" + _VALUE + r"\s*$")
_STARTS = re.compile(r"""^\(?\s*\.(?P<place>metadata)\.(?P<key>\w+)\s*\|\s*startswith\(\s*(?P<value>"[^"]*")\s*\)\s*\)?$""")


def parse_condition(text: str) -> Condition:
    for pattern in (_PATH, _JQ, _STARTS):
        if m := pattern.match(text.strip()):
            value = json.loads(m["value"].replace("'", '"'))
            return Condition(m["place"], m["key"], m.groupdict().get("op") or "startswith", value)
    raise SpecError(f"can't read the condition {text!r}")


def _no_repeats(pairs: list[tuple[str, object]]) -> dict:
    keys = [k for k, _ in pairs]
    if len(keys) != len(set(keys)):
        raise SpecError(f"a key is given twice: {sorted(k for k in set(keys) if keys.count(k) > 1)}")
    return dict(pairs)


def load_specs(text: str) -> list[MixSpec]:
    """Specs from JSON: streams with name, documents, output, filter (include, exclude) and span_replacement."""
    try:
        root = json.loads(text, object_pairs_hook=_no_repeats)
    except json.JSONDecodeError as e:
        raise SpecError(f"no JSON: line {e.lineno}, column {e.colno}: {e.msg}") from e
    specs = []
    for stream in root.get("streams", []):
        rules = stream.get("filter") or {}
        read = lambda kind: tuple(parse_condition(x) for x in rules.get(kind) or ())  # noqa: E731, B023
        edits = tuple(Replacement(re.sub(r"^\$\.attributes\.", "", r["span"]), r.get("replacement", ""), r.get("min_score"), r.get("max_score")) for r in stream.get("span_replacement") or ())
        out = stream.get("output") or {}
        specs.append(MixSpec(stream["name"], read("exclude"), read("include"), edits, tuple(stream.get("documents") or ()), out.get("path"), out.get("max_size_in_bytes", 1_000_000_000)))
    return specs


def mix(docs: DataFrame, spec: MixSpec, text_col: str = "text", attributes_col: str | None = "attributes", metadata_col: str = "metadata") -> DataFrame:
    """Apply a spec. Attributes come from the map column where there is one, otherwise from the registered taggers, in the same plan."""
    stored = attributes_col if attributes_col in docs.columns else None

    def attribute(name: str) -> Column:
        if stored:
            return F.try_element_at(F.col(stored), F.lit(name))
        if name in docs.columns:
            return F.col(name)
        return tagger(name)(F.col(text_col))

    def metadata(key: str) -> Column:
        return F.col(metadata_col)[key] if metadata_col in docs.columns else F.col(key)

    holds = lambda c: F.coalesce(c.column(attribute, metadata), F.lit(False))
    kept = docs
    for condition in spec.exclude:
        kept = kept.filter(~holds(condition))
    if spec.include:
        either = holds(spec.include[0])
        for condition in spec.include[1:]:
            either = either | holds(condition)
        kept = kept.filter(either)
    if spec.replace:
        edits = F.concat(*[S.edits(attribute(r.span), r.text, r.min_score, r.max_score) for r in spec.replace])
        kept = S.rewritten(kept, text_col, edits)
    return kept


#: Kinds of personal data by the letters that recipes use.
PII_KINDS = {"E": "EMAIL_ADDRESS", "P": "PHONE_NUMBER", "I": "IP_ADDRESS"}


def redacted(docs: DataFrame, kinds: str, text_col: str = "text") -> DataFrame:
    """Replace personal data kind by kind, each on the text that the last one left: where kinds overlap, the first one given holds."""
    for k in kinds:
        docs = mix(docs, MixSpec(k, replace=(Replacement(f"pii_{PII_KINDS[k]}", f"<{PII_KINDS[k]}>", 0.1),)), text_col)
    return docs


def _at_most(key: str, value: float) -> Condition:
    return Condition("attributes", key, "<=", value)


ENGLISH, CHARS, TOKENS, DUPLICATE, QUALITY, LOGPROB = "english", "char_length", "whitespace_tokens", "duplicate_ngrams", "quality", "mean_log_probability"
_CODE = (Condition("attributes", "code_max_line_length", ">", 1000), Condition("attributes", "code_avg_line_length", ">", 100), Condition("attributes", "code_alnum_prop", "<", 0.25), Condition("attributes", "code_alpha_token_prop", "<", 1.5))
_REFLOW = (Replacement("paragraph_chunk", "", max_score=0.1), Replacement("terminal_newline", "", 0.1), Replacement("terminal_newline_with_space", " ", 0.1), Replacement("paragraph_terminal_newline", "\n\n", 0.1))


def recipe(name: str, english: bool = False, chars: int | None = None, tokens: int | None = None, logprob: bool = False, quality: bool = False, duplicate: bool = True, exact: bool = False, code: bool = False, more: tuple = (), pii: str = "", toxic: bool = False, lines: tuple[str, ...] = (), edits: tuple[Replacement, ...] = ()) -> MixSpec:
    """A spec from the usual rules: thresholds of the exclusions, and what is replaced."""
    rules = (
        ([_at_most(ENGLISH, 0.5)] if english else []) + ([_at_most(CHARS, chars)] if chars is not None else []) + ([_at_most(TOKENS, tokens)] if tokens is not None else [])
        + ([_at_most(LOGPROB, -20)] if logprob else []) + ([_at_most(QUALITY, 0.0001)] if quality else []) + (list(_CODE) if code else []) + list(more)
        + ([Condition("attributes", DUPLICATE, ">=", 0.9)] if duplicate else []) + ([Condition("attributes", "duplicate_documents", ">=", 1.0)] if exact else [])
    )
    replaced = [Replacement(x, "", 0.1) for x in (("toxic_sentence", "nsfw_sentence") if toxic else ())] + [Replacement(f"pii_{PII_KINDS[k]}", f"<{PII_KINDS[k]}>", 0.1) for k in pii]
    return MixSpec(name, tuple(rules), replace=(*replaced, *(Replacement(x, "", 0.1) for x in lines), *edits))


#: The rules of each collection.
RECIPES: dict[str, MixSpec] = {
    s.name: s
    for s in (
        recipe("article_abstracts", pii="E"),
        recipe("article_papers", english=True, pii="E"),
        recipe("heritage_library", english=True, chars=100, tokens=20, logprob=True, lines=("line_biodiversity_heritage_library",), edits=(Replacement("double_newline", "\n", 0.1), *_REFLOW)),
        recipe("caselaw", chars=100, tokens=20, pii="EPI", toxic=True),
        recipe("open_crawl", english=True, chars=100, tokens=20, quality=True, pii="EPI", toxic=True),
        recipe("instruction_data"),
        recipe("academic_books", english=True, chars=200, pii="EPI", toxic=True),
        recipe("recipes", english=True, chars=100, tokens=20, pii="EPI"),
        recipe("code_archive", english=True, chars=100, tokens=20, pii="EPI", toxic=True),
        recipe("library_books", logprob=True, toxic=True, lines=("page_numbers",), edits=_REFLOW),
        recipe("library_texts", english=True, chars=700, pii="EPI", toxic=True),
        recipe("news", english=True, chars=100, tokens=20, pii="EPI", lines=("line_news",)),
        recipe("courses", english=True, chars=300, pii="EPI", toxic=True),
        recipe("paper_corpus", pii="E"),
        recipe("old_books", logprob=True, toxic=True, lines=("page_numbers", "line_public_library_1929"), edits=(Replacement("double_space", " ", 0.1), *_REFLOW)),
        recipe("textbooks", english=True, chars=600, pii="EPI", toxic=True),
        recipe("ebooks", english=True, logprob=True, lines=("line_project_gutenberg",)),
        recipe("essays", chars=100, tokens=20, pii="EPI", lines=("line_public_domain_review",)),
        recipe("medical_articles", english=True, chars=100, tokens=20, pii="EPI", lines=("lines_with_too_few_words", "line_licensed_pubmed")),
        recipe("proposals", pii="EPI"),
        recipe("regulations", chars=100, tokens=20, pii="EPI", lines=("line_regulations", "page_regulations")),
        recipe("code_markdown", english=True, chars=100, pii="EPI", toxic=True),
        recipe("code_educational", code=True),
        recipe("question_sites", english=True, pii="EPI", lines=("line_stackexchange",)),
        recipe("code", code=True, more=(Condition("metadata", "language", "in", ("CSV", "TSV", "Public Key", "Checksums", "Go Checksums", "SVG", "Unity3D Asset", "Raw token data", "SubRip Text", "Gemfile.lock", "Pickle", "JSON")),)),
        recipe("code_html", english=True, chars=100, pii="EPI", toxic=True),
        recipe("chats", english=True, chars=100, tokens=20, pii="EPI", toxic=True, lines=("line_ubuntu_chat",)),
        recipe("uk_debates", english=True, pii="EPI", lines=("lines_with_too_few_words", "line_uk_hansard")),
        recipe("government", lines=("line_usgpo", "page_government")),
        recipe("patents", chars=100, tokens=20, logprob=True, duplicate=False, exact=True, pii="EPI"),
        recipe("encyclopedias", english=True, chars=100, tokens=20, pii="EPI", more=(Condition("metadata", "title", "startswith", "User talk"),)),
        recipe("wiki_archive", english=True, chars=700, tokens=20, pii="EPI", toxic=True, edits=(Replacement("duplicate_paragraphs", "", 0.8),)),
        recipe("video_transcripts", english=True, chars=100, tokens=20, pii="EPI", toxic=True),
    )
}
