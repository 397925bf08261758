"""Text as columns. Lengths and offsets count code points; white space is ASCII's unless told otherwise."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\x0B\f\r]"
UNICODE_SPACE = r"(?U)\s"


def quoted(literal: str) -> str:
    """A pattern for the literal in any dialect."""
    return re.sub(r"([^\w\s])", r"\\\1", literal)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: inside a lambda an expression is evaluated for every element, a variable is not."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def strip(text: Column, space: str = SPACE) -> Column:
    """Without white space at both ends, read from the ends; by a pattern that starts once in every run, where it isn't ASCII's."""
    if space == SPACE:
        return F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.regexp_replace(text, f"^(?:{space})++|(?<!{space})(?:{space})++$", "")


def words(text: Column, space: str = SPACE) -> Column:
    return F.filter(F.split(text, f"{space}+"), lambda x: x != "")


def word_count(text: Column, space: str = SPACE) -> Column:
    """Parts between single white spaces that are not empty, counted in compiled code."""
    return F.size(F.array_remove(F.split(text, space), "")).cast("long")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def remove_prefix(text: Column, prefix: str) -> Column:
    return F.when(F.lit(bool(prefix)) & text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def remove_suffix(text: Column, suffix: str) -> Column:
    return F.when(F.lit(bool(suffix)) & text.endswith(suffix), F.left(text, F.length(text) - len(suffix))).otherwise(text)


def paragraphs(text: Column) -> Column:
    """The lines with their line feeds; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(r"([^\n]*\n|[^\n]+)"), F.lit(1))


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\n\n+", "\n\n")


def keep_lines(text: Column, keep) -> Column:
    """The lines for which keep(line) holds."""
    return F.array_join(F.filter(lines(text), keep), "\n")


def prose_lines(text: Column) -> Column:
    """Lines that are empty, start with a backslash, or have more than one word."""
    return keep_lines(text, lambda x: (x == "") | x.startswith("\\") | (F.size(words(x)) > 1))


def without_table_lines(text: Column) -> Column:
    return keep_lines(text, lambda x: ~x.startswith("-") & ~x.startswith("|"))


def without_leading_list(text: Column) -> Column:
    """Drop the run of list items that the text starts with."""
    return F.regexp_replace(text, r"^(?:- [^\n]*+(?:\n|$))++", "")


def reflow(text: Column) -> Column:
    """A line feed alone becomes a space; several stay."""
    return F.regexp_replace(text, r"(?<!\n)\n(?!\n)", " ")


def numbered_claims(text: Column) -> Column:
    """A new line before each number that starts a claim."""
    return F.regexp_replace(text, r" (\d+)\s*\. ", "\n$1. ")


def without_first(text: Column, pattern: str) -> Column:
    """Remove the first match only."""
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", "$1")


def sections(text: Column, mark: str = "\n# ") -> Column:
    """Sections with their index, as structs of section and text."""
    return F.transform(F.split(text, mark), lambda x, i: F.struct(i.alias("section"), x.alias("text")))


def useful_sections(parts: Column, least: int = 50, skip: str = r"^#*\s*\**Reference") -> Column:
    """Sections long enough that are no references."""
    return F.filter(parts, lambda s: (F.length(s.text) >= least) & ~s.text.rlike(skip))


#: Titles of sections that hold no prose.
SKIP_SECTIONS = (
    "notes", "bibliography", "sources", "citations", "references", "see also", "external links", "further reading",
    "tertiary sources", "secondary sources", "primary sources", "general and cited sources", "footnotes", "works cited",
)


def format_sections(title: Column, parts: Column, skip: tuple[str, ...] = SKIP_SECTIONS) -> Column:
    """Title, then the sections (structs of title and text) that are not to skip and have text, a blank line apart."""
    kept = F.filter(parts, lambda s: ~F.lower(F.coalesce(s.title, F.lit(""))).isin(*skip) & (strip(s.text) != ""))
    shown = F.transform(kept, lambda s: F.when(F.coalesce(s.title, F.lit("")) == "", s.text).otherwise(F.concat(s.title, F.lit("\n\n"), s.text)))
    return F.array_join(F.concat(F.array(title), shown), "\n\n")


def spaced_indents(text: Column) -> Column:
    """A blank line after each run of lines indented by colons."""
    return F.regexp_replace(text, r"(?m)^(:+.+)\n(?![:\n])", "$1\n\n")


#: The lines that public-domain e-books start and end with.
HEADER = r"(?is)^.*?(?:\*\*\* ?)? ?START OF (?:THE|THIS) PROJECT GUTENBERG[^\n]*"
FOOTER = r"(?is)(?:\*\*\* ?)? ?END OF (?:THE|THIS) PROJECT GUTENBERG.*$"


def strip_book(text: Column) -> Column:
    """What stands between the start and end lines of a public-domain e-book."""
    return strip(F.regexp_replace(F.regexp_replace(text, HEADER, ""), FOOTER, ""))


#: Names of relay and log bots in chats.
CHAT_BOTS = (
    "<ubottu>", "<ubuntulog>", "<ubuntulog2>", "<ubot5>", "<ubot93>", "<ukbot>", "<uvirtbot>", "<Meetingology>", "<queuebot>", "<twobottux>", "<AirBot>", "<IrcsomeBot>",
    "<lubot>", "<uBOTu-fr>", "<ubotu-search>", "<Fibubot>", "<CyberKing>", "<lubotu1>", "<lubotu2>", "<lubotu3>", "<kubot>", "<IRSeekBot>", "<IRCAnswersBot>",
)
#: Times, relays and announcements in chats.
CHAT_TIME = r"\[[0-9][0-9]:[0-9][0-9]\]"


def clean_chat(text: Column, bots: tuple[str, ...] = CHAT_BOTS) -> Column:
    """Without announcements, relayed names and the lines of bots."""
    out = F.regexp_replace(text, r"===.*\n", "")
    out = F.regexp_replace(out, rf"({CHAT_TIME} )<[^\s]*> (\[telegram\] )?(<[^\s]*>):?", "$1$3")
    out = F.regexp_replace(out, rf"{CHAT_TIME} (?:{'|'.join(map(quoted, bots))}) .*\n?", "")
    return strip(out)


def chat_authors(text: Column) -> Column:
    """Sorted names that speak or act at the start of a line."""
    said = F.regexp_extract_all(text, F.lit(rf"(?m)^{CHAT_TIME} <(\S*?)>"), F.lit(1))
    acted = F.regexp_extract_all(text, F.lit(rf"(?m)^{CHAT_TIME}  \* (\S*)"), F.lit(1))
    return F.sort_array(F.array_union(said, acted))


def proposal_links(text: Column) -> Column:
    """Numbered references as plain text."""
    return F.regexp_replace(text, r":pep:`(\d{1,4})`", "PEP $1")


def proposal_created(text: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(text, r"(?m)^Created: (.*)$", 1)), F.lit(""))


def proposal_authors(text: Column) -> Column:
    """Sorted names of the author field, without addresses."""
    block = F.regexp_extract(text, r"(?ms)^Author: (.*?)^[^\n]*?:", 1)
    names = F.transform(F.split(F.regexp_replace(block, r"(?s)<.*?>", ""), ","), lambda x: strip(x))
    return F.sort_array(F.filter(names, lambda x: x != ""))


def has_open_publication_license(text: Column) -> Column:
    """Whether a copyright section names it. The addresses are looked for in lower case, as the text is."""
    section = F.lower(F.regexp_extract(text, r"(?is)(?:^|\n)[^\n]*copyright[^\n]*\n[=~\-]{3,}[^\n]*\n(.*?)(?=\n[^\n]+\n[=~\-]{3,}|$)", 1))
    return F.coalesce(section.contains("open publication license") | section.contains("spdx.org/licenses/opubl-1.0") | section.contains("opencontent.org/openpub"), F.lit(False))


def clean_author(text: Column) -> Column:
    """A byline without its lead-in, title lines and role. The patterns are fixed values; each works on what the one before it left."""
    out = text
    for lead in (r"^[Aa]uthors?:?\b", r"^[Bb]y:?\b", r"^(?i:Written by)", r"^STORY:", r"[-.]$"):
        out = strip(F.regexp_replace(out, lead, ""))
    scholars = F.filter(F.transform(F.regexp_extract_all(out, F.lit(r"(.*?),.*?University.*?(?:;| and)?"), F.lit(1)), lambda x: strip(x)), lambda x: x != "")
    out = F.when(F.size(scholars) > 0, F.array_join(scholars, ", ")).otherwise(out)
    out = strip(F.split(strip(F.split(out, "\n")[0]), "\t")[0])
    return strip(F.regexp_replace(F.regexp_replace(out, r" Contributor$", ""), f"{SPACE}+", " "))


def tag_map(tags: Column) -> Column:
    """Strings a:b as a map; of several colons the first two parts count, of equal keys the last."""
    pairs = F.filter(tags, lambda x: F.contains(x, F.lit(":")))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != F.split(x, ":")[0]), F.create_map(F.split(x, ":")[0], F.split(x, ":")[1])))


def wrapped(text: Column, width: int) -> Column:
    """Lines of at most ``width`` characters, broken at spaces; longer words are cut."""
    return F.regexp_replace(text, rf"([^\n]{{1,{width}}})(?: |(\n)|$)", "$1\n")


def newline_token(text: Column, token: str = "<n>") -> Column:
    """One line per document, for trainers that read lines."""
    return F.regexp_replace(text, "\n", token)


#: Pre-tokenisation patterns.
PRETOKENS = {
    "tiktoken": r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+",
    "tiktoken+digits": r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+",
    "gpt2": r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
}


def pretokens(text: Column, pattern: str = "tiktoken") -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?U)({PRETOKENS[pattern]})"), F.lit(1))
