"""Chunks of scanned pages: which lines are prose, and what becomes of the ends of its lines.

A page is read as a word of one letter a line, and the rules are patterns over
that word: long lines that stand together are a block, and a heading is a line
of plain characters that a block follows. Offsets come from running sums. Only
the comparison of headings with earlier ones runs in Arrow batches, on the
headings alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, lines, strip
from . import spans as S

CHUNKS = "array<struct<kind:string,start:int,end:int,score:double>>"
KINDS = ("paragraph_chunk", "terminal_newline", "terminal_newline_with_space", "paragraph_terminal_newline")
#: White space as the rules have it: that of Unicode, and the separators of ASCII.
BLANK = r"(?U)[\s\x1C-\x1F]"
#: A long line has more characters, a heading more than so many and only these; headings are alike from this share on.
LONG, SHORT, HEADING, ALIKE = 30, 5, r"(?U)^[0-9A-Za-z\s\x1C-\x1F.,:]+$", 0.7
#: Blocks over the letters of long (L), short (s) and empty (e) lines: three long ones or more, or a run of them that ends the page, and a short line behind.
BLOCK = "L{3,}[sh]?|L{1,2}$"


def _shape(rows: Column) -> Column:
    """A letter for each line: b in a block, e empty, h a heading that a block follows, n any other."""

    def letter(line: Column) -> Column:
        return let(strip(line, BLANK), lambda x: F.when(x == "", "e").when(F.length(x) > LONG, "L").when((F.length(x) > SHORT) & x.rlike(HEADING), "h").otherwise("s"))

    def blocks(word: Column) -> Column:
        outside, inside = F.split(word, BLOCK), F.regexp_extract_all(word, F.lit(f"({BLOCK})"), F.lit(1))
        # a long line outside a block may be a heading too
        return F.array_join(F.zip_with(outside, inside, lambda o, i: F.concat(o, F.repeat(F.lit("b"), F.length(F.coalesce(i, F.lit("")))))), "")

    return let(F.array_join(F.transform(rows, letter), ""), blocks)


def _letters(rows: Column) -> Column:
    """The shape as an array, with H for headings that a block follows."""

    def marked(shape: Column) -> Column:
        own = F.split(shape, "")
        plain = F.zip_with(rows, own, lambda line, c: F.when((c == "L") & strip(line, BLANK).rlike(HEADING), "h").otherwise(c))
        return F.split(F.regexp_replace(F.array_join(plain, ""), "h(?=e*b)", "H"), "")

    return let(_shape(rows), marked)


class Headings:
    """Headings so far; tells whether another is like one of them.

    Two are alike by twice their longest common subsequence over both lengths.
    The subsequences with all earlier ones of up to 64 characters are counted
    together, a bit a character; longer ones one by one, in the same way.
    """

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.masks = np.zeros((64, 16), np.uint64)
        self.sizes = np.zeros(16, np.int64)
        self.n = 0
        self.long: list[tuple[dict[str, int], int]] = []

    def like(self, text: str) -> bool:
        if self.n:
            row = np.full(self.n, np.iinfo(np.uint64).max)
            for c in text:
                if (k := self.places.get(c)) is not None:
                    both = row & self.masks[k, : self.n]
                    row = (row + both) | (row - both)
            # a zero for each character of the subsequence; bits behind a heading's end stay ones
            common = 64 - np.bitwise_count(row).astype(np.int64)
            if (2 * common >= ALIKE * (self.sizes[: self.n] + len(text)) - 1e-9).any():
                return True
        return any(2 * self._common(masks, size, text) >= ALIKE * (size + len(text)) - 1e-9 for masks, size in self.long)

    @staticmethod
    def _common(masks: dict[str, int], size: int, text: str) -> int:
        full = (1 << size) - 1
        row = full
        for c in text:
            both = row & masks.get(c, 0)
            row = ((row + both) | (row - both)) & full
        return size - row.bit_count()

    def add(self, text: str) -> None:
        if len(text) > 64:
            masks: dict[str, int] = {}
            for k, c in enumerate(text):
                masks[c] = masks.get(c, 0) | 1 << k
            self.long.append((masks, len(text)))
            return
        if self.n == self.masks.shape[1]:
            self.masks = np.pad(self.masks, ((0, 0), (0, self.n)))
            self.sizes = np.pad(self.sizes, (0, self.n))
        for k, c in enumerate(text):
            place = self.places.setdefault(c, len(self.places))
            if place == len(self.masks):
                self.masks = np.pad(self.masks, ((0, place), (0, 0)))
            self.masks[place, self.n] |= np.uint64(1) << np.uint64(k)
        self.sizes[self.n] = len(text)
        self.n += 1


def new_headings(headings: list[str]) -> list[bool]:
    """Whether each heading is unlike all new ones before it."""
    seen, out = Headings(), []
    for text in headings:
        new = not seen.like(text.lower())
        if new:
            seen.add(text.lower())
        out.append(new)
    return out


def paragraph_chunks(text: Column) -> Column:
    """Spans that put scanned pages back into paragraphs: the lines, with score 0 for those that are neither in a block nor a new heading, and the white space between the lines of a block and behind it."""
    rows = lines(text)
    headed = F.zip_with(rows, _letters(rows), lambda line, c: F.when(c == "H", strip(line, BLANK)))
    wanted = F.filter(headed, lambda x: x.isNotNull())

    @F.pandas_udf("array<boolean>")
    def compared(headings: pd.Series) -> pd.Series:
        return headings.map(lambda x: None if x is None else new_headings(list(x)))

    new = compared(F.when(F.size(wanted) > 0, wanted))

    def placed(own: Column) -> Column:
        which = S.running(F.transform(own, lambda c: (c == "H").cast("int")))
        ends = S.running(F.transform(rows, lambda x: F.length(x) + 1))
        cut = F.zip_with(rows, ends, lambda line, end: F.struct(line.alias("line"), (end - 1 - F.length(line)).alias("start"), end.alias("end")))
        named = F.zip_with(own, which, lambda c, k: F.struct(c.alias("letter"), k.alias("k")))
        return F.zip_with(cut, named, lambda a, b: F.struct(a.line.alias("line"), a.start.alias("start"), a.end.alias("end"), b.letter.alias("letter"), b.k.alias("k")))

    def spans(page: Column) -> Column:
        all_rows, new = page["rows"], page["new"]

        def of(x: Column, k: Column) -> Column:
            last = k == F.size(all_rows) - 1
            end = F.when(last, x.end - 1).otherwise(x.end)
            follows = F.coalesce(F.get(all_rows, k + 1)["letter"] == "b", F.lit(False))
            bare = F.length(F.regexp_replace(x.line, f"{BLANK}+$", ""))
            hyphen = F.regexp_replace(x.line, f"{BLANK}+$", "").endswith("-")
            one = lambda kind, a, z, score: F.struct(kind.alias("kind"), a.cast("int").alias("start"), z.cast("int").alias("end"), score.cast("double").alias("score"))
            in_block = x.letter == "b"
            score = F.when(in_block, 1.0).when((x.letter == "H") & F.get(new, x.k - 1), 1.0).otherwise(0.0)
            chunk = F.when(in_block | (end > x.start), one(F.lit(KINDS[0]), x.start, end, score))
            inner = F.when(hyphen, one(F.lit(KINDS[1]), x.start + bare - 1, end, F.lit(1))).otherwise(one(F.lit(KINDS[2]), x.start + bare, end, F.lit(1)))
            tail = F.when(in_block & follows, inner).when(in_block & ~last, one(F.lit(KINDS[3]), end - 1, end, F.lit(1)))
            return F.array(chunk, tail)

        return F.filter(F.flatten(F.transform(all_rows, of)), lambda s: s.isNotNull())

    page = F.struct(let(_letters(rows), placed).alias("rows"), new.alias("new"))  # batch functions can't stand in a lambda
    return F.when(text.isNotNull(), let(page, spans))


def of_kind(chunks: Column, kind: str) -> Column:
    """The spans of one kind."""
    return F.transform(F.filter(chunks, lambda s: s.kind == kind), lambda s: S.span(s.start, s.end, s.score))
