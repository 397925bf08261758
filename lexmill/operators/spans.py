"""Span algebra: arrays of (start, end, score) over the code points of a text, half open.

Spans are found by higher-order functions; where lines and matches start comes
from running sums of lengths, in blocks, so that no fold copies a long array at
every step. Edits are applied in one pass over the text in Arrow batches, to which
only texts that have any are sent.
"""

from __future__ import annotations

import itertools

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE, let, paragraphs, strip

SPANS = "array<struct<start:int,end:int,score:double>>"


def no_spans() -> Column:
    return F.array().cast(SPANS)


def span(start: Column, end: Column, score: Column | float = 1.0) -> Column:
    score = score if isinstance(score, Column) else F.lit(score)
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), score.cast("double").alias("score"))


def whole(text: Column, score: Column) -> Column:
    """One span over the document that carries a score."""
    return F.array(span(F.lit(0), F.length(text), score))


#: Numbers that :func:`running` adds up in one fold.
FOLD = 64


def _folded(sizes: Column) -> Column:
    """Running sums by a fold, which copies its array at every step."""
    last = lambda x: F.coalesce(F.get(x, F.size(x) - 1), F.lit(0))
    return F.aggregate(sizes, F.array().cast("array<int>"), lambda done, x: F.concat(done, F.array(last(done) + x)))


def _in_blocks(sizes: Column, sums_of_blocks) -> Column:
    """Running sums within blocks of FOLD, raised by those of the blocks before."""
    many = F.floor((F.size(sizes) + FOLD - 1) / FOLD).cast("int")
    starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(0), many - 1)).otherwise(F.array().cast("array<int>"))
    last = lambda x: F.get(x, F.size(x) - 1)

    def raised(parts: Column) -> Column:
        sums = sums_of_blocks(F.transform(parts, last))
        return F.flatten(F.zip_with(parts, sums, lambda part, end: let(end - last(part), lambda more: F.transform(part, lambda x: x + more))))

    return let(F.transform(starts, lambda k: _folded(F.slice(sizes, k * FOLD + 1, FOLD))), raised)


def running(sizes: Column) -> Column:
    """Running sums of an array of integers, each with its own: blocks, and blocks of blocks, so that no fold is long."""
    return let(sizes, lambda x: _in_blocks(x, lambda ends: let(ends, lambda y: _in_blocks(y, _folded))))


def of_paragraphs(text: Column, matches) -> Column:
    """Spans of the lines, with their line feed, for which matches(line) holds."""

    def found(rows: Column) -> Column:
        ends = running(F.transform(rows, F.length))
        placed = F.zip_with(rows, ends, lambda line, end: F.when(matches(line), span(end - F.length(line), end)))
        return F.filter(placed, lambda s: s.isNotNull())

    return let(paragraphs(F.coalesce(text, F.lit(""))), found)


def of_lines(text: Column, lines: list[str]) -> Column:
    """Lines that, stripped, are in the list."""
    known = sorted({x.strip() for x in lines})
    return of_paragraphs(text, lambda line: strip(line).isin(known))


def of_line_pattern(text: Column, patterns: list[str]) -> Column:
    """Lines that one of the patterns matches from their start."""
    either = "|".join(f"(?:{p})" for p in patterns)
    return of_paragraphs(text, lambda line: F.regexp_replace(line, "\n$", "").rlike(f"^(?:{either})"))


def of_pattern(text: Column, pattern: str) -> Column:
    """Spans of all matches, from the lengths of the pieces between them."""
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

    def placed(sizes: Column) -> Column:
        ends = running(F.transform(sizes, lambda s: s.gap + s.found))
        return F.zip_with(sizes, ends, lambda s, end: span(end - s.found, end))

    def measured(pieces: Column) -> Column:
        gaps = F.slice(F.split(text, pattern), F.lit(1), F.size(pieces))
        return F.zip_with(gaps, pieces, lambda g, f: F.struct(F.length(g).alias("gap"), F.length(f).alias("found")))

    return let(let(found, measured), placed)


def apart(column: Column) -> Column:
    """A column that is computed once where it stands: the optimizer copies no expression with a partition's number into those that use it."""
    return F.when(F.spark_partition_id() >= 0, column)


def edited(text: str, edits: list) -> str:
    """The text after its edits (start, end, text), in one pass."""
    out, at = [], 0
    for e in sorted(edits, key=lambda e: (e["start"], -e["end"])):
        if e["start"] >= at:
            out += [text[at : e["start"]], e["text"]]
            at = e["end"]
    return "".join([*out, text[at:]])


def rewritten(df: DataFrame, text_col: str, edits: Column) -> DataFrame:
    """Apply edits (start, end, text), given on the original offsets, to a column of texts, from left to right.

    Of edits that overlap the one that starts first stays, of those the longest.
    Edits are computed once, in a column of their own; texts without any stay in the JVM.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series, edits: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else edited(t, e) for t, e in zip(texts, edits)], dtype="object")

    free = next(name for k in itertools.count() if (name := f"edits{k}") not in df.columns)
    some = F.size(free) > 0
    out = df.withColumn(free, apart(edits))
    return out.withColumn(text_col, F.coalesce(run(F.when(some, F.col(text_col)), F.when(some, F.col(free))), F.col(text_col))).drop(free)


def edits(spans: Column, text: str, min_score: float | None = None, max_score: float | None = None) -> Column:
    """Edits from the spans whose score passes."""
    kept = spans
    if min_score is not None:
        kept = F.filter(kept, lambda s: s.score >= min_score)
    if max_score is not None:
        kept = F.filter(kept, lambda s: s.score <= max_score)
    return F.transform(F.coalesce(kept, no_spans()), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.lit(text).alias("text")))


def coverage(spans: Column, text: Column) -> Column:
    """Share of the text that the spans cover, weighted by their scores; null for an empty text."""
    total = F.aggregate(spans, F.lit(0.0), lambda a, s: a + s.score * (s.end - s.start))
    return total / F.nullif(F.length(text), F.lit(0))


def first_score(spans: Column) -> Column:
    """Score of the first span; null without one."""
    return F.get(spans, F.lit(0))["score"]


__all__ = ["SPACE", "SPANS", "apart", "coverage", "edited", "edits", "first_score", "no_spans", "of_line_pattern", "of_lines", "of_paragraphs", "of_pattern", "rewritten", "running", "span", "whole"]
