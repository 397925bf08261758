"""Deduplication: exact, by n-grams seen before, by paragraphs, by key.

"Before" is the order of a column that every document has; ties are broken by
the rest of the row's key, so results don't depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, lines, words
from ..session import durable
from . import spans as S
from .bloom import BloomSpec, BloomState, place
from .grams import gram_rows, grams_of_batch, texts_of


def keep_first(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each key, one of the null key too. Only keys and order are compared; rows move once."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.select(F.struct("*").alias("row"), place.alias("place")).filter("place = 1").select("row.*")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and score: 1 if an earlier document has the same text. Texts are compared by their SHA-256; none is shuffled."""
    keyed = docs.select(F.col(id_col), F.sha2(F.col(text_col).cast("binary"), 256).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min(id_col).alias("_first"))
    return keyed.join(first, "digest", "left").select(id_col, F.when(F.col("digest").isNull(), 0.0).otherwise((F.col(id_col) > F.col("_first")).cast("double")).alias("score"))


def shingles(own: Column, n: int, exact: bool = True) -> Column:
    """All runs of n words, as texts or as 64-bit hashes; none for fewer words.

    A hash of a run joins those of two shorter runs, twice as long at every step,
    so that a text takes some log n passes over its words and not n.
    """
    if exact:
        starts = lambda w: F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return let(own, lambda w: F.transform(starts(w), lambda k: F.array_join(F.slice(w, k, n), " ")))

    def joined(left: Column, right: Column, ahead: int) -> Column:
        """Runs of left, each with the run of right that starts ``ahead`` words later."""
        many = F.greatest(F.size(right) - ahead, F.lit(0))
        return F.zip_with(F.slice(left, F.lit(1), many), F.slice(right, F.lit(ahead + 1), many), lambda a, b: F.xxhash64(a, b))

    def of(doubled: Column, length: int, whole: Column | None, done: int) -> Column:
        """doubled: runs of ``length`` words; whole: those of the ``done`` words that lower bits of n stand for."""
        if n & length:
            whole, done = (doubled, length) if whole is None else (joined(whole, doubled, done), done + length)
        if length * 2 > n:
            return whole
        if whole is None:
            return let(joined(doubled, doubled, length), lambda x: of(x, length * 2, None, 0))
        both = F.struct(joined(doubled, doubled, length).alias("doubled"), whole.alias("whole"))
        return let(both, lambda x: of(x["doubled"], length * 2, x["whole"], done))

    return let(F.transform(own, lambda x: F.xxhash64(x)), lambda one: of(one, 1, None, 0))


def _exact_rows(docs: DataFrame, n: int, by_line: bool, id_col: str, text_col: str) -> DataFrame:
    """As :func:`~.grams.gram_rows` gives them, with n-grams as texts and a row for each; nothing is combined."""
    text = F.col(text_col)
    units = docs.select(F.col(id_col).alias("id"), F.posexplode(lines(text)).alias("line", "own")) if by_line else docs.select(F.col(id_col).alias("id"), F.lit(0).alias("line"), text.alias("own"))
    rows = units.select("id", "line", F.explode(shingles(words(F.col("own")), n)).alias("gram"))
    return rows.select("id", "line", "gram", F.lit(1).cast("long").alias("many"), F.lit(1).cast("long").alias("n_ngrams"), F.lit(0).cast("long").alias("met"), F.lit(False).alias("is_met"))


def _seen(rows: DataFrame, before: DataFrame | None = None, bits: DataFrame | None = None, spec: BloomSpec | None = None) -> DataFrame:
    """rows with ``seen``: whether a lower unit has the n-gram, or it is known from before.

    One shuffle by n-gram, or by its word of the filter, in which each group looks for
    its least unit. Rows that carry only totals are dealt by a hash of their unit.
    """
    unit = F.struct("id", "line")
    held = F.col("gram").isNotNull()
    if bits is None:
        group = [F.coalesce(F.xxhash64("gram"), F.xxhash64("id", "line")), F.col("gram")]
        known = F.lit(False)
    else:
        word, mask = place(F.col("gram"), spec)
        rows = rows.withColumn("word", F.coalesce(word, F.pmod(F.xxhash64("id", "line"), F.lit(spec.words)))).withColumn("mask", mask)
        # the same partitions serve the window
        rows = rows.join(bits.hint("merge"), "word", "left")
        group = [F.col("word"), F.col("gram")]
        known = F.coalesce(held & (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")), F.lit(False))
    if before is not None:
        given = before.select("gram", F.lit(True).alias("given"))
        rows = rows.withColumn("given", F.lit(False)).unionByName(given, allowMissingColumns=True)
        known = known | F.coalesce(F.max("given").over(Window.partitionBy(*group)), F.lit(False)) & held
    # a given n-gram has no unit: it isn't anybody's least
    least = F.min(F.when(F.col("many") > 0, unit)).over(Window.partitionBy(*group))
    found = rows.withColumn("seen", held & (known | F.coalesce(least < unit, F.lit(False))))
    return found.filter("many IS NOT NULL") if before is not None else found


def _overlap(rows: DataFrame, key: list[str], before: DataFrame | None = None, bits: DataFrame | None = None, spec: BloomSpec | None = None) -> DataFrame:
    """Key, n_ngrams and the share of its n-grams that a unit of a lower key holds, or that are known from before."""
    seen = _seen(rows, before, bits, spec).select("id", "line", "n_ngrams", (F.col("met") + F.when(F.col("seen"), F.col("many")).otherwise(0)).alias("met"))
    totals = seen.filter("n_ngrams > 0 OR met > 0").groupBy("id", "line").agg(F.sum("n_ngrams").alias("n_ngrams"), F.sum("met").alias("met"))
    named = [F.col(c).alias(name) for c, name in zip(("id", "line"), key)]
    return totals.select(*named, "n_ngrams", (F.col("met") / F.col("n_ngrams")).alias("overlap"))


def grams_of(docs: DataFrame, n: int = 20, text_col: str = "text", exact: bool = False) -> DataFrame:
    """The distinct n-grams of a corpus (gram): what :func:`ngram_overlap` of a later run takes as seen before. Eight bytes each; a :class:`~.bloom.BloomState` takes fewer, and a size that is set."""
    docs = docs.select(F.lit(0).alias("id"), F.col(text_col).alias("text"))
    rows = _exact_rows(docs, n, False, "id", "text") if exact else gram_rows(docs, n, id_col="id")
    return rows.filter("gram IS NOT NULL").select("gram").distinct()


def ngram_overlap(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", exact: bool = False, before: DataFrame | None = None) -> DataFrame:
    """Id, n_ngrams and overlap: the share of its n-grams that an earlier document holds, or an earlier run (:func:`grams_of`).

    Documents of fewer words have no row; rows that repeat an id are one document.
    Every document adds its n-grams, whatever becomes of it later, so the least id
    that holds an n-gram decides. N-grams are compared by 64-bit hashes, or as texts.
    """
    rows = _exact_rows(docs, n, False, id_col, text_col) if exact else gram_rows(docs, n, False, id_col, text_col)
    return _overlap(rows, [id_col], before)


def with_overlap(docs: DataFrame, overlap: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "duplicate_ngrams") -> DataFrame:
    """docs with their overlap as the attribute that mixes read, one span over the text; null, which satisfies no condition, where there is none."""
    own = overlap.select(F.col(id_col), F.col("overlap").alias(name))
    return docs.join(own, id_col, "left").withColumn(name, F.when(F.col(name).isNotNull(), S.whole(F.col(text_col), F.col(name))))


def bloom_overlap(docs: DataFrame, state: BloomState, n: int = 20, id_col: str = "doc_id", text_col: str = "text", read_only: bool = False) -> DataFrame:
    """As :func:`ngram_overlap`, with the n-grams of earlier runs in a filter of a size that is set; unless read_only, this run's are added to it.

    No n-gram that was seen is missed; of others the state's rate is taken for seen.
    Within the run n-grams are compared by 64-bit hashes. The result is a table, as
    it is taken before the state grows.
    """
    rows = gram_rows(docs, n, False, id_col, text_col)
    found = durable(_overlap(rows, [id_col], bits=state.bits(), spec=state.spec))
    if not read_only:
        state.add(rows)
    return found


def paragraph_overlap(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """Id, paragraph (from 0) and overlap with earlier paragraphs, of this document or another; empty and short ones have no row."""
    rows = _exact_rows(docs, n, True, id_col, text_col) if exact else gram_rows(docs, n, True, id_col, text_col)
    return _overlap(rows, [id_col, "paragraph"]).drop("n_ngrams")


def _met_grams(rows: DataFrame) -> DataFrame:
    """Id and the n-grams that a lower id has too. What is shuffled is an id and a number for each n-gram, and lists of those that tasks know to be met."""
    here = F.struct("id")
    least = F.min(F.when(F.col("met").isNull(), here)).over(Window.partitionBy("gram"))
    seen = rows.withColumn("seen", F.col("met").isNotNull() | F.coalesce(least < here, F.lit(False))).filter("seen")
    return seen.groupBy("id").agg(F.flatten(F.collect_list(F.coalesce("met", F.array("gram")))).alias("grams"))  # a document's own n-grams at most


def overlap_spans(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and spans: what of a text is covered by n-grams that an earlier document holds, overlapping ones as one span.

    The n-grams are found as in :func:`ngram_overlap`; documents that have any are
    read again, and mark the places of theirs. Documents without are not returned.
    """
    own = _met_grams(gram_rows(docs, n, False, id_col, text_col, all_rows=True))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(own, "id")
    kind = docs.schema[id_col].dataType.simpleString()

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for k, grams in enumerate(batch.column(2).to_pylist()):
                column = batch.column(1).slice(k, 1)
                _, _, number, start, end = grams_of_batch(column, n, False)
                hit = np.isin(number.view(np.int64), np.array(grams, np.int64))
                spans.append(_union(start[hit], end[hit], texts_of(column)[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["id", "spans"])

    found = texts.select("id", "text", "grams").mapInArrow(marked, f"id {kind}, spans {S.SPANS}")
    return found.select(F.col("id").alias(id_col), "spans")


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _union(start: np.ndarray, end: np.ndarray, data: np.ndarray) -> list[dict]:
    """Byte ranges that rise by start, joined where they overlap, in code points."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    last = np.r_[first[1:], len(start)] - 1
    before = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return [{"start": int(before[a]), "end": int(before[z]), "score": 1.0} for a, z in zip(start[first], reach[last])]


def duplicate_spans(docs: DataFrame, least: float = 0.5, n: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and spans of the paragraphs whose overlap is ``least`` or more, scored by it."""
    found = paragraph_overlap(docs, n, id_col, text_col).filter(F.col("overlap") >= least)
    # starts of the lines: their lengths before, in one pass per document
    sizes = F.transform(lines(F.col(text_col)), F.length)
    rows = docs.select(id_col, F.posexplode(sizes).alias("paragraph", "size"))
    before = Window.partitionBy(id_col).orderBy("paragraph").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum(F.col("size") + 1).over(before), F.lit(0)))
    hit = placed.join(found, [id_col, "paragraph"])
    return hit.groupBy(id_col).agg(F.sort_array(F.collect_list(S.span(F.col("start"), F.col("start") + F.col("size"), F.col("overlap")))).alias("spans"))
